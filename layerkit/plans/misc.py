"""Smaller jobs: chunked JSON split, people-text cleaning, surrogate keys,
schema-drift union, null profile and primary-key check."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clean_people
from ..operators.aggregates import duplicate_keys, null_profile
from ..operators.keys import add_surrogate_key
from ..operators.split import split_chunks
from ..session import new_run_dir
from ..sources.files import read_tsv
from ..sources.tables import load
from ..sources.writers import write_json

CHUNKS = 8
PEOPLE_COLUMNS = ["FirstName", "LastName", "Phone", "Address"]


def m_split_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Orders split into 8 JSON chunk folders of floor(n/8) rows, the remainder in the last;
    every written row with its folder's number."""
    out = f"{new_run_dir(spark, 'chunks')}/orders"
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    write_json(split_chunks(o, ["o_orderkey"], CHUNKS), out, partition_by="chunk")
    return spark.read.schema("o_orderkey BIGINT, o_custkey BIGINT, o_orderdate TIMESTAMP_NTZ, chunk INT").json(out)


def dirty_people(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Untidy people text derived from customers: stray blanks/tabs, mixed case,
    dashed phone numbers, 'No.' and '#' in addresses, some phones missing."""
    c = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    k = F.col("c_custkey")
    seg = F.col("c_mktsegment")
    first = (F.when(k % 3 == 0, F.lower(seg)).when(k % 3 == 1, seg)
              .otherwise(F.concat(F.lower(F.substring(seg, 1, 2)), F.substring(seg, 3, 100))))
    last = F.when(k % 2 == 0, F.lower("n_name")).otherwise(F.col("n_name"))
    phone = F.when(k % 11 == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("555-"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0"), F.lit("-"),
                 F.lpad(F.col("n_regionkey").cast("string"), 2, "0")))
    addr = F.concat(F.lit("No."), F.col("c_nationkey").cast("string"), F.lit(" #"),
                    F.col("n_regionkey").cast("string"), F.lit(" Rd"))
    pad = F.when(k % 4 == 0, F.lit("  ")).when(k % 4 == 1, F.lit("\t")).otherwise(F.lit(""))
    return c.select(F.concat(pad, first, pad).alias("FirstName"),
                    F.concat(last, pad).alias("LastName"),
                    F.concat(pad, phone).alias("Phone"),
                    F.concat(addr, F.lit(" ")).alias("Address"))


def c_clean_text(spark: SparkSession, sf: str) -> DataFrame:
    """Write the untidy people as tab-separated text, read it back, clean it."""
    path = f"{new_run_dir(spark, 'people')}/people_tsv"
    (dirty_people(load(spark, sf, "customer"), load(spark, sf, "nation"))
        .write.option("sep", "\t").option("header", True).csv(path))
    return clean_people(read_tsv(spark, path, PEOPLE_COLUMNS))


def k_surrogate_key(spark, sf):
    p = load(spark, sf, "part").select("p_partkey", "p_name")
    return add_surrogate_key(p, ["p_name", "p_partkey"], "sk")


def x_union_by_name(spark, sf):
    c = load(spark, sf, "customer").select(
        F.col("c_name").alias("name"), F.col("c_custkey").alias("id"),
        F.lit("customer").alias("kind"), F.col("c_mktsegment").alias("segment"))
    s = load(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.lit("supplier").alias("kind"), F.col("s_name").alias("name"))
    return c.unionByName(s, allowMissingColumns=True)


def x_null_profile(spark, sf):
    from .medallion import movie_records
    m = movie_records(spark, sf).drop("genres")
    return null_profile(m)


def x_pk_check(spark, sf):
    return duplicate_keys(load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])
