"""Jobs that hand tables in and out: batch and lookup writers, re-registered tables, views,
ordered results and whole documents, drifting schemas, positional unions, lookups by
loosely written keys, and dimensions whose keys outlive a delivery."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import ts_lit
from ..functions.json import nested_json
from ..operators.aggregates import distinct_by_key
from ..operators.joins import match_join, repair_by_lookup
from ..operators.keys import register_members
from ..operators.merge import truncate_table
from ..operators.projection import map_columns, union_by_position
from ..operators.split import split_rows
from ..session import new_database, new_run_dir
from ..sources.files import read_json_array, read_new, read_table
from ..sources.ordered import (read_json_array_parts, read_ordered, read_parts, write_json_array, write_ordered,
                               write_xml_document)
from ..sources.tables import load
from ..sources.writers import batch_writer, lookup_writer, read_runs, register_table, write_batch, write_run
from . import medallion, retail

# ---------------------------------------------------------------- writers and tables


def b01_batch_writer(spark: SparkSession, sf: str) -> DataFrame:
    """Two appended batches of customers, partitioned and without the excluded column; the
    folder is registered as a table, registered again, and read back by name."""
    path, db = f"{new_run_dir(spark, 'batches')}/customers", new_database(spark, "batches")
    c = load(spark, sf, "customer")
    first, second = split_rows(c, F.col("c_acctbal") >= 0)
    batch_writer(first, "c_nationkey", exclude_columns=["c_acctbal"]).save(path)
    register_table(spark, f"{db}.customers", path, partitioned=True)
    write_batch(second, path, partition_by="c_nationkey", exclude=["c_acctbal"])
    register_table(spark, f"{db}.customers", path, partitioned=True)
    return read_table(spark, f"{db}.customers").select("c_custkey", "c_name", "c_mktsegment", F.col("c_nationkey").cast("int").alias("c_nationkey"))


def b02_lookup_writer(spark: SparkSession, sf: str) -> DataFrame:
    """Lookup tables written without a partition column, emptied by TRUNCATE, written again."""
    db = new_database(spark, "lookups")
    n = load(spark, sf, "nation")
    table = f"{db}.nations"
    lookup_writer(n, ["n_regionkey"]).saveAsTable(table)
    truncate_table(spark, table)
    lookup_writer(n, ["n_regionkey"]).saveAsTable(table)
    return read_table(spark, table)


def a05_read_by_path(spark: SparkSession, sf: str) -> DataFrame:
    """A folder read by path with a declared schema: what it does not hold is null."""
    path = f"{new_run_dir(spark, 'by_path')}/suppliers"
    write_batch(load(spark, sf, "supplier"), path)
    return read_table(spark, path, schema="s_suppkey BIGINT, s_name STRING, s_acctbal DOUBLE, s_rating INT")


def a07_new_records(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze rows still 'New' (read by status) after half of the deliveries were processed,
    stamped with the time of the run."""
    run = medallion.MedallionRun(spark, sf, run_ts=None)
    started = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    early, late = split_rows(medallion.movie_records(spark, sf), F.col("Budget") < 25_000)
    run.ingest(early).to_silver()
    path = f"{run.root}/late"
    medallion.write_raw_documents(spark, sf, path, records=late)
    medallion.raw_to_bronze(spark, path, run.bronze, None, run.ledger)
    fresh = read_new(spark, run.bronze)
    return fresh.select(F.get_json_object("Movies", "$.Id").cast("long").alias("Id"),
                        (F.col("Ingesttime").cast("timestamp_ntz") >= ts_lit(started)).alias("stamped"),
                        (F.col("p_Ingestdate") == F.col("Ingesttime").cast("date")).alias("same_day"))


def a04_row_limit(spark: SparkSession, sf: str) -> DataFrame:
    """Raw documents read with the reader's row limit set above what they hold."""
    path = f"{new_run_dir(spark, 'limited')}/raw"
    medallion.write_raw_documents(spark, sf, path)
    rows = read_json_array(spark, path, "movie", "STRING", "Movies", row_limit=2**31 - 1)
    return rows.select(F.get_json_object("Movies", "$.Id").cast("long").alias("Id"))


def b15_views(spark: SparkSession, sf: str) -> DataFrame:
    """The two pivot views, created and read by SQL."""
    by_year, _ = retail.register_views(spark, sf)
    return spark.sql(f"SELECT * FROM {by_year}")


def preview(df: DataFrame, n: int, order_by: list[str]) -> DataFrame:
    """The first ``n`` rows in a stated order (``show(n)`` as a result)."""
    return df.orderBy(*order_by).limit(n)


def l04_preview(spark: SparkSession, sf: str) -> DataFrame:
    return preview(load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), 20,
                   ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])


# ---------------------------------------------------------------- projections and joins


def c03_duplicate_names(spark: SparkSession, sf: str) -> DataFrame:
    """A mapping that names a target twice (in another case): the first one holds."""
    return map_columns(load(spark, sf, "part"), [("Key", "p_partkey"), ("Name", "p_name"), ("name", "p_brand"), ("KEY", "p_size"), ("Size", "p_size")])


def c20_strict_split(spark: SparkSession, sf: str) -> DataFrame:
    """The two-filter split: rows whose rule is null land in neither branch."""
    rows = medallion.movie_records(spark, sf).select("Id", "RunTime")
    good, bad = split_rows(rows, F.col("RunTime") >= 0, strict=True)
    return good.withColumn("branch", F.lit("clean")).unionByName(bad.withColumn("branch", F.lit("quarantine")))


def d13_repair_by_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Events without a device: the id comes from the user dimension."""
    bad = load(spark, sf, "events").select("event_id", "user_id", F.lit(None).cast("string").alias("device_id"))
    users = load(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return repair_by_lookup(bad, users, "user_id", "c_custkey", "c_nationkey", "string", "device_id")


def d11_ignore_spaces(spark: SparkSession, sf: str) -> DataFrame:
    """Stock groups looked up by a label that is written with stray blanks."""
    p = load(spark, sf, "part").select("p_partkey", F.concat(F.lit(" "), F.substring("p_type", 1, 2), F.lit(" "), F.substring("p_type", 3, 100)).alias("label"))
    groups = load(spark, sf, "part").groupBy("p_type").agg(F.count(F.lit(1)).alias("n_items"))
    return match_join(p, groups, [("label", "p_type")], ignore_spaces=True).select("p_partkey", "label", "p_type", "n_items")


def e11_distinct_by_key(spark: SparkSession, sf: str) -> DataFrame:
    return distinct_by_key(load(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag"), "l_partkey")


def l06_union_by_position(spark: SparkSession, sf: str) -> DataFrame:
    """Purchase-order packages given as a list and as a single text, united by position: the
    list's numbers decide the type of the column."""
    p = load(spark, sf, "part")
    even = F.col("p_size") % 2 == 0
    lists = p.filter(even).select("p_partkey", F.explode(F.array(F.col("p_size").cast("int"), (F.col("p_size") + 1).cast("int"))).alias("package_id"),
                                  F.col("p_retailprice").cast("decimal(10,1)").alias("price"))
    texts = p.filter(~even).select(F.col("p_partkey").cast("string").alias("reference"), F.col("p_size").cast("string").alias("package"),
                                   F.col("p_retailprice").cast("decimal(18,2)"))
    return union_by_position(lists, texts)


# ---------------------------------------------------------------- ordered results and documents


def _ordered(spark: SparkSession, df: DataFrame, order_by: list[str]) -> DataFrame:
    path = f"{new_run_dir(spark, 'ordered')}/rows"
    write_ordered(df, order_by, path)
    return read_ordered(spark, path)


def l01_q07_ordered(spark: SparkSession, sf: str) -> DataFrame:
    return _ordered(spark, retail.q07_avg_days(spark, sf), ["n_name"])


def l01_q08_ordered(spark: SparkSession, sf: str) -> DataFrame:
    return _ordered(spark, retail.q08_by_month(spark, sf), ["n_name", "month"])


def l01_q19_ordered(spark: SparkSession, sf: str) -> DataFrame:
    return _ordered(spark, retail.q19_pivot_groups(spark, sf), ["year"])


def f25_json_document(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with their totals as one JSON array, written in key order and read back."""
    path = f"{new_run_dir(spark, 'json_document')}/orders"
    rows = retail.q20_tvf_apply(spark, sf)
    spec = {"Order": F.col("o_orderkey"), "Customer.Id": F.col("o_custkey"), "Customer.Total": F.col("total")}
    write_json_array(rows, ["o_orderkey"], path, nested_json(spec))
    back = read_json_array_parts(spark, path, "Order BIGINT, Customer STRUCT<Id: BIGINT, Total: DOUBLE>")
    return back.select("row_no", F.col("item.Order").alias("o_orderkey"), F.col("item.Customer.Id").alias("o_custkey"),
                       F.col("item.Customer.Total").alias("total"))


def f26_xml_document(spark: SparkSession, sf: str) -> DataFrame:
    """The pivot of stock groups as one XML document, read back line by line."""
    path = f"{new_run_dir(spark, 'xml_document')}/groups"
    pivot = retail.q19_pivot_groups(spark, sf)
    row = F.struct(F.col("year").alias("_Year"), *[F.col(c) for c in pivot.columns if c != "year"])
    write_xml_document(pivot, ["year"], path, row, "StockItems", "Years")
    return read_parts(spark, path)


# ---------------------------------------------------------------- drift and persistent keys


def b05_schema_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Orders written by three runs whose columns and types differ, read as one table."""
    path = f"{new_run_dir(spark, 'drift')}/orders"
    o = load(spark, sf, "orders")
    day, key, price = F.col("o_orderdate"), F.col("o_orderkey"), F.col("o_totalprice")
    cuts = [dt.datetime(1997, 1, 1), dt.datetime(1999, 1, 1)]
    write_run(o.filter(day < ts_lit(cuts[0])).select(key.cast("int").alias("o_orderkey"), "o_orderstatus", price.cast("decimal(12,2)").alias("o_totalprice"),
                                                     day.cast("date").alias("o_orderdate")), path, "1")
    write_run(o.filter((day >= ts_lit(cuts[0])) & (day < ts_lit(cuts[1]))).select(key, price.cast("decimal(18,1)").alias("O_TOTALPRICE"), day, "o_orderpriority"), path, "2")
    write_run(o.filter(day >= ts_lit(cuts[1])).select(key, "o_orderstatus", price.cast("decimal(12,2)").alias("o_totalprice"), day, F.col("o_custkey").cast("string").alias("o_custkey")), path, "3")
    write_run(o.filter(day >= ts_lit(cuts[1])).select(key, "o_orderstatus", price.cast("decimal(12,2)").alias("o_totalprice"), day, "o_custkey"), path, "3")  # a run repeated
    return read_runs(spark, path)


def _dimension_keys(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(genres, languages, movie-genre pairs) with generated keys after two deliveries."""
    db = new_database(spark, "dimension_keys")
    early, late = split_rows(medallion.movie_records(spark, sf), F.col("Budget") < 25_000)
    for batch in (early, late):  # the second delivery knows most members already
        g = batch.select("Id", F.explode("genres").alias("g"))
        genres = register_members(spark, f"{db}.genres", g.select(F.col("g.name").alias("Genre_Name"), F.col("g.id").alias("Genre_Id")), "Genre_Key")
        languages = register_members(spark, f"{db}.languages", batch.select(F.col("OriginalLanguage").alias("Language_Code")), "Language_Key")
        pairs = g.select(F.col("Id").alias("Movie_Id"), F.col("g.name").alias("Genre_Name"), F.col("g.id").alias("Genre_Id")) \
            .join(genres, ["Genre_Name", "Genre_Id"]).select("Movie_Id", "Genre_Key").distinct()
        medallion._append_unseen(pairs, f"{db}.movie_genres")
    return genres, languages, spark.table(f"{db}.movie_genres")


def m_genre_keys(spark: SparkSession, sf: str) -> DataFrame:
    return _dimension_keys(spark, sf)[0]


def m_language_keys(spark: SparkSession, sf: str) -> DataFrame:
    return _dimension_keys(spark, sf)[1]


def m_junction_keys(spark: SparkSession, sf: str) -> DataFrame:
    return _dimension_keys(spark, sf)[2]
