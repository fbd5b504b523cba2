"""Config-driven copies and small maintenance jobs.

* ``run_table_list``: the list of source tables lives in a JSON control file;
  the driver walks its few rows and starts one watermark load per table.
* ``copy_to_parquet``: full copy of a table into the ODS layer, conformed to a
  declared schema (type conversion on the way).
* ``apply_deletions``: remove every row that belongs to a deletion request.
* ``activity_parts``: time parts of event times for the landing layer.
"""
from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import ts_lit
from ..schemas import conform
from ..session import new_database, new_run_dir
from ..sources.files import layer_path, read_config
from ..sources.tables import load
from ..sources.writers import write_parquet
from ..operators.increments import compact, latest, load_increment
from ..operators.rewrite import delete_matching, delete_where_in, read_files
from ..operators.versions import publish
from .incremental import WATERMARK_DDL, extract_increment, read_marks, set_marks

# The tables the control file lists, with watermark columns, merge
# procedure names, parameter names and sink names, and the first marks.
TABLE_LIST = [
    {"TABLE_NAME": "orders", "WaterMark_Column": "o_orderdate", "TableType": "fact",
     "StoredProcedureNameForMergeOperation": "usp_upsert_orders", "parameterName": "orders",
     "SinkTableName": "ods_orders"},
    {"TABLE_NAME": "lineitem", "WaterMark_Column": "l_shipdate", "TableType": "fact",
     "StoredProcedureNameForMergeOperation": "usp_upsert_lineitem", "parameterName": "lineitem",
     "SinkTableName": "ods_lineitem"},
    {"TABLE_NAME": "events", "WaterMark_Column": "ts", "TableType": "fact",
     "StoredProcedureNameForMergeOperation": "usp_upsert_events", "parameterName": "events",
     "SinkTableName": "ods_events"},
]
FIRST_MARKS = {"orders": dt.datetime(2000, 6, 30), "lineitem": dt.datetime(2001, 1, 31),
               "events": dt.datetime(2024, 1, 20, 12, 0, 0)}


# The merge procedures the control file names, and the key each upserts on.
MERGE_PROCEDURES = {
    "usp_upsert_orders": ["o_orderkey"],
    "usp_upsert_lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"],
    "usp_upsert_events": ["event_id"],
}
REPLAY_DAYS = 30
ODS_GRAIN = "month"
MOST_AT_ONCE = 8  # tables loaded side by side, however long the list


def run_table_list(spark: SparkSession, sf: str, config: DataFrame, control_path: str,
                   db: str, source: Callable[[str], DataFrame] | None = None) -> list[tuple[str, str]]:
    """One watermark load per configured table, upserted by the named procedure.

    The configuration holds a handful of rows, so it is walked on the driver; the
    tables are extracted side by side (one Spark job chain per table). Each increment is
    added to its ODS table under the procedure's key and writes its own files only
    (``operators.increments``), which makes loading the same window twice harmless; so
    the new marks are written once, after every table succeeded, and a failure anywhere
    just repeats the window. ``source`` names the tables (default: the driver tables).
    """
    rows = config.collect()
    marks = read_marks(spark, control_path)
    source = source or (lambda name: load(spark, sf, name))

    def load_one(row):
        keys = MERGE_PROCEDURES[row["StoredProcedureNameForMergeOperation"]]
        target = f"{db}.{row['SinkTableName']}"
        increment, new = extract_increment(source(row["TABLE_NAME"]), row["WaterMark_Column"], marks.get(row["TABLE_NAME"]))
        if increment is not None:
            load_increment(spark, target, increment, keys, row["WaterMark_Column"], grain=ODS_GRAIN)
        return row["TABLE_NAME"], target, new

    with ThreadPoolExecutor(max_workers=max(1, min(len(rows), MOST_AT_ONCE))) as pool:
        done = [f.result() for f in [pool.submit(load_one, r) for r in rows]]
    set_marks(spark, control_path, {name: new for name, _, new in done if new is not None})
    return [(name, target) for name, target, _ in done]


# What the rows of each ODS table are compared by (key parts, time, text, amount).
ODS_VIEW = {
    "orders": (["o_orderkey"], "o_orderdate", "o_orderstatus", "o_totalprice"),
    "lineitem": (["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"], "l_shipdate", "l_returnflag", "l_extendedprice"),
    "events": (["event_id"], "ts", "event_type", "value"),
}


def _as_delivered_later(df: DataFrame, name: str) -> DataFrame:
    """Stand-in for a second delivery: the source as it is after its rows were edited."""
    column = ODS_VIEW[name][2]
    return df.withColumn(column, F.concat(F.col(column), F.lit("*")))


def _table_loop(spark: SparkSession, sf: str) -> list[tuple[str, str]]:
    """Two passes of the table loop; the second delivers edited rows and re-extracts from
    marks REPLAY_DAYS earlier, so its window overlaps rows the first pass loaded."""
    root = new_run_dir(spark, "tablelist")
    db = new_database(spark, "ods_loop")
    cfg_path = f"{root}/config/table_list.json"
    spark.createDataFrame(TABLE_LIST).coalesce(1).write.json(cfg_path)
    control = f"{root}/control"
    publish(spark.createDataFrame(list(FIRST_MARKS.items()), WATERMARK_DDL), control)
    run_table_list(spark, sf, read_config(spark, cfg_path), control, db)
    late = {t: mark for t, mark in read_marks(spark, control).items()}
    set_marks(spark, control, {t: mark - dt.timedelta(days=REPLAY_DAYS) for t, mark in late.items()})
    return run_table_list(spark, sf, read_config(spark, cfg_path), control, db,
                          lambda name: _as_delivered_later(load(spark, sf, name), name))


def _ods_rows(spark: SparkSession, loaded: list[tuple[str, str]]) -> DataFrame:
    """Every row of the ODS tables in one shape."""
    out = []
    for name, table in loaded:
        key, time, text, amount = ODS_VIEW[name]
        merge_key = next(MERGE_PROCEDURES[t["StoredProcedureNameForMergeOperation"]] for t in TABLE_LIST if t["TABLE_NAME"] == name)
        out.append(latest(spark, table, merge_key).select(
            F.lit(name).alias("TABLE_NAME"), F.concat_ws("|", *[F.col(k).cast("string") for k in key]).alias("row_key"),
            F.col(time).alias("row_time"), F.col(text).alias("row_text"), F.col(amount).alias("amount")))
    return reduce(DataFrame.unionByName, out)


def g07_config_loop(spark: SparkSession, sf: str) -> DataFrame:
    """The rows of every ODS table after two passes of the table loop."""
    return _ods_rows(spark, _table_loop(spark, sf))


def g03_upsert_compacted(spark: SparkSession, sf: str) -> DataFrame:
    """The same rows after the increments were folded into their base."""
    loaded = _table_loop(spark, sf)
    for t in TABLE_LIST:
        compact(spark, dict(loaded)[t["TABLE_NAME"]], MERGE_PROCEDURES[t["StoredProcedureNameForMergeOperation"]])
    return _ods_rows(spark, loaded)


# Declared ODS schemas: money as DECIMAL(18,2), dates as DATE.
ODS_SCHEMAS = {
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, "
              "o_totalprice DECIMAL(18,2), o_orderdate DATE, o_orderpriority STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DECIMAL(18,2), "
                "c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
            "p_retailprice DECIMAL(18,2)",
}
def copy_to_parquet(spark: SparkSession, sf: str, table: str, root: str) -> str:
    path = layer_path(root, "ODS", table)
    write_parquet(conform(load(spark, sf, table), ODS_SCHEMAS[table]), path)
    return path


def g08_ods_to_parquet(spark: SparkSession, sf: str) -> DataFrame:
    """The written rows of every ODS copy, read back with the declared types."""
    root = new_run_dir(spark, "ods_copy")
    out = None
    for table in ODS_SCHEMAS:
        path = copy_to_parquet(spark, sf, table, root)
        c = spark.read.schema(ODS_SCHEMAS[table]).parquet(path).select(F.lit(table).alias("table_name"), "*")
        out = c if out is None else out.unionByName(c, allowMissingColumns=True)
    return out


def deletion_requests(customer: DataFrame) -> DataFrame:
    """Customers who asked to be forgotten (stand-in rule: a negative balance)."""
    return customer.filter(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("key"))


def apply_deletions(df: DataFrame, key: str, requests: DataFrame) -> DataFrame:
    """Drop every row whose ``key`` is in the request list (a hash anti join, so the
    list may be as long as the table; a short literal list would be ``~isin``)."""
    return df.join(requests, df[key] == requests["key"], "left_anti")


def write_by_key(df: DataFrame, key: str, path: str, files: int) -> None:
    """A folder of files with disjoint key ranges: a deletion list touches few of them."""
    df.repartitionByRange(files, key).sortWithinPartitions(key).write.parquet(path)


CUSTOMER_FILES = 16


def g14_gdpr_delete(spark: SparkSession, sf: str) -> DataFrame:
    """Orders written by customer, then the requested customers' rows deleted from the
    files that hold them; what the folder holds afterwards."""
    path = f"{new_run_dir(spark, 'gdpr')}/orders"
    write_by_key(load(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_custkey", path, CUSTOMER_FILES)
    delete_matching(spark, path, "o_custkey", deletion_requests(load(spark, sf, "customer")))
    return read_files(spark, path)


RETAINED_FROM = dt.datetime(1996, 7, 1)


def g05_retention_delete(spark: SparkSession, sf: str) -> DataFrame:
    """Orders partitioned by year; rows before a day inside a year are deleted."""
    path = f"{new_run_dir(spark, 'retention')}/orders"
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice", F.year("o_orderdate").alias("o_year"))
    write_parquet(o, path, partition_by="o_year")
    delete_where_in(spark, path, F.col("o_orderdate") < ts_lit(RETAINED_FROM))
    return read_files(spark, path)


def activity_parts(df: DataFrame, time_col: str) -> DataFrame:
    """Landing-file preparation: the time column plus its day, month and hour."""
    t = F.col(time_col)
    return df.select("*", F.dayofmonth(t).alias("day"), F.month(t).alias("month"),
                     F.hour(t).alias("hour"))


def epoch_to_time(df: DataFrame, col: str) -> DataFrame:
    """Epoch seconds to timestamp text in the session time zone (``from_unixtime``)."""
    return df.withColumn(col, F.from_unixtime(F.col(col)))


def a13_activity_parts(spark: SparkSession, sf: str) -> DataFrame:
    e = load(spark, sf, "events").select(F.col("user_id").alias("name"), F.col("ts").alias("time"),
                                         "event_id")
    return activity_parts(e, "time")
