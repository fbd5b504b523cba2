"""ODS loads: guarded daily load, rolling window load, high-water-mark extract,
key-based merges, and the typed JSON-shredding copy."""
from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import ts_lit
from ..functions.json import json_value
from ..operators.merge import (append_rows, create_partitioned_table, drop_partitions_where,
                               merge_delete, merge_insert, merge_upsert, partition_values)
from ..operators.versions import publish, read_published
from ..schemas import conform
from ..session import new_database
from ..sources.tables import load

ODS_ORDERS_DDL = "OrderID BIGINT, OrderTotal DECIMAL(18,2), CustomerID BIGINT, OrderDate DATE"

# The dates the exercises run their procedures with, restated for the driver tables.
LOAD_DATES = [dt.date(1995, 1, d) for d in range(1, 6)]
WINDOW_START = dt.date(1995, 1, 3)
TAX_WINDOW_START = dt.date(1995, 1, 6)
WINDOW_DAYS = 7


class DateAlreadyLoaded(ValueError):
    pass


class KeyConflict(ValueError):
    pass


def _ts(d: dt.date) -> dt.datetime:
    return dt.datetime(d.year, d.month, d.day)


def create_ods_orders(spark: SparkSession, db: str) -> str:
    table = f"{db}.ods_orders"
    create_partitioned_table(spark, table, ODS_ORDERS_DDL, "OrderDate")
    return table


def ods_order_rows(orders: DataFrame, lineitem: DataFrame, day_filter: Column,
                   with_tax: bool = False) -> DataFrame:
    """(OrderID, OrderDate, OrderTotal, CustomerID) of the filtered orders.

    The day's orders are joined first (small side: AQE broadcasts it, and a runtime
    filter prunes the line scan), then lines are summed per order. Orders without
    lines drop out, as with CROSS APPLY.
    """
    o = orders.filter(day_filter).select("o_orderkey", "o_orderdate", "o_custkey")
    amount = F.col("l_extendedprice").cast("decimal(18,2)")
    if with_tax:
        amount = amount * (F.lit(1) + F.col("l_tax").cast("decimal(18,3)"))
    j = o.join(lineitem.select("l_orderkey", "l_extendedprice", "l_tax"),
               F.col("l_orderkey") == F.col("o_orderkey"))
    return (j.groupBy("o_orderkey", "o_orderdate", "o_custkey")
             .agg(F.sum(amount).cast("decimal(18,2)").alias("OrderTotal"))
             .select(F.col("o_orderkey").alias("OrderID"), "OrderTotal",
                     F.col("o_custkey").alias("CustomerID"),
                     F.col("o_orderdate").cast("date").alias("OrderDate")))


def _day_range(start: dt.date, end_exclusive: dt.date) -> Column:
    c = F.col("o_orderdate")
    return (c >= ts_lit(_ts(start))) & (c < ts_lit(_ts(end_exclusive)))


def load_orders_for_dates(spark: SparkSession, table: str, orders: DataFrame,
                          lineitem: DataFrame, days: list[dt.date]) -> None:
    """Append the orders of several days with totals; refuse if any day is loaded.

    Every day is checked first, from the table's partition list (metadata only), so
    a refused call writes nothing. All days are then loaded by one job: one scan of
    the lines instead of one per day. The rows land as new date partitions that
    commit together at job end, so a failed run leaves nothing behind.
    """
    wanted = sorted(set(days))
    present = {r[0] for r in partition_values(spark, table, "OrderDate").collect()}
    clash = [d for d in wanted if d.isoformat() in present]
    if clash:
        raise DateAlreadyLoaded(f"dates {[d.isoformat() for d in clash]} already loaded into {table}")
    cond = None
    for d in wanted:
        c = _day_range(d, d + dt.timedelta(days=1))
        cond = c if cond is None else cond | c
    append_rows(ods_order_rows(orders, lineitem, cond), table)


def load_orders_for_date(spark: SparkSession, table: str, orders: DataFrame,
                         lineitem: DataFrame, day: dt.date) -> None:
    """Append one day's orders with totals; refuse a day that is already loaded."""
    load_orders_for_dates(spark, table, orders, lineitem, [day])


def load_orders_window(spark: SparkSession, table: str, orders: DataFrame, lineitem: DataFrame,
                       start: dt.date, days: int = WINDOW_DAYS, include_start: bool = False,
                       with_tax: bool = False, on_conflict: str = "skip") -> None:
    """Retention + window load.

    1. delete every order dated before ``start`` (whole date partitions dropped);
    2. load orders dated in ``(start, start+days]`` (or ``[start, start+days]`` with
       ``include_start``) with their totals (with tax when asked);
    3. keys already present are skipped (MERGE ... WHEN NOT MATCHED INSERT) or,
       with ``on_conflict='error'``, abort the load before anything is deleted or written.
    """
    first = start if include_start else start + dt.timedelta(days=1)
    last = start + dt.timedelta(days=days)
    rows = ods_order_rows(orders, lineitem, _day_range(first, last + dt.timedelta(days=1)), with_tax)
    # An order keeps its date, so a key can only collide inside the window's partitions.
    present = spark.table(table).filter(
        (F.col("OrderDate") >= ts_lit(first)) & (F.col("OrderDate") <= ts_lit(last)))
    new = rows
    if on_conflict == "error":
        clash = rows.join(present.select("OrderID"), "OrderID", "left_semi").limit(1).count()
        if clash:
            raise KeyConflict(f"window load into {table} would repeat existing OrderID values")
    else:
        new = rows.join(present.select("OrderID"), "OrderID", "left_anti")
    drop_partitions_where(spark, table, "OrderDate", F.col("OrderDate") < F.lit(start.isoformat()))
    append_rows(new, table)


def _ods_view(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table).select("OrderID", F.col("OrderTotal").cast("double").alias("OrderTotal"),
                                     "CustomerID", "OrderDate")


def _daily_loads(spark, sf) -> str:
    db = new_database(spark, "ods")
    table = create_ods_orders(spark, db)
    o, l = load(spark, sf, "orders"), load(spark, sf, "lineitem")
    load_orders_for_dates(spark, table, o, l, LOAD_DATES)
    return table


def q21_load_date(spark, sf):
    return _ods_view(spark, _daily_loads(spark, sf))


def q23_load_week(spark, sf):
    table = _daily_loads(spark, sf)
    load_orders_window(spark, table, load(spark, sf, "orders"), load(spark, sf, "lineitem"),
                       WINDOW_START)
    return _ods_view(spark, table)


def q23_with_tax(spark, sf):
    table = _daily_loads(spark, sf)
    load_orders_window(spark, table, load(spark, sf, "orders"), load(spark, sf, "lineitem"),
                       TAX_WINDOW_START, include_start=True, with_tax=True, on_conflict="error")
    return _ods_view(spark, table)


# Q22: typed table + INSERT ... SELECT with JSON fields shredded ---------------------------------
ODS_EVENTS_DDL = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, k STRING"


def q22_shred_json(spark, sf):
    db = new_database(spark, "ods")
    table = f"{db}.ods_events"
    spark.sql(f"CREATE TABLE {table} ({ODS_EVENTS_DDL}) USING parquet")
    e = load(spark, sf, "events").withColumn("k", json_value("props", "$.k"))
    conform(e, ODS_EVENTS_DDL).write.insertInto(table)
    return spark.table(table)


# High-water-mark incremental extract (G-6) --------------------------------------------------------
WATERMARK_DDL = "TableName STRING, WatermarkValue TIMESTAMP_NTZ"
INCREMENT = "increment_after"  # partition column of a sink: the old mark of each increment
INITIAL_MARK = dt.datetime(2001, 1, 1)


def _mark_lit(v):
    return ts_lit(v) if isinstance(v, (dt.datetime, dt.date)) else F.lit(v)


def extract_increment(source: DataFrame, wm_col: str, old_mark):
    """(rows with ``old_mark < wm <= new_mark``, new_mark), or (None, old_mark)
    when nothing is new. Both marks are single values; the range predicate
    reaches the scan (parquet statistics / JDBC WHERE). Rows with a null mark
    never load."""
    fresh = source if old_mark is None else source.filter(F.col(wm_col) > _mark_lit(old_mark))
    new = fresh.agg(F.max(wm_col)).first()[0]
    if new is None:
        return None, old_mark
    return fresh.filter(F.col(wm_col) <= _mark_lit(new)), new


def read_marks(spark: SparkSession, control_path: str) -> dict:
    """The control table (one row per source table) as a dict on the driver."""
    return {r["TableName"]: r["WatermarkValue"] for r in read_published(spark, control_path).collect()}


def incremental_load(spark: SparkSession, source: DataFrame, table_name: str, wm_col: str,
                     control_path: str, sink_path: str | None = None, write_fn=None) -> int:
    """Copy rows with ``old_mark < wm <= new_mark`` and then store the new mark.

    The rows go to ``write_fn`` (e.g. an upsert) or to the folder of ``sink_path`` that
    is named after the old mark, which they overwrite. The mark is written only after
    the rows are committed; a run that failed in between is simply repeated: it starts
    from the same old mark and so replaces what it had written, also when more rows
    have arrived. Returns 1 when rows were copied, 0 when there was nothing new.
    """
    old = read_marks(spark, control_path).get(table_name)
    rows, new = extract_increment(source, wm_col, old)
    if rows is None:
        return 0
    if write_fn is not None:
        write_fn(rows)
    else:
        after = "start" if old is None else re.sub("[^0-9A-Za-z]", "-", str(old))
        rows.write.mode("overwrite").parquet(f"{sink_path}/{INCREMENT}={after}")
    set_marks(spark, control_path, {table_name: new})
    return 1


def set_marks(spark: SparkSession, control_path: str, marks: dict) -> None:
    """Replace the marks of the given tables in the control table.

    The control table holds one row per source table, so its rows are read on the driver.
    They are written as a new version beside the old one, and a pointer is switched last:
    a failure leaves the old marks readable, and the load is simply repeated.
    """
    current = read_marks(spark, control_path)
    current.update(marks)
    schema = read_published(spark, control_path).schema
    publish(spark.createDataFrame(sorted(current.items()), schema), control_path)


def i_watermark_increment(spark, sf):
    from ..session import new_run_dir
    root = new_run_dir(spark, "watermark")
    control, sink = f"{root}/control", f"{root}/ods_orders"
    spark.createDataFrame([("orders", INITIAL_MARK)], WATERMARK_DDL).write.parquet(control)
    orders = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    incremental_load(spark, orders, "orders", "o_orderdate", control, sink)
    incremental_load(spark, orders, "orders", "o_orderdate", control, sink)  # nothing new
    return spark.read.parquet(sink).drop(INCREMENT)


# Key-based merges on order snapshots (G-2, G-3, G-4) ----------------------------------------------
def _orders(spark, sf):
    return load(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")


def _before(day: dt.datetime) -> Column:
    return F.col("o_orderdate") < ts_lit(day)


def i_upsert(spark, sf):
    target = _orders(spark, sf).filter(_before(dt.datetime(2000, 1, 1)))
    src = (_orders(spark, sf).filter(~_before(dt.datetime(1999, 7, 1)))
           .withColumn("o_orderstatus", F.lit("U")))
    return merge_upsert(target, src, "o_orderkey")


def i_insert_missing(spark, sf):
    target = _orders(spark, sf).filter(_before(dt.datetime(1998, 1, 1)))
    src = _orders(spark, sf).filter(~_before(dt.datetime(1997, 7, 1)))
    return merge_insert(target, src, "o_orderkey")


DRIP_HOURS = 3
ROWS_PER_HOUR = 10


def next_batch(backlog: DataFrame, hours: int = DRIP_HOURS) -> DataFrame:
    """The next ``10 * hours`` rows in time order (the drip-feed batch)."""
    return backlog.orderBy("ts", "event_id").limit(ROWS_PER_HOUR * hours)


def i_delete_matched(spark, sf):
    backlog = load(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    return merge_delete(backlog, next_batch(backlog), ["user_id", "ts"])


def x_topn(spark, sf):
    return next_batch(load(spark, sf, "events").select("event_id", "user_id", "ts"))
