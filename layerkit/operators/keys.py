"""Surrogate keys assigned in parallel (no single-task window over the table)."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import workspace

_LOW33 = (1 << 33) - 1


def add_surrogate_key(df: DataFrame, order_by: list[str | Column], name: str,
                      start: int | Column = 1, step: int = 1,
                      num_partitions: int | None = None) -> DataFrame:
    """Dense 1..n style key following ``order_by`` (columns or sort expressions; it must be
    a total order).

    1. range-partition on ``order_by`` and sort inside each partition;
    2. ``monotonically_increasing_id`` then holds (partition, position) exactly;
    3. rows per partition (one small row each) give prefix offsets, broadcast back.
    Every stage is parallel; only ``num_partitions`` offsets reach one task.

    The tagged rows are checkpointed to the shared checkpoint folder before they
    are used twice: range boundaries come from sampling, and a recomputation
    (a second branch, or a lost executor) over input in another order could
    sample other boundaries and hand out different keys.
    """
    workspace(df.sparkSession)  # makes sure a checkpoint folder is set
    n = int(num_partitions or df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order_by]
    tagged = (df.repartitionByRange(n, *order_cols)
                .sortWithinPartitions(*order_cols)
                .withColumn("__mid", F.monotonically_increasing_id())
                .withColumn("__pid", F.shiftright("__mid", 33))
                .withColumn("__pos", F.col("__mid").bitwiseAND(F.lit(_LOW33)))
                .drop("__mid")
                .checkpoint(eager=True))
    counts = tagged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    prior = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__pid", F.coalesce(F.sum("__n").over(prior), F.lit(0)).alias("__off"))
    base = start if isinstance(start, Column) else F.lit(start)
    out = tagged.join(F.broadcast(offsets), "__pid")
    key = base + (F.col("__off") + F.col("__pos")) * F.lit(step)
    return out.select(key.cast("long").alias(name), *df.columns)


def continue_key(df: DataFrame, existing: DataFrame, existing_key: str,
                 order_by: list[str], name: str, step: int = 1) -> DataFrame:
    """Keys for new rows that continue after ``max(existing_key)`` (IDENTITY + @maxid).

    The maximum is a scalar subquery, evaluated once inside the plan.
    """
    top = existing.agg(F.coalesce(F.max(existing_key), F.lit(0)).cast("long")).scalar()
    return add_surrogate_key(df, order_by, name, start=top + F.lit(step), step=step)


def register_members(spark, registry: str, members: DataFrame, key: str, order_by: list[str] | None = None) -> DataFrame:
    """Persistent keys of a dimension's members: ``registry`` (created when absent) holds
    ``key`` and the natural columns of every member ever seen.

    Known members keep their keys; unseen ones (null-safe on all natural columns) continue
    from the largest key, in order of the natural columns, and are appended: nothing
    written before is read back into a file. A run that failed after the append finds its
    members known. Returns the registry.
    """
    natural = members.columns
    if not spark.catalog.tableExists(registry):
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in members.schema.fields)
        spark.sql(f"CREATE TABLE {registry} (`{key}` BIGINT, {ddl}) USING parquet")
    held = spark.table(registry)
    known = held.select(*[F.col(c).alias(f"__h{i}") for i, c in enumerate(natural)])
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"__h{i}")) for i, c in enumerate(natural)])
    unseen = members.distinct().join(known, same, "left_anti")
    continue_key(unseen, held, key, order_by or natural, key).select(key, *natural).write.insertInto(registry)
    spark.catalog.refreshTable(registry)
    return spark.table(registry)
