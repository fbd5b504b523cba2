"""Aggregations written so Spark can combine map-side before any shuffle."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pivot_sum(df: DataFrame, rows: list[str], pivot_col: str, values: list,
              measure: Column | str, names: list[str] | None = None) -> DataFrame:
    """``PIVOT (SUM(measure) FOR pivot_col IN (values))``.

    The value list is given, so Spark skips the extra job that would look the
    distinct values up, and aggregates (rows, pivot_col) with a partial combine.
    """
    m = F.col(measure) if isinstance(measure, str) else measure
    out = df.groupBy(*rows).pivot(pivot_col, values).agg(F.sum(m))
    if names:
        out = out.withColumnsRenamed({str(v): n for v, n in zip(values, names)})
    return out


def top_per_group(df: DataFrame, group: list[str], order: str, ties: bool = True,
                  descending: bool = True, tiebreak: list[str] | None = None) -> DataFrame:
    """Rows ranked first within each group: ``DENSE_RANK() ... = 1`` when ``ties``,
    else ``ROW_NUMBER() ... = 1`` ordered by (order, tiebreak...).

    The rank filter lets Catalyst insert a partial ``WindowGroupLimit`` before the
    shuffle: every map task keeps only its local rank-1 rows per group, so the
    exchange and the final window see a handful of rows per group even when one
    group holds a third of the input, and the input is read once.
    """
    o = F.col(order).desc() if descending else F.col(order).asc()
    extra = [F.col(c).asc() for c in (tiebreak or [])]
    w = Window.partitionBy(*group).orderBy(o, *extra)
    rank = F.dense_rank() if ties else F.row_number()
    return df.withColumn("__rank", rank.over(w)).filter(F.col("__rank") == 1).drop("__rank")


def dedup_keep_first(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """One row per key: the first by ``order_by`` (deterministic; partial min per key)."""
    rest = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c).alias(f"__o_{i}") for i, c in enumerate(order_by)],
                      *[F.col(c).alias(f"__v_{c}") for c in rest])
    first = df.groupBy(*keys).agg(F.min(packed).alias("__first"))
    return first.select(*keys, *[F.col(f"__first.__v_{c}").alias(c) for c in rest]) \
                .select(*df.columns)


def distinct_by_key(df: DataFrame, key: str, deterministic: bool = True) -> DataFrame:
    """One row per key value (``groupBy(k)`` with ``first`` of every other column).

    ``deterministic`` takes, per key, the smallest row instead of whichever came first.
    """
    if deterministic:
        rest = [c for c in df.columns if c != key]
        return dedup_keep_first(df, [key], rest)
    return df.groupBy(key).agg(*[F.first(c).alias(c) for c in df.columns if c != key]) \
             .select(*df.columns)


def null_profile(df: DataFrame) -> DataFrame:
    """Per column: rows, nulls. One pass, one row per column in the result."""
    aggs = [F.count(F.lit(1)).alias("__rows")]
    aggs += [F.sum(F.col(f"`{c}`").isNull().cast("long")).alias(f"n{i}")
             for i, c in enumerate(df.columns)]
    one = df.agg(*aggs)
    stack = ", ".join(f"'{c}', n{i}" for i, c in enumerate(df.columns))
    return one.selectExpr(f"stack({len(df.columns)}, {stack}) AS (column_name, null_count)",
                          "__rows AS row_count")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once (primary-key check)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
              .filter(F.col("n_rows") > 1))
