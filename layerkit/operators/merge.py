"""MERGE / DELETE without a transactional table format.

The ``merge_*`` functions are pure DataFrame -> DataFrame: they describe the new
content of the target. ``apply_merge`` and friends write that content back to a
partitioned catalog table touching only the affected partitions: to a fresh folder,
then one catalog update for each partition (``versions.replace_partitions``), so no
file is overwritten and no session setting changes. Single writer per table is assumed.
"""
from __future__ import annotations

from functools import reduce
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .versions import NULL_PARTITION, replace_partitions


def _key_list(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def one_per_key(src: DataFrame, key) -> DataFrame:
    """One row for each key, null keys included: of repeated ones the row with the
    largest other columns (compared in order, nulls first), whatever the partitioning."""
    keys = _key_list(key)
    rest = [c for c in src.columns if c not in keys]
    if not rest:
        return src.distinct()
    best = src.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("__best"))
    return best.select(*keys, "__best.*").select(*src.columns)


def merge_update(target: DataFrame, src: DataFrame, key, set_cols: dict[str, Column | str]) -> DataFrame:
    """WHEN MATCHED THEN UPDATE SET ...; repeated source keys are reduced by ``one_per_key``.

    ``set_cols`` maps target column -> source column name or expression on ``src``.
    A matched row takes the source value even when it is null.
    """
    keys = _key_list(key)
    exprs = {c: (F.col(v) if isinstance(v, str) else v) for c, v in set_cols.items()}
    s = one_per_key(src.select(*[F.col(k).alias(f"__k_{k}") for k in keys],
                               *[e.alias(f"__s_{c}") for c, e in exprs.items()]),
                    [f"__k_{k}" for k in keys])
    s = s.withColumn("__hit", F.lit(True))
    cond = None
    for k in keys:
        c = target[k] == s[f"__k_{k}"]
        cond = c if cond is None else cond & c
    joined = target.join(s, cond, "left")
    return joined.select(*[
        (F.when(F.col("__hit"), F.col(f"__s_{c}")).otherwise(target[c]).cast(target.schema[c].dataType)
         if c in exprs else target[c]).alias(c)
        for c in target.columns])


def merge_insert(target: DataFrame, src: DataFrame, key) -> DataFrame:
    """WHEN NOT MATCHED THEN INSERT: target plus source rows with unseen keys."""
    keys = _key_list(key)
    new = src.join(target.select(*keys), keys, "left_anti")
    return target.unionByName(new.select(*target.columns))


def merge_upsert(target: DataFrame, src: DataFrame, key) -> DataFrame:
    """Insert or replace by key: ``(target - matched keys) UNION ALL src``.

    A source with repeated keys is reduced by ``one_per_key``; null keys match each
    other, so that a replayed increment replaces its rows instead of adding them."""
    keys = _key_list(key)
    new = one_per_key(src.select(*target.columns), keys)
    wanted = new.select(*[F.col(k).alias(f"__k_{k}") for k in keys])
    cond = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys])
    return target.join(wanted, cond, "left_anti").unionByName(new)


def merge_delete(target: DataFrame, src: DataFrame, key) -> DataFrame:
    """WHEN MATCHED THEN DELETE."""
    keys = _key_list(key)
    return target.join(src.select(*keys), keys, "left_anti")


# What a marked row asks for.
INSERT, UPDATE, DELETE, UPSERT = "insert", "update", "delete", "upsert"


def apply_actions(target: DataFrame, marked: DataFrame, key, action: str = "_action", order_by=()) -> DataFrame:
    """New content of ``target`` after the rows of ``marked`` did what their ``action`` says,
    in one pass: one full outer join on the key (null keys match).

    update and delete change rows that are there, insert adds a row whose key is not (an
    existing one stays as it is), upsert does either. Of several rows for one key the last
    by ``order_by`` counts, ties and no order: the largest row. Other actions raise.
    """
    keys = _key_list(key)
    columns = target.columns
    rest = [c for c in columns if c not in keys]
    last = marked.groupBy(*keys).agg(F.max(F.struct(
        *[F.col(c).alias(f"__o{i}") for i, c in enumerate(order_by)], F.col(action).alias("__a"),
        *[F.col(c).alias(f"__v{i}") for i, c in enumerate(rest)])).alias("__m"))
    last = last.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__m")
    known = F.col("__m.__a").isin(INSERT, UPDATE, DELETE, UPSERT)
    last = last.where(F.when(known, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("unknown action: "), F.coalesce("__m.__a", F.lit("null")))).cast("boolean")))
    cond = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)])
    both = target.withColumn("__t", F.lit(True)).join(last, cond, "full_outer")
    there, what = F.coalesce("__t", F.lit(False)), F.coalesce("__m.__a", F.lit(""))
    new = F.when(there, what.isin(UPDATE, UPSERT)).otherwise(what.isin(INSERT, UPSERT))
    stays = F.when(there, what != DELETE).otherwise(what.isin(INSERT, UPSERT))
    values = {**{k: f"__k{i}" for i, k in enumerate(keys)}, **{c: f"__m.__v{i}" for i, c in enumerate(rest)}}
    return both.where(stays).select(*[F.when(new, F.col(values[c])).otherwise(F.col(c)).cast(target.schema[c].dataType).alias(c) for c in columns])


def apply_actions_to(spark: SparkSession, table: str, marked: DataFrame, key, action: str = "_action", order_by=()) -> None:
    """``apply_actions`` on a partitioned catalog table: reads and replaces the partitions
    that hold a marked key or receive a row, no others. A row may change its partition."""
    keys, parts = _key_list(key), partition_columns(spark, table)
    current = spark.table(table)
    wanted = marked.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).distinct()
    cond = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)])
    held = current.join(wanted, cond, "left_semi").select(*parts)
    named = held.unionByName(marked.select(*parts)).distinct().select(*[F.col(p).alias(f"__p{i}") for i, p in enumerate(parts)])
    inside = reduce(Column.__and__, [F.col(p).eqNullSafe(F.col(f"__p{i}")) for i, p in enumerate(parts)])
    scope = current.join(F.broadcast(named), inside, "left_semi")  # one row for each partition touched
    apply_merge(spark, table, parts, apply_actions(scope, marked, keys, action, order_by), affected=scope)


def delete_where(target: DataFrame, predicate: Column) -> DataFrame:
    """DELETE ... WHERE predicate (rows with a null predicate stay)."""
    return target.filter(~F.coalesce(predicate, F.lit(False)))


# ---------------------------------------------------------------- table side

def create_partitioned_table(spark: SparkSession, table: str, schema_ddl: str,
                             partition_col: str) -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({schema_ddl}) USING parquet "
              f"PARTITIONED BY ({partition_col})")


def truncate_table(spark: SparkSession, table: str) -> None:
    """DELETE FROM a whole table (all rows, schema kept)."""
    spark.sql(f"TRUNCATE TABLE {table}")


def partition_values(spark: SparkSession, table: str, partition_col: str) -> DataFrame:
    """Partition values of a table as a one-column DataFrame (catalog metadata)."""
    return (spark.sql(f"SHOW PARTITIONS {table}")
            .select(F.regexp_extract("partition", f"(?:^|/){partition_col}=([^/]*)", 1).alias(partition_col)))


def drop_partitions_where(spark: SparkSession, table: str, partition_col: str,
                          predicate: Column) -> int:
    """Delete whole partitions whose value satisfies ``predicate`` (metadata + folders).

    Only the partition list (one string per partition, not data) is brought to the
    driver.
    """
    parts = partition_values(spark, table, partition_col).filter(predicate).collect()
    for row in parts:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({partition_col}='{row[0]}')")
    return len(parts)


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def overwrite_partitions(df: DataFrame, table: str) -> None:
    """Replace exactly the partitions present in ``df``; concurrent writers of other
    tables do not touch each other."""
    replace_partitions(df, table, partition_columns(df.sparkSession, table))


def append_rows(df: DataFrame, table: str) -> None:
    cols = df.sparkSession.table(table).columns
    df.select(*cols).write.insertInto(table, overwrite=False)


def apply_merge(spark: SparkSession, table: str, partition_cols, new_content: DataFrame,
                affected: DataFrame | None = None) -> None:
    """Write the merged content of the touched partitions back to ``table``.

    ``new_content`` is the full new content of the partitions that may change
    (typically built with ``merge_*`` from a partition-filtered read). It is written
    beside the files it may be read from; partitions switch to it afterwards.
    ``affected`` (a DataFrame holding the partition columns) names the partitions
    that were read for the merge; those left without rows are dropped last: a failure
    in between can leave a row in both its old and new partition (the next merge
    resolves it), never in neither.
    """
    cols = [partition_cols] if isinstance(partition_cols, str) else list(partition_cols)
    emptied = []
    if affected is not None:
        emptied = [{c: NULL_PARTITION if r[c] is None else quote(str(r[c]), safe="") for c in cols}
                   for r in affected.select(*cols).distinct().collect()]
    replace_partitions(new_content, table, cols, emptied)


def upsert_into_table(spark: SparkSession, table: str, rows: DataFrame, key,
                      buckets: int = 64, bucket_col: str = "_bucket") -> None:
    """Insert-or-replace ``rows`` into a catalog table by ``key``.

    The table is partitioned by a hash bucket of the key, so a key always lives in
    the same bucket: only buckets that receive a key are read, merged and
    rewritten (copy-on-write per bucket), the rest of the table is untouched. An
    increment that reaches all buckets rewrites all; ``increments.load_increment`` does not.
    """
    keys = _key_list(key)
    src = rows.withColumn(bucket_col, F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)))
    if not spark.catalog.tableExists(table):
        one_per_key(src, keys).write.partitionBy(bucket_col).saveAsTable(table)
        return
    touched = src.select(bucket_col).distinct()
    current = spark.table(table).join(touched, bucket_col, "left_semi")
    apply_merge(spark, table, bucket_col, merge_upsert(current, src, keys))
