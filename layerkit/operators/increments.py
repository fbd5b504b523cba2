"""Upserts that write the increment only, with compaction.

A keyed table is partitioned by the time grain of its rows (``_grain``), the kind of the
folder (``_kind``: 'base' holds at most one row for each key, 'delta' the rows of one
load) and the load that wrote it (``_load``). A load reduces its rows to one for each key
and adds them as new partitions: nothing that lies in the table is read or rewritten, so
its cost follows the increment. Which loads count is one number in the table's catalog
properties, raised after the partitions are listed: a load that failed before stays
invisible, and the next one drops what it left.

``latest`` reads the newest row of each key: the deltas, reduced by key, and the base rows
whose key has none. Only the deltas are shuffled by key as a rule; the base side of the
anti join shuffles only when the delta keys are too many for a size-checked broadcast.
``compact`` folds the deltas into the base. It rewrites the grains that receive delta rows
or lose superseded ones, and leaves all others as they are.

Null keys match each other, repeated keys of one load are reduced (``one_per_key``), both
from the first load on. Rows without a time go to the grain 'none'. Single writer per table.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .merge import _key_list, one_per_key
from .versions import _unescaped, add_partitions, listed_partitions

TAGS = ["_grain", "_kind", "_load"]
GRAINS = {"day": "yyyy-MM-dd", "month": "yyyy-MM", "year": "yyyy"}
LOADED, COMPACTED = "layerkit.loaded", "layerkit.compacted"


def _numbers(spark: SparkSession, table: str) -> tuple[int, int]:
    """(last load that counts, last compaction); 0 for none."""
    held = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    return int(held.get(LOADED, 0)), int(held.get(COMPACTED, 0))


def _drop(spark: SparkSession, table: str, parts: list[dict[str, str]]) -> None:
    for p in parts:
        spec = ", ".join(f"{c}='{_unescaped(p[c])}'" for c in TAGS)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")


def _superseded(parts: list[dict[str, str]], loaded: int, compacted: int) -> list[dict[str, str]]:
    """Folders that no longer count: older images of a grain, and deltas folded in."""
    newest: dict[str, int] = {}
    for p in parts:
        if p["_kind"] == "base" and int(p["_load"]) <= loaded:
            newest[p["_grain"]] = max(newest.get(p["_grain"], 0), int(p["_load"]))
    return [p for p in parts if (int(p["_load"]) < newest.get(p["_grain"], 0) if p["_kind"] == "base" else int(p["_load"]) <= compacted)]


def _valid(spark: SparkSession, table: str) -> tuple[DataFrame, DataFrame]:
    """(base rows, delta rows) that count. Only partition names are looked at on the driver."""
    loaded, compacted = _numbers(spark, table)
    rows = spark.table(table).where(F.col("_load") <= loaded)
    for p in _superseded(listed_partitions(spark, table), loaded, compacted):  # left by a failed clean-up, as a rule none
        rows = rows.where(~((F.col("_grain") == _unescaped(p["_grain"])) & (F.col("_kind") == p["_kind"]) & (F.col("_load") == int(p["_load"]))))
    return rows.where("_kind = 'base'"), rows.where("_kind = 'delta'")


def _same(keys: list[str], other: list[str]) -> Column:
    return reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(o)) for k, o in zip(keys, other)])


def _together(rows: DataFrame, keys: list[str], files_per_grain: int | None = None) -> DataFrame:
    if files_per_grain is None:
        return rows.hint("rebalance", "_grain")
    return rows.repartition("_grain", F.pmod(F.xxhash64(*keys), F.lit(files_per_grain)))


def load_increment(spark: SparkSession, table: str, rows: DataFrame, key, time_col: str, grain: str = "day",
                   files_per_grain: int | None = None) -> int:
    """Insert or replace ``rows`` by ``key``; the first load creates the table. Returns the
    load's number. Rows of a grain are brought together and adaptive execution splits what
    exceeds its advisory size, so a hot grain is written by many tasks; ``files_per_grain``
    spreads each over a fixed number instead (by key)."""
    keys = _key_list(key)
    if not spark.catalog.tableExists(table):
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
        spark.sql(f"CREATE TABLE {table} ({ddl}, _grain STRING, _kind STRING, _load BIGINT) USING parquet PARTITIONED BY ({', '.join(TAGS)})")
    loaded, compacted = _numbers(spark, table)
    _drop(spark, table, [p for p in listed_partitions(spark, table) if int(p["_load"]) > loaded])
    number = loaded + 1
    data = [c for c in spark.table(table).columns if c not in TAGS]
    new = (one_per_key(rows.select(*data), keys)
           .withColumn("_grain", F.coalesce(F.date_format(time_col, GRAINS[grain]), F.lit("none")))
           .withColumn("_kind", F.lit("delta" if loaded else "base"))
           .withColumn("_load", F.lit(number).cast("long")))
    add_partitions(_together(new, keys, files_per_grain), table, TAGS)
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{LOADED}'='{number}', '{COMPACTED}'='{max(compacted, 1)}')")
    return number


def _newest(delta: DataFrame, keys: list[str]) -> DataFrame:
    """The row of the last load for each key (a load holds a key once)."""
    rest = [c for c in delta.columns if c not in keys]
    best = delta.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col("_load")).alias("__best"))
    return best.select(*keys, "__best.*").select(*delta.columns)


def _merged(base: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    taken = delta.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).distinct()
    kept = base.join(taken, _same(keys, taken.columns), "left_anti")
    return kept.unionByName(_newest(delta, keys))


def latest(spark: SparkSession, table: str, key) -> DataFrame:
    """The newest row of each key, without the tag columns."""
    base, delta = _valid(spark, table)
    loaded, compacted = _numbers(spark, table)
    out = base if loaded == compacted else _merged(base, delta, _key_list(key))
    return out.drop(*TAGS)


def compact(spark: SparkSession, table: str, key) -> list[str]:
    """Fold the deltas into the base; returns the grains that were rewritten.

    Their new images are added beside the old ones and count from the moment the table's
    properties say so; only then are the superseded folders dropped. A failure before
    that leaves the table as it was, one after it leaves folders that no reader counts."""
    loaded, compacted = _numbers(spark, table)
    parts = listed_partitions(spark, table)
    _drop(spark, table, [p for p in parts if int(p["_load"]) > loaded] + _superseded(parts, loaded, compacted))
    if loaded == compacted:
        return []
    keys = _key_list(key)
    base, delta = _valid(spark, table)
    taken = delta.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).distinct()
    lost = base.select("_grain", *keys).join(taken, _same(keys, taken.columns), "left_semi")
    grains = [r[0] for r in delta.select("_grain").union(lost.select("_grain")).distinct().collect()]
    number = loaded + 1
    images = (_merged(base.where(F.col("_grain").isin(grains)), delta, keys)
              .withColumn("_kind", F.lit("base")).withColumn("_load", F.lit(number).cast("long")))
    made = {_unescaped(p["_grain"]) for p in add_partitions(_together(images, keys), table, TAGS)}
    for g in grains:  # a grain that lost all its rows gets an empty image
        if g not in made:
            spark.sql(f"ALTER TABLE {table} ADD PARTITION (_grain='{g}', _kind='base', _load={number})")
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{LOADED}'='{number}', '{COMPACTED}'='{number}')")
    spark.catalog.refreshTable(table)
    _drop(spark, table, _superseded(listed_partitions(spark, table), number, number))
    return sorted(grains)
