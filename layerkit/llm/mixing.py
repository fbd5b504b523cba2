"""Mixing sources to target weights (DataFrame functions only).

Systematic sampling: within a source every document expects ``rate`` copies, where
``rate`` is the source's target over its size. The documents of a source are put in a
fixed order, their expected copies are prefix-summed, one random offset is added, and
a document is emitted once for each integer boundary that its interval crosses.

The order goes by size first (an implicit stratification: every stretch of similar
sizes is sampled at the same rate, so the words taken stay close to the target), then
by a hash of the key. The prefix sum is made in two levels: a source is cut into
(size band, hash bucket) groups, ranks are counted inside a group and the groups'
offsets are summed over one small row for each group. A source that holds a third of
all rows is so dealt out over thousands of groups.

Defined results: a null text has size 0; null sources are one source, ordered last; a
source without words gets target 0 and no copies; rows that repeat are separate
documents; documents of equal size and key are ordered by their text's hash (equal
rows are interchangeable); an empty table gives an empty result. Extra columns ride
along in ``row`` and cannot clash.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import add_surrogate_key
from .common import WORD, as_row, quoted, stored

BUCKETS = 64
GROUP = ["_source", "_band", "_bucket"]


def sized(docs: DataFrame, text: str, source: str, key: str) -> DataFrame:
    """Per document: its row, key, source, size in words and its sampling group."""
    size = F.coalesce(F.regexp_count(quoted(text), F.lit(WORD)), F.lit(0)).cast("long")
    return (docs.select(as_row(docs), quoted(key).alias("_key"), quoted(source).cast("string").alias("_name"),
                        size.alias("_size"), F.xxhash64(quoted(text)).alias("_tie"))
            # 's' + name sorts by code point, 't' (null) after every name
            .withColumn("_source", F.coalesce(F.concat(F.lit("s"), "_name"), F.lit("t")))
            # number of binary digits, then the leading four of them
            .withColumn("_band", F.expr("length(bin(_size)) * 16 + shiftright(_size, greatest(length(bin(_size)) - 4, 0))").cast("int"))
            .withColumn("_bucket", (F.conv(F.substring(F.md5(F.coalesce(F.col("_key").cast("string"), F.lit("")).cast("binary")), 1, 4), 16, 10).cast("int") % BUCKETS)))


def targets(spark: SparkSession, sizes: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """``sizes`` (_source, _words) with each source's target words.

    The level L of the water filling min(weight * L, most * words) is found by
    repeating one aggregate until no further source reaches its ceiling; each round
    returns a single row.
    """
    wheel = F.array(*[F.lit(int(w)) for w in weights])
    ranked = add_surrogate_key(sizes, ["_source"], "_place")
    table = stored(ranked.withColumn("_weight", F.element_at(wheel, ((F.col("_place") - 1) % len(weights) + 1).cast("int")).cast("long")), spark, "mixing-targets")
    whole = table.agg(F.sum("_words")).first()[0] or 0
    level, before = float("inf"), None
    capped = F.lit(False)
    while True:
        row = table.agg(F.coalesce(F.sum(F.when(capped, F.col("_words"))), F.lit(0)).alias("full"),
                        F.coalesce(F.sum(F.when(~capped, F.col("_weight"))), F.lit(0)).alias("open")).first()
        if (row["full"], row["open"]) == before or not row["open"]:
            break
        before = (row["full"], row["open"])
        level = (whole * share - row["full"] * most) / row["open"]
        capped = F.col("_weight") * F.lit(level) > F.col("_words") * F.lit(most)
    return table.withColumn("_target", F.when(F.col("_weight") * F.lit(level) > F.col("_words") * F.lit(most), F.col("_words") * F.lit(float(most))).otherwise(F.col("_weight") * F.lit(level)))


def mix(docs: DataFrame, *, text: str = "text", source: str = "source", key: str = "doc_id",
        weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: str = "mix") -> DataFrame:
    """One row per document: row, key, size, source_size, target, copies, taken."""
    spark = docs.sparkSession
    frame = sized(docs, text, source, key)
    groups = stored(frame.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("_rows"), F.sum("_size").alias("_words")), spark, "mixing-groups")
    sources = targets(spark, groups.groupBy("_source").agg(F.sum("_words").alias("_words")), weights, share, most)
    running = Window.partitionBy("_source").orderBy("_band", "_bucket").rowsBetween(Window.unboundedPreceding, -1)
    plan = (groups.select(*GROUP, F.coalesce(F.sum("_rows").over(running), F.lit(0)).alias("_before"))
            .join(sources.select("_source", F.col("_words").alias("source_size"), F.col("_target").alias("target")), "_source")
            .withColumn("_rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))
            .withColumn("_offset", F.conv(F.substring(F.md5(F.concat(F.lit(seed), "_source").cast("binary")), 1, 8), 16, 10).cast("double") / 2.0 ** 32))
    inside = Window.partitionBy(*GROUP).orderBy("_size", "_key", "_tie")
    edge = lambda rank: F.floor(rank * F.col("_rate") + F.col("_offset"))
    return (frame.withColumn("_rank", F.row_number().over(inside))
            .join(plan, GROUP)
            .withColumn("_rank", F.col("_rank") + F.col("_before"))
            .withColumn("copies", edge(F.col("_rank")) - edge(F.col("_rank") - 1))
            .select("row", F.col("_key").alias("key"), F.col("_size").alias("size"), "source_size", "target", "copies",
                    (F.col("copies") * F.col("_size")).alias("taken")))


def emit(mixed: DataFrame) -> DataFrame:
    """The mix itself: every document's own columns, once for each copy."""
    copies = mixed.where(F.col("copies") > 0)
    return copies.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy")).select("row.*")


def query(docs: DataFrame) -> DataFrame:
    mixed = mix(docs.select("doc_id", "text", "source"))
    return mixed.select(F.col("key").alias("doc_id"), "size", "source_size", "target", "taken", "copies")


SQL = r"""
WITH sized AS (
  SELECT doc_id, coalesce('s' || source, 't') AS src,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
grouped AS (
  SELECT *, length(bin(size)) * 16 + (size >> greatest(length(bin(size)) - 4, 0)::BIGINT) AS band,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 4))::INT % 64 AS bucket FROM sized),
sources AS (
  SELECT src, sum(size)::DOUBLE AS words, ([5, 2, 1])[(row_number() OVER (ORDER BY src) - 1)::INT % 3 + 1]::DOUBLE AS weight
  FROM sized GROUP BY src),
levels AS (
  SELECT *, (sum(words) OVER () * 1.5 - coalesce(sum(words) OVER w, 0) * 2.0)
            / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS level, words * 2.0 / weight AS ratio
  FROM sources WINDOW w AS (ORDER BY words * 2.0 / weight, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
chosen AS (SELECT min_by(level, (ratio, src)) AS level FROM levels WHERE level <= ratio),
goal AS (
  SELECT src, words, CASE WHEN weight * c.level > words * 2.0 THEN words * 2.0 ELSE weight * c.level END AS target,
         ('0x' || substr(md5('mix' || src), 1, 8))::BIGINT::DOUBLE / 4294967296.0 AS u
  FROM sources, chosen c),
ranked AS (
  SELECT g.*, row_number() OVER (PARTITION BY src ORDER BY band, bucket, size, doc_id) AS r FROM grouped g),
copied AS (
  SELECT r.doc_id, r.size, q.words::BIGINT AS source_size, q.target,
         CASE WHEN q.words > 0 THEN floor(r.r * (q.target / q.words) + q.u) - floor((r.r - 1) * (q.target / q.words) + q.u)
              ELSE 0 END::BIGINT AS copies
  FROM ranked r JOIN goal q USING (src))
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM copied
"""
