"""Chat formatting: multi-party perspective rotation (DataFrame functions).

For every participant of a dialogue the whole dialogue is rendered once with that
speaker as the assistant and all others as named users; the mask holds the character
spans of the speaker's own words, the only ones to train on.

A rendering is a table of segments, one row for each (dialogue, perspective, turn):
rendered text, its character offset in the dialogue and the masked span. Segments in
turn order concatenate to the full rendering, so a dialogue with very many turns needs
no group in memory. ``rendered`` joins the segments of each dialogue to one text.

Defined results: a null text is empty and its span is empty; a null role is the
participant ``unknown``; turns are ordered by turn (null first), then role and text;
repeated rows are separate turns; an empty table gives an empty result; only the
columns named are read, so extra columns cannot clash.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import quoted

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def segments(turns: DataFrame, *, dialogue: str = "conv_id", turn: str = "turn", role: str = "role",
             text: str = "text") -> DataFrame:
    """dialogue, perspective, place (from 0), segment, start, mask_start, mask_end."""
    rows = turns.select(quoted(dialogue).alias("dialogue"), quoted(turn).alias("turn"),
                        F.coalesce(quoted(role).cast("string"), F.lit("unknown")).alias("role"),
                        F.coalesce(quoted(text).cast("string"), F.lit("")).alias("text"))
    order = Window.partitionBy("dialogue").orderBy("turn", "role", "text")
    placed = rows.withColumn("place", F.row_number().over(order) - 1)
    # one small row for each participant; each turn meets the participants of its dialogue
    parties = rows.select("dialogue", F.col("role").alias("perspective")).distinct()
    own = F.col("role") == F.col("perspective")
    head = F.when(own, F.lit(f"{OPEN}assistant\n")).otherwise(F.concat(F.lit(f"{OPEN}user name="), "role", F.lit("\n")))
    met = (placed.join(parties, placed["dialogue"].eqNullSafe(parties["dialogue"])).select(placed["*"], "perspective")
           .withColumn("head", head).withColumn("segment", F.concat("head", "text", F.lit(CLOSE))))
    along = Window.partitionBy("dialogue", "perspective").orderBy("place")
    start = F.coalesce(F.sum(F.length("segment")).over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (met.withColumn("start", start.cast("long"))
            .select("dialogue", "perspective", "place", "segment", "start",
                    F.when(own, F.col("start") + F.length("head")).alias("mask_start"),
                    F.when(own, F.col("start") + F.length("head") + F.length("text")).alias("mask_end")))


def rendered(parts: DataFrame) -> DataFrame:
    """One row for each (dialogue, perspective): text and mask spans [start, end)."""
    in_order = F.array_sort(F.collect_list(F.struct("place", "segment", "mask_start", "mask_end")))
    spans = F.filter("all", lambda p: p["mask_start"].isNotNull())
    return (parts.groupBy("dialogue", "perspective").agg(in_order.alias("all"))
            .select("dialogue", "perspective", F.size("all").alias("n_turns"),
                    F.array_join(F.transform("all", lambda p: p["segment"]), "").alias("text"),
                    F.transform(spans, lambda p: F.struct(p["mask_start"].alias("start"), p["mask_end"].alias("end"))).alias("spans")))


def query(conversations: DataFrame) -> DataFrame:
    """Every turn of every perspective, with a digest of the rendered segment."""
    return segments(conversations).select(
        F.col("dialogue").alias("conv_id"), "perspective", "place", F.length("segment").cast("long").alias("n_chars"),
        F.sha2(F.col("segment"), 256).alias("segment_sha256"), "start", "mask_start", "mask_end")


SQL = r"""
WITH rows_ AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS place FROM rows_),
met AS (
  SELECT p.*, q.perspective, p.role = q.perspective AS own,
         CASE WHEN p.role = q.perspective THEN '<|im_start|>assistant' || chr(10)
              ELSE '<|im_start|>user name=' || p.role || chr(10) END AS head
  FROM placed p JOIN (SELECT DISTINCT conv_id, role AS perspective FROM rows_) q ON p.conv_id IS NOT DISTINCT FROM q.conv_id),
seg AS (SELECT *, head || text || '<|im_end|>' || chr(10) AS segment FROM met),
started AS (
  SELECT *, coalesce(sum(length(segment)) OVER (PARTITION BY conv_id, perspective ORDER BY place
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM seg)
SELECT conv_id, perspective, place::INT AS place, length(segment)::BIGINT AS n_chars, sha256(segment) AS segment_sha256, start,
       CASE WHEN own THEN start + length(head) END AS mask_start,
       CASE WHEN own THEN start + length(head) + length(text) END AS mask_end
FROM started
"""
