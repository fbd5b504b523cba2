"""Labelled rows to learn from, for the two classifiers."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, quoted, stored

#: Rows per label that a model is fitted on, about: a bounded sample, chosen by a hash of the key.
MOST = 8000


def sample(docs: DataFrame, labels: DataFrame, label: str, *, key: str = "doc_id", text: str = "text",
           most: int = MOST, tag: str = "labelled") -> DataFrame:
    """(key, label, text, weight) of labelled rows outside fold 0, stored: all of them, or
    a hash sample of about ``most`` for each label where there are more. The weight is how
    many labelled keys a sampled one stands for, so that models see the labels' true shares.

    Null labels and keys teach nothing; of several labels of one key the largest
    counts. The keys of the sample are bounded, so the join may broadcast them.
    """
    spark = docs.sparkSession
    marks = (labels.where(quoted(key).isNotNull() & quoted(label).isin(0, 1) & (fold(key) != 0))
             .groupBy(quoted(key).alias("key")).agg(F.max(quoted(label)).cast("int").alias("label")))
    counts = dict(marks.groupBy("label").count().collect())  # two rows
    draw = F.pmod(F.xxhash64(F.lit(tag), "key"), F.lit(1 << 30))
    keep = F.lit(False)
    for value, n in counts.items():
        keep = keep | ((F.col("label") == value) & (draw < int((1 << 30) * min(1.0, most / n))))
    chosen = stored(marks.where(keep), spark, f"{tag}-keys")
    drawn = dict(chosen.groupBy("label").count().collect())
    weight = F.lit(None).cast("double")
    for value, n in drawn.items():
        weight = F.when(F.col("label") == value, F.lit(counts[value] / n)).otherwise(weight)
    texts = docs.select(quoted(key).alias("key"), F.coalesce(quoted(text).cast("string"), F.lit("")).alias("text"))
    return stored(texts.join(F.broadcast(chosen), "key").select("key", "label", "text", weight.alias("weight")), spark, tag)
