"""Connected components of a table of links."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); the component is its
    smallest node.

    Labels spread along the links and are then looked up in each other, which halves
    the remaining depth, until nothing changes. Every round is an aggregate and two
    joins over stored tables; one number returns to the driver.
    """
    spark = links.sparkSession
    both = stored(links.select("a", "b").union(links.select("b", "a")).distinct(), spark, "links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                    .select("node", F.least("node", "m").alias("component")), spark, "labels")
    while True:
        over = labels.select(F.col("node").alias("up"), F.col("component").alias("top"))
        jumped = (labels.join(over, labels["component"] == over["up"], "left")
                  .select("node", F.col("component").alias("before"), F.coalesce(F.col("top"), F.col("component")).alias("component")))
        around = (both.join(jumped, both["b"] == jumped["node"]).groupBy("a").agg(F.min("component").alias("m")))
        new = stored(jumped.join(around, jumped["node"] == around["a"], "left")
                     .select("node", "before", F.least("component", F.coalesce("m", "component")).alias("component")), spark, "labels")
        changed = new.where("before <> component").limit(1).count()
        labels = new.select("node", "component")
        if not changed:
            return labels
