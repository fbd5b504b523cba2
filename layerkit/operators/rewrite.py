"""Row deletes in a folder of data files: only the files that hold such rows are rewritten.

The files to touch are found by reading the key (or the predicate's columns) and
``_metadata.file_path`` alone. Their surviving rows are written to a hidden folder inside
the table, then a small intent file names the old and the new files: from there on the
delete counts. Moving the new files in and deleting the old ones follows; if that is cut
short, the next call here finishes it from the intent file, and ``read_files`` does so
before it reads. Before the intent file exists, the table is as it was. All other files
keep their names and bytes. Works on plain and on partitioned folders.
"""
from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import folders
from .merge import delete_where

AREA, INTENT = "_rewrite", "INTENT"  # hidden from readers of the table


def _area(path: str) -> str:
    return f"{path.rstrip('/')}/{AREA}"


def finish_rewrite(spark: SparkSession, path: str) -> bool:
    """Complete a delete that was cut short after its intent was written, and clear what an
    earlier one left; True when there was one to complete."""
    area = _area(path)
    intent = folders.read_text(spark, f"{area}/{INTENT}")
    if intent is not None:
        plan = json.loads(intent)
        for source, target in plan["new"]:
            if folders.exists(spark, source):
                folders.move(spark, source, target)
        for old in plan["old"]:
            folders.remove(spark, old)
    folders.remove(spark, area)
    return intent is not None


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path``, any interrupted delete completed first."""
    finish_rewrite(spark, path)
    return spark.read.parquet(path)


def _partitions_of(spark: SparkSession, path: str) -> list[str]:
    """Partition columns, as the folder names give them."""
    out, folder = [], path
    while True:
        names = [c for c in folders.children(spark, folder) if "=" in c.rsplit("/", 1)[1]]
        if not names:
            return out
        out.append(names[0].rsplit("/", 1)[1].split("=", 1)[0])
        folder = names[0]


def rewrite_files(spark: SparkSession, path: str, hit: Callable[[DataFrame], DataFrame],
                  keep: Callable[[DataFrame], DataFrame]) -> list[str]:
    """Replace the files that hold a row of ``hit`` by their rows of ``keep``; returns them."""
    finish_rewrite(spark, path)
    table = spark.read.parquet(path)
    doomed = hit(table.withColumn("__file", F.col("_metadata.file_path")))
    touched = sorted(r[0] for r in doomed.select("__file").distinct().collect())
    if not touched:
        return []
    area, columns = _area(path), _partitions_of(spark, path)
    survivors = keep(spark.read.option("basePath", path).schema(table.schema).parquet(*touched))
    survivors.write.partitionBy(*columns).parquet(f"{area}/new")
    inside = f"/{AREA}/new/"
    moves = [(f, f"{path.rstrip('/')}/{f.split(inside, 1)[1]}") for f in folders.data_files(spark, f"{area}/new")]
    folders.write_text(spark, f"{area}/{INTENT}", json.dumps({"old": touched, "new": moves}))
    finish_rewrite(spark, path)
    return touched


def delete_matching(spark: SparkSession, path: str, key: str, requests: DataFrame, request_key: str = "key") -> list[str]:
    """Delete the rows whose ``key`` is requested (null keys stay); returns the old names of
    the files that were rewritten. The request list may be long: both joins are plain hash
    joins, broadcast only below the size limit."""
    wanted = requests.select(F.col(request_key).alias("__key")).distinct()
    return rewrite_files(spark, path, lambda t: t.join(wanted, F.col(key) == F.col("__key"), "left_semi"),
                         lambda t: t.join(wanted, F.col(key) == F.col("__key"), "left_anti"))


def delete_where_in(spark: SparkSession, path: str, predicate: Column) -> list[str]:
    """DELETE ... WHERE on files (rows with a null predicate stay). The predicate reaches
    the scan that looks for the files, so their statistics already rule most out."""
    return rewrite_files(spark, path, lambda t: t.where(predicate), lambda t: delete_where(t, predicate))
