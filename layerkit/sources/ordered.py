"""Ordered results, and whole documents (a JSON array, an XML root) in part files.

Rows are range-partitioned by the order, numbered in parallel (``add_surrogate_key``) and
written so that the part files in name order, and the lines in each, are the result in its
order. A document's opening and closing are part of its first and last row's text: the
files put one after the other are one valid document, and no task or driver holds it whole.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keys import add_surrogate_key

ROW_NO = "row_no"


def write_ordered(df: DataFrame, order_by: list[str | Column], path: str) -> None:
    """ORDER BY as files: rows with their number ``row_no`` (from 1). ``order_by`` names
    columns or sort expressions (``F.col(c).desc()``) and should be a total order."""
    add_surrogate_key(df, order_by, ROW_NO).write.parquet(path)


def read_ordered(spark: SparkSession, path: str) -> DataFrame:
    """The written rows; ``row_no`` is the place of each file's rows in the result, read
    back from the files' order and not from a stored column."""
    lines = spark.read.parquet(path).drop(ROW_NO)
    names = lines.columns
    placed = lines.select("*", F.col("_metadata.file_name").alias("__f"), F.col("_metadata.row_index").alias("__i"))
    return add_surrogate_key(placed, ["__f", "__i"], ROW_NO).select(ROW_NO, *names)


def _write_document(rows: DataFrame, order_by: list[str | Column], path: str, text: Column, opening: str, between: str, closing: str) -> None:
    numbered = add_surrogate_key(rows, order_by, ROW_NO)
    last = rows.select(F.count(F.lit(1))).scalar()
    value = F.concat(F.when(F.col(ROW_NO) == 1, F.lit(opening)).otherwise(F.lit(between)), text,
                     F.when(F.col(ROW_NO) == last, F.lit(closing)).otherwise(F.lit("")))
    out = numbered.select(value.alias("value"))
    if rows.isEmpty():
        out = rows.sparkSession.createDataFrame([(opening + closing,)], "value string")
    out.write.text(path)


def write_json_array(df: DataFrame, order_by: list[str | Column], path: str, row: Column) -> None:
    """``FOR JSON PATH``: one array with an object (``row``, a struct) for each row, in order.
    Without rows it is ``[]``."""
    _write_document(df, order_by, path, F.to_json(row), "[", ",", "]")


def write_xml_document(df: DataFrame, order_by: list[str | Column], path: str, row: Column, row_tag: str, root: str) -> None:
    """``FOR XML PATH, ROOT``: one root element with an element for each row, in order. A
    row is one line unless its values hold line breaks, which stay."""
    text = F.regexp_replace(F.to_xml(row, {"rowTag": row_tag, "indent": ""}), r"(?<=>)\n(?=<|$)", "")
    _write_document(df, order_by, path, text, f"<{root}>", "", f"</{root}>")


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    """(row_no, value): the lines of the part files in document order."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("__f"),
                                         F.col("_metadata.file_block_start").alias("__b"), F.monotonically_increasing_id().alias("__i"))
    return add_surrogate_key(lines, ["__f", "__b", "__i"], ROW_NO).select(ROW_NO, "value")


def read_json_array_parts(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """(row_no, item): the objects of a document that ``write_json_array`` wrote."""
    parts = read_parts(spark, path).where("value <> '[]'")
    # a line is its object behind the array's bracket or a comma; objects end in a brace
    text = F.regexp_replace("value", r"^[\[,]|(?<=\})\]$", "")
    return parts.select(ROW_NO, F.from_json(text, schema).alias("item"))
