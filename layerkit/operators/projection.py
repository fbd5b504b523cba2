"""Column mapping (``mapColumn(new = old, ...)``) and row action marking."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, NullType

from ..schemas import wider_type


def map_columns(df: DataFrame, mapping: dict[str, str | Column] | list[tuple[str, str | Column]],
                on_duplicate: str = "first") -> DataFrame:
    """Project and rename: ``{new_name: source column or expression}`` in order.

    Source names may be qualified (``"cust.ValidFrom"`` after ``df.alias("cust")``)
    and may hold blanks. A target name given twice keeps the first mapping
    (``on_duplicate="first"``) or raises (``"error"``).
    """
    pairs = list(mapping.items()) if isinstance(mapping, dict) else list(mapping)
    seen: set[str] = set()
    cols = []
    for new, src in pairs:
        if new.lower() in seen:
            if on_duplicate == "error":
                raise ValueError(f"column {new!r} mapped twice")
            continue
        seen.add(new.lower())
        expr = src if isinstance(src, Column) else F.col(
            ".".join(f"`{p}`" for p in src.split(".")) if "." in src else f"`{src}`")
        cols.append(expr.alias(new))
    return df.select(*cols)


def mark_rows(df: DataFrame, condition: Column, when_true: str = "update",
              when_false: str = "insert", name: str = "_action") -> DataFrame:
    """Alter-row marking: tag each row with the action a following write applies."""
    return df.withColumn(name, F.when(F.coalesce(condition, F.lit(False)), F.lit(when_true))
                         .otherwise(F.lit(when_false)))


# Which type wins when columns of different types meet by position.
PRECEDENCE = ["timestamp", "timestamp_ntz", "date", "double", "float", "decimal", "bigint", "int", "smallint", "tinyint", "boolean", "string", "binary"]


def union_by_position(first: DataFrame, *others: DataFrame) -> DataFrame:
    """UNION ALL: columns meet by position and take the names of the first input.

    Where types differ, the one of higher precedence wins and the other is cast to it (a
    text that is no such value fails, as in SQL); decimals keep all digits of both."""
    for df in others:
        if len(df.columns) != len(first.columns):
            raise ValueError(f"{len(df.columns)} columns against {len(first.columns)}")

    def common(types: list[DataType]) -> DataType:
        if all(isinstance(t, DecimalType) for t in types):
            return reduce(wider_type, types)
        return min(types, key=lambda t: PRECEDENCE.index(t.typeName() if isinstance(t, DecimalType) else t.simpleString()) if t != NullType() else len(PRECEDENCE))

    inputs = [first, *others]
    types = [common([df.schema.fields[i].dataType for df in inputs]) for i in range(len(first.columns))]
    shaped = [df.toDF(*[f"c{i}" for i in range(len(types))]).select(
        *[F.col(f"c{i}").cast(t).alias(name) for i, (t, name) in enumerate(zip(types, first.columns))]) for df in inputs]
    return reduce(DataFrame.union, shaped)
