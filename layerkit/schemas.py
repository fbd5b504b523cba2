"""Declared schemas, conformance and schema assertions."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, ByteType, DataType, DateType, DecimalType, DoubleType, FloatType,
                               IntegerType, LongType, NullType, ShortType, StringType, StructField, StructType,
                               TimestampNTZType, TimestampType)


def parse_ddl(spark, schema: StructType | str) -> StructType:
    """A StructType from a DDL string such as ``"a INT, b STRING"``."""
    if isinstance(schema, StructType):
        return schema
    return spark.createDataFrame([], schema).schema


def conform(df: DataFrame, schema: StructType | str, allow_missing: bool = True) -> DataFrame:
    """Select the declared columns in order, cast to the declared types.

    Missing columns become typed nulls when ``allow_missing`` (schema drift);
    extra columns are dropped.
    """
    schema = parse_ddl(df.sparkSession, schema)
    present = {c.lower(): c for c in df.columns}
    cols = []
    for f in schema.fields:
        src = present.get(f.name.lower())
        if src is None:
            if not allow_missing:
                raise ValueError(f"missing column {f.name!r}")
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.col(f"`{src}`").cast(f.dataType).alias(f.name))
    return df.select(*cols)


def assert_schema(df: DataFrame, schema: StructType, check_nullable: bool = False) -> None:
    """Names and types must match in order (nullability ignored by default:
    everything read back from files is nullable)."""
    got = [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
    exp = [(f.name, f.dataType.simpleString(), f.nullable) for f in schema.fields]
    if not check_nullable:
        got = [g[:2] for g in got]
        exp = [e[:2] for e in exp]
    if got != exp:
        raise AssertionError(f"schema mismatch:\n got {got}\n exp {exp}")


# ---------------------------------------------------------------- schemas that drift

_INTEGERS = [ByteType, ShortType, IntegerType, LongType]


def wider_type(a: DataType, b: DataType) -> DataType:
    """The type that holds the values of both, for columns whose type drifted:
    integers and decimals widen, integers and floats meet in DOUBLE, dates in timestamps,
    structs and arrays field by field; anything else, and text, in STRING."""
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    ints = [type(t) in _INTEGERS for t in (a, b)]
    if all(ints):
        return max(a, b, key=lambda t: _INTEGERS.index(type(t)))
    numbers = [i or isinstance(t, (FloatType, DoubleType, DecimalType)) for i, t in zip(ints, (a, b))]
    if all(numbers):
        if any(isinstance(t, (FloatType, DoubleType)) for t in (a, b)):
            return DoubleType()
        whole = [t if isinstance(t, DecimalType) else DecimalType([3, 5, 10, 20][_INTEGERS.index(type(t))], 0) for t in (a, b)]
        scale = max(t.scale for t in whole)
        digits = max(t.precision - t.scale for t in whole) + scale
        return DecimalType(digits, scale) if digits <= 38 else DoubleType()
    times = (DateType, TimestampNTZType, TimestampType)
    if isinstance(a, times) and isinstance(b, times):
        return max(a, b, key=lambda t: times.index(type(t)))
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        return ArrayType(wider_type(a.elementType, b.elementType))
    if isinstance(a, StructType) and isinstance(b, StructType):
        return merged_schema(a, b)
    return StringType()


def merged_schema(old: StructType, new: StructType) -> StructType:
    """Columns of both by name (case does not matter), old ones first, types widened."""
    found = {f.name.lower(): f for f in new.fields}
    out = []
    for f in old.fields:
        other = found.pop(f.name.lower(), None)
        out.append(StructField(f.name, f.dataType if other is None else wider_type(f.dataType, other.dataType), True))
    return StructType(out + [StructField(f.name, f.dataType, True) for f in found.values()])


GENRE = StructType([StructField("id", IntegerType()), StructField("name", StringType())])

# The movie record fields, names and types as the raw documents declare them.
MOVIE = StructType([
    StructField("Id", LongType()),
    StructField("Title", StringType()),
    StructField("Overview", StringType()),
    StructField("OriginalLanguage", StringType()),
    StructField("Price", DoubleType()),
    StructField("ReleaseDate", TimestampType()),
    StructField("Budget", DoubleType()),
    StructField("Revenue", DoubleType()),
    StructField("RunTime", LongType()),
    StructField("Tagline", StringType()),
    StructField("CreatedBy", StringType()),
    StructField("CreatedDate", TimestampType()),
    StructField("UpdatedBy", StringType()),
    StructField("UpdatedDate", TimestampType()),
    StructField("ImdbUrl", StringType()),
    StructField("TmdbUrl", StringType()),
    StructField("PosterUrl", StringType()),
    StructField("BackdropUrl", StringType()),
    StructField("genres", ArrayType(GENRE)),
])

BRONZE = StructType([
    StructField("Movies", StringType()),
    StructField("Ingesttime", TimestampType()),
    StructField("Status", StringType()),
    StructField("p_Ingestdate", DateType()),
])
