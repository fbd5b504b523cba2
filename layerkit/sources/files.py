"""File and catalog readers (multi-line JSON documents, parquet, tab text, config)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


# Fixed value: bytes that no JSON text holds (bare control characters, in UTF-8 and UTF-16).
NO_JSON = "\x01\x00\x00\x01"


def layer_path(root: str, layer: str, table: str) -> str:
    """Parameterised dataset location: ``<root>/<layer>/<table>``."""
    return f"{root.rstrip('/')}/{layer.strip('/')}/{table.strip('/')}"


def read_json_array(spark: SparkSession, path: str, field: str = "movie",
                    element_type: str = "STRING", alias: str = "Movies",
                    row_limit: int | None = None) -> DataFrame:
    """Read multi-line JSON documents ``{field: [...]}`` and return one row per element.

    Each file holds one document in UTF-8; with ``element_type='STRING'`` every element comes
    back as its raw JSON text (the bronze record). The schema is declared, never
    inferred, so no extra pass over the files is made. ``row_limit`` is a sampling
    switch for interactive work and is off by default.

    A file is read as one line that ends at ``NO_JSON``. The ``multiline`` option reads the
    same documents, but opens and reads its file again for the raw text of every element.
    """
    docs = (spark.read.option("lineSep", NO_JSON)
            .schema(f"{field} ARRAY<{element_type}>").json(path))
    rows = docs.select(F.explode(F.col(field)).alias(alias))
    return rows.limit(row_limit) if row_limit is not None else rows


def read_typed_json(spark: SparkSession, path: str, schema: StructType | str,
                    multiline: bool = True) -> DataFrame:
    """JSON source with a fully declared (possibly nested) schema."""
    return spark.read.option("multiline", multiline).schema(schema).json(path)


def read_table(spark: SparkSession, name_or_path: str, fmt: str = "parquet",
               schema: StructType | str | None = None) -> DataFrame:
    """Catalog table by name, or a folder of ``fmt`` files when a path is given."""
    if "/" not in name_or_path and ":" not in name_or_path:
        return spark.table(name_or_path)
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(name_or_path)


def read_new(spark: SparkSession, table: str, status: str = "New",
             status_col: str = "Status") -> DataFrame:
    """Incremental scan by status flag; partitioning by the flag prunes whole folders."""
    return read_table(spark, table).filter(F.col(status_col) == status)


def read_tsv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Tab-separated text with a header; every column typed as text."""
    schema = StructType([StructField(c, StringType(), True) for c in columns])
    return (spark.read.option("sep", "\t").option("header", True)
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .schema(schema).csv(path))


CONFIG_SCHEMA = StructType([StructField(c, StringType(), True) for c in (
    "TABLE_NAME", "WaterMark_Column", "TableType",
    "StoredProcedureNameForMergeOperation", "parameterName", "SinkTableName")])


def read_config(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """List of tables to ingest (a handful of rows iterated on the driver).

    JSON Lines by default; ``multiline=True`` for one file holding a JSON array
    (each array element becomes a row)."""
    return spark.read.option("multiline", multiline).schema(CONFIG_SCHEMA).json(path)
