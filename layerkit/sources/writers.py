"""Sinks: partitioned batch writers, table registration, JSON/Parquet files."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from ..schemas import conform, merged_schema
from .folders import children


def batch_writer(df: DataFrame, partition_column: str | None, exclude_columns=(),
                 mode: str = "append", fmt: str = "parquet",
                 files_per_partition: int | None = None) -> DataFrameWriter:
    """An un-saved writer: drop excluded columns, partition by one column.

    No shuffle by default: every task writes its rows into the folders of the
    values it holds. A low-cardinality partition column (an ingest date shared by
    a whole run) must not become a shuffle key, or one task would write it all.
    ``files_per_partition=k`` spreads each value over ``k`` tasks (hash of the row)
    when many small input tasks would otherwise leave too many small files.
    """
    out = df.drop(*exclude_columns)
    if partition_column and files_per_partition:
        salt = F.pmod(F.hash(*[F.col(c) for c in out.columns]), F.lit(files_per_partition))
        out = out.repartition(F.col(partition_column), salt)
    writer = out.write.format(fmt).mode(mode)
    if partition_column:
        writer = writer.partitionBy(partition_column)
    return writer


def lookup_writer(df: DataFrame, exclude_columns=(), mode: str = "append",
                  fmt: str = "parquet") -> DataFrameWriter:
    """Writer for small unpartitioned lookup tables."""
    return df.drop(*exclude_columns).write.format(fmt).mode(mode)


def write_batch(df: DataFrame, path_or_table: str, partition_by: str | None = None,
                exclude=(), mode: str = "append") -> None:
    writer = batch_writer(df, partition_by, exclude, mode)
    if "/" in path_or_table or ":" in path_or_table:
        writer.option("compression", "snappy").save(path_or_table)
    else:
        writer.saveAsTable(path_or_table)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: str | None = None) -> None:
    """Snappy parquet sink of one schema; ``write_run`` is the one whose columns may drift."""
    writer = df.write.mode(mode).option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


RUN = "run="  # folder of one run below the sink


def write_run(df: DataFrame, path: str, run: str) -> None:
    """Sink whose columns and types may drift from run to run: each run writes its own
    folder (a repeated run replaces it) in whatever schema it has."""
    write_parquet(df, f"{path.rstrip('/')}/{RUN}{run}")


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """All runs as one table, in the merged schema (``schemas.merged_schema``): a column
    that a run does not have is null there, a drifted type is widened.

    Schemas come from the files' footers, in the order of the runs; runs that agree are
    read by one scan, so the plan has as many branches as there are different schemas."""
    kinds: dict[str, tuple] = {}
    for folder in children(spark, path):
        if folder.rsplit("/", 1)[1].startswith(RUN):
            schema = spark.read.parquet(folder).schema
            kinds.setdefault(schema.json(), (schema, []))[1].append(folder)
    if not kinds:
        raise FileNotFoundError(f"no runs below {path}")
    whole = reduce(merged_schema, [schema for schema, _ in kinds.values()])
    return reduce(DataFrame.unionByName, [conform(spark.read.schema(schema).parquet(*paths), whole) for schema, paths in kinds.values()])


def write_json(df: DataFrame, path: str, mode: str = "overwrite",
               partition_by: str | None = None) -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.json(path)


def register_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet",
                   partitioned: bool = False) -> None:
    """(Re)register a catalog table over an existing folder."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name, path=path, source=fmt)
    if partitioned:
        spark.catalog.recoverPartitions(name)


def write_bucketed(df: DataFrame, table: str, key: str | list[str], buckets: int,
                   sort: bool = True, mode: str = "overwrite") -> None:
    """Save a catalog table hash-bucketed (and sorted) by ``key``.

    Two tables bucketed by their join key into the same number of buckets join
    without shuffling either side (each bucket pair is joined locally), and an
    aggregation by the key needs no exchange. Worth it for tables joined on the
    same key run after run (orders / lines by order key); pick ``buckets`` so a
    bucket file stays a few hundred MB.
    """
    keys = [key] if isinstance(key, str) else list(key)
    writer = df.write.mode(mode).format("parquet").bucketBy(buckets, *keys)
    if sort:
        writer = writer.sortBy(*keys)
    writer.saveAsTable(table)
