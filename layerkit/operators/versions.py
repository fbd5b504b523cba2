"""Tables whose content is replaced without overwriting a file.

New content is always written to a fresh folder; what makes it current is one small step
at the end: the rename of a pointer file (``publish``), or the catalog's location of a
table or partition (``replace_table``, ``replace_partitions``). A failure anywhere before
that step leaves the old version as it was, and a repeated run starts from it. Since no
file is overwritten, the new content may be computed from the table it replaces, without
a checkpoint in between. Single writer per table is assumed; a version is deleted only
after the next has become current, so a query that began on it may have to be repeated.
"""
from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import folders

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"  # fixed value: the folder name of a null

# ---------------------------------------------------------------- by path


def _versions(root: str) -> str:
    return f"{root.rstrip('/')}-versions"


def current_path(spark: SparkSession, root: str) -> str:
    """Folder of the current version; ``root`` itself while nothing was published."""
    name = folders.read_text(spark, f"{_versions(root)}/CURRENT")
    return f"{_versions(root)}/{name}" if name else root


def read_published(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(current_path(spark, root))


def publish(df: DataFrame, root: str, keep: int = 2) -> str:
    """Write ``df`` as a new version of the small table at ``root`` and point to it.

    Versions older than the last ``keep`` are deleted afterwards, and so are folders
    that a failed run left behind."""
    spark = df.sparkSession
    base, before = _versions(root), current_path(spark, root)
    name = f"v-{uuid.uuid4().hex}"
    df.coalesce(1).write.parquet(f"{base}/{name}")
    history = [name] + [h for h in (folders.read_text(spark, f"{base}/HISTORY") or "").split("\n") if h]
    folders.write_text(spark, f"{base}/CURRENT", name)
    kept = ([name, before.rsplit("/", 1)[1], *history[1:]] if before != root else [name])
    kept = list(dict.fromkeys(kept))[:keep]
    folders.write_text(spark, f"{base}/HISTORY", "\n".join(kept))
    for folder in folders.children(spark, base):
        child = folder.rsplit("/", 1)[1]
        if child.startswith("v-") and child not in kept:
            folders.remove(spark, folder)
    return f"{base}/{name}"


# ---------------------------------------------------------------- by catalog name

def _fresh_folder(spark: SparkSession, table: str) -> str:
    """A never used folder beside the table's database."""
    db, name = table.split(".", 1) if "." in table else (spark.catalog.currentDatabase(), table)
    root = spark.catalog.getDatabase(db).locationUri
    return f"{root.rstrip('/')}/_{name}_versions/v-{uuid.uuid4().hex}"


def table_folder(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def replace_table(df: DataFrame, table: str) -> None:
    """New content of an unpartitioned catalog table (created when it is absent)."""
    spark = df.sparkSession
    folder = _fresh_folder(spark, table)
    df.write.parquet(folder)
    if not spark.catalog.tableExists(table):
        spark.catalog.createTable(table, path=folder, source="parquet", schema=df.schema)
        return
    before = table_folder(spark, table)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(table)
    folders.remove(spark, before)


def _spec(values: dict[str, str]) -> str:
    parts = []
    for c, v in values.items():
        v = _unescaped(v).replace("\\", "\\\\").replace("'", "\\'")
        parts.append(f"`{c}`=NULL" if v == NULL_PARTITION else f"`{c}`='{v}'")
    return ", ".join(parts)


def _unescaped(value: str) -> str:
    return unquote(value)


def listed_partitions(spark: SparkSession, table: str) -> list[dict[str, str]]:
    """Partition values as the catalog lists them (one entry for each partition)."""
    return [dict(part.split("=", 1) for part in r[0].split("/")) for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]


def _partition_folder(spark: SparkSession, table: str, values: dict[str, str]) -> str:
    """Where a partition lies. The default name of a null needs its own spelling here."""
    spec = ", ".join(f"`{c}`='{_unescaped(v)}'" for c, v in values.items())
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION ({spec})").where("col_name = 'Location'").collect()
    return rows[0]["data_type"]  # the partition's own place is listed first, then the table's


def add_partitions(df: DataFrame, table: str, columns: list[str]) -> list[dict[str, str]]:
    """Append ``df`` as partitions that the table does not have yet: written to a fresh
    folder, then listed in the catalog by one statement. Returns their values."""
    spark = df.sparkSession
    folder = _fresh_folder(spark, table)
    df.write.partitionBy(*columns).parquet(folder)
    made = folders.partition_folders(spark, folder, columns)
    if made:
        spark.sql(f"ALTER TABLE {table} ADD " + " ".join(f"PARTITION ({_spec(v)}) LOCATION '{p}'" for v, p in made))
        spark.catalog.refreshTable(table)
    return [v for v, _ in made]


def replace_partitions(df: DataFrame, table: str, columns: list[str], emptied: list[dict[str, str]] = ()) -> None:
    """Replace the partitions that have rows in ``df``; drop those of ``emptied`` that have none.

    Each partition changes by one catalog update, after all new files are written;
    partitions that ``df`` does not name keep their files."""
    spark = df.sparkSession
    folder = _fresh_folder(spark, table)
    typed = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in spark.table(table).schema.fields]
    df.select(*typed).write.partitionBy(*columns).parquet(folder)
    made = folders.partition_folders(spark, folder, columns)
    present = {_spec(v): v for v in listed_partitions(spark, table)}
    old = []
    for values, place in made:
        if _spec(values) in present:
            old.append(_partition_folder(spark, table, values))
            spark.sql(f"ALTER TABLE {table} PARTITION ({_spec(values)}) SET LOCATION '{place}'")
        else:
            spark.sql(f"ALTER TABLE {table} ADD PARTITION ({_spec(values)}) LOCATION '{place}'")
    written = {_spec(v) for v, _ in made}
    for values in emptied:
        if _spec(values) not in written and _spec(values) in present:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({_spec(values)})")
    spark.catalog.refreshTable(table)
    whole = table_folder(spark, table).rstrip("/")
    for place in old:
        if place.rstrip("/") != whole:
            folders.remove(spark, place)


