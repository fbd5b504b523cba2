"""Files and folders of a table through Hadoop's file system, wherever the table lies."""
from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder with all it holds; nothing happens when it is absent."""
    _fs(spark, path).delete(_path(spark, path), True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Full paths of what a folder holds, sorted (empty when it is absent)."""
    if not exists(spark, path):
        return []
    return sorted(s.getPath().toString() for s in _fs(spark, path).listStatus(_path(spark, path)))


def data_files(spark: SparkSession, path: str) -> list[str]:
    """All data files below a folder (hidden and marker files left out), sorted."""
    out = []
    if exists(spark, path):
        found = _fs(spark, path).listFiles(_path(spark, path), True)
        while found.hasNext():
            p = found.next().getPath()
            if not p.getName().startswith(("_", ".")):
                out.append(p.toString())
    return sorted(out)


def partition_folders(spark: SparkSession, path: str, columns: list[str]) -> list[tuple[dict[str, str], str]]:
    """({column: value as in the folder name}, folder) of every partition below ``path``."""
    level = [({}, path)]
    for c in columns:
        level = [({**values, c: child.rsplit("/", 1)[1][len(c) + 1:]}, child)
                 for values, folder in level for child in children(spark, folder)
                 if child.rsplit("/", 1)[1].startswith(f"{c}=")]
    return level


def move(spark: SparkSession, source: str, target: str, overwrite: bool = False) -> None:
    """Rename a file; with ``overwrite`` the target is replaced in the same step."""
    jvm = spark._jvm
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, int(overwrite))
    if overwrite:
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    place = _path(spark, target)
    _fs(spark, target).mkdirs(place.getParent())
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(_path(spark, source), place, options)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file that appears whole or not at all: written aside, then renamed."""
    aside = f"{path}.new"
    out = _fs(spark, aside).create(_path(spark, aside), True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    move(spark, aside, path, overwrite=True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """Content of a small text file, or None when it is absent."""
    if not exists(spark, path):
        return None
    return "\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect())
