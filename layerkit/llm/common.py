"""Helpers that several operators of this subpackage share."""
from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_run_dir

#: What separates words: space and the bytes 0x09 to 0x0D.
SPACES = b" \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``, giving freed memory back to the system at its end: Python
    workers live on between stages, and what their allocators keep counts for the executor."""
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:  # only some C libraries have it
                trim(0)
    return whole


def quoted(name: str) -> Column:
    """A column by its literal name, dots and back-ticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def as_row(df: DataFrame, name: str = "row") -> Column:
    """All columns of a row as one struct, so that names an operator adds cannot clash."""
    return F.struct(*[quoted(c).alias(c) for c in df.columns]).alias(name)


@contextlib.contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes within go when each has ended; otherwise they stay until
    the driver's JVM happens to collect its garbage, and the steps of a job add up on disk."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def stored(df: DataFrame, spark: SparkSession, tag: str) -> DataFrame:
    """Write ``df`` to a fresh folder below the shared checkpoint folder and read it
    back: cuts the lineage, survives lost executors, is computed once, and leaves no
    shuffle files behind."""
    path = new_run_dir(spark, tag)
    with released(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession, most: int = 1024) -> None:
    """Arrow batches of at most ``most`` rows from now on in this session: whole texts
    travel in them, so their size is what each task holds beside its own work."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if now <= 0 or now > most:
        spark.conf.set(name, str(most))


def fold(key: str = "doc_id") -> Column:
    """crc32 of the key as text, modulo 5 (null: of the empty text)."""
    return F.crc32(F.coalesce(quoted(key).cast("string"), F.lit("")).cast("binary")) % 5


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit values (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def byte_hashes(seed: int) -> np.ndarray:
    """256 odd pseudo-random 64-bit values, made from the seed by splitmix64."""
    with np.errstate(over="ignore"):
        return mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


def string_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without copying; a null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    if col.null_count:
        col = col.fill_null("")
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    body = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None else np.zeros(0, np.uint8)
    return body[offsets[0]:offsets[-1]], offsets - offsets[0]


def text_blocks(batches: Iterator[pa.RecordBatch], column: str, most: int = 1 << 18) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut Arrow batches into slices of about ``most`` bytes of text (a longer text is
    a slice of its own): (slice, bytes, offsets). Bounds the working memory of a task."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        body, offsets = string_buffers(batch.column(batch.schema.get_field_index(column)))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield (batch.slice(first, last - first), body[offsets[first]:offsets[last]],
                   offsets[first:last + 1] - offsets[first])
            first = last
