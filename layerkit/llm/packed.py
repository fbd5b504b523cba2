"""Hashes moved between tasks as packed rows, one for each bucket of leading hash bits."""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, tidy

SCHEMA = "bucket int, hash binary, tag binary, count binary"
#: Bits of a map of hashes, and the most that one may have.
MAP_BITS, MOST_BITS = 1 << 27, 1 << 29
#: Rows of a list of the most frequent hashes; any other hash holds less than 1 / TOP of all.
TOP = 1 << 18


def bucket_count(spark) -> int:
    """A power of two, at least four for each shuffle partition."""
    return max(1024, 1 << (4 * int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())


def map_bits(hashes: int) -> int:
    """Bits of a map for so many hashes: a bit for each, from ``MAP_BITS`` to ``MOST_BITS``."""
    return min(max(MAP_BITS, 1 << max(0, hashes - 1).bit_length()), MOST_BITS)


def bucket_shift(buckets: int) -> np.uint64:
    return np.uint64(64 - buckets.bit_length() + 1)


class Packed:
    """Hashes, with or without a tag, gathered over a task and let out as rows of
    packed bytes: distinct (hash, tag) pairs with how often they came, or with
    ``least`` each hash once with its smallest tag."""

    def __init__(self, buckets: int, least: bool = False, most: int = 1 << 18):
        self.shift, self.least, self.most = bucket_shift(buckets), least, most
        self.held: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.held.append(columns)
        self.size += len(columns[0])
        if self.size >= self.most:
            yield from self.out()

    def out(self) -> Iterator[pa.RecordBatch]:
        if not self.size:
            return
        columns = [np.concatenate(c) for c in zip(*self.held)]
        self.held, self.size = [], 0
        if len(columns) == 1:
            columns[0].sort()
        else:
            order = np.lexsort(columns[::-1])
            columns = [c[order] for c in columns]
        by = columns[:1] if self.least else columns
        new = np.flatnonzero(np.concatenate(([True], np.any([c[1:] != c[:-1] for c in by], 0))))
        count = np.diff(np.append(new, len(columns[0]))).astype(np.uint32)
        columns = [c[new] for c in columns]
        bucket = (columns[0] >> self.shift).astype(np.int64)
        for once in (True, False):  # most come once: their counts are left out
            some = np.flatnonzero((count == 1) == once)
            if not len(some):
                continue
            heads, first = np.unique(bucket[some], return_index=True)
            cuts = np.append(first, len(some))
            blobs = [[c[some[a:b]].tobytes() for a, b in zip(cuts[:-1], cuts[1:])] for c in columns]
            counts = [None if once else count[some[a:b]].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
            tags = blobs[1] if len(blobs) > 1 else [None] * len(heads)
            yield pa.RecordBatch.from_arrays([pa.array(heads.astype(np.int32)), pa.array(blobs[0], pa.binary()), pa.array(tags, pa.binary()),
                                              pa.array(counts, pa.binary())], names=["bucket", "hash", "tag", "count"])


def bucketed(rows: DataFrame) -> DataFrame:
    return rows.repartition("bucket").sortWithinPartitions("bucket")


def each_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """The rows of one bucket at a time, of a partition sorted by bucket."""
    now, held = None, []
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns)):
            if row[0] != now and held:
                yield now, held
                held = []
            now = row[0]
            held.append(row[1:])
    if held:
        yield now, held


def unpacked(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """hash, tag (0 where there is none) and count of a bucket's rows."""
    hashes = [np.frombuffer(r[0], np.uint64) for r in rows]
    tags = [np.frombuffer(r[1], np.int64) if r[1] is not None else np.zeros(len(h), np.int64) for r, h in zip(rows, hashes)]
    counts = [np.frombuffer(r[2], np.uint32) if r[2] is not None else np.ones(len(h), np.uint32) for r, h in zip(rows, hashes)]
    return np.concatenate(hashes), np.concatenate(tags), np.concatenate(counts).astype(np.int64)


def totals(hashes: np.ndarray, tags: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct hashes with their summed count, smallest and largest tag."""
    order = np.argsort(hashes, kind="stable")
    hashes = hashes[order]
    first = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1])))
    return (hashes[first], np.add.reduceat(counts[order], first), np.minimum.reduceat(tags[order], first), np.maximum.reduceat(tags[order], first))


def most_frequent(packed: DataFrame, least: int, top: int = TOP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, count, smallest tag) of the at most ``top`` hashes with the largest counts,
    ``least`` at least, sorted by hash."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in each_bucket(batches):
            hashes, total, low, _ = totals(*unpacked(rows))
            many = total >= least
            yield pa.RecordBatch.from_arrays([pa.array(hashes[many].view(np.int64)), pa.array(total[many]), pa.array(low[many])], names=["hash", "count", "low"])

    found = (bucketed(packed).mapInArrow(tidy(count), "hash long, count long, low long")
             .orderBy(F.col("count").desc(), "hash").limit(top).toPandas())
    hashes = found["hash"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], found["count"].to_numpy(np.int64)[order], found["low"].to_numpy(np.int64)[order]


def map_and_top(packed: DataFrame, keep: Callable, least: int, buckets: int, tag: str, top: int = TOP, size: int | None = None) -> tuple[np.ndarray, ...]:
    """Bit map (by leading hash bits, ``size`` of them or ``MAP_BITS``) of the hashes that ``keep``
    (count, low, high) passes, and of those the most frequent: (map, hashes sorted, counts, smallest tags)."""
    size = size or MAP_BITS
    width = size // buckets

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in each_bucket(batches):
            hashes, total, low, high = totals(*unpacked(rows))
            good = keep(total, low, high)
            hashes, total, low = hashes[good], total[good], low[good]
            bits = np.zeros(width, bool)
            bits[top_bits(hashes, size) - bucket * width] = True
            many = total >= least
            yield pa.RecordBatch.from_arrays(
                [pa.array([bucket], pa.int32()), pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary()),
                 pa.array([hashes[many].view(np.int64)], pa.list_(pa.int64())), pa.array([total[many]], pa.list_(pa.int64())),
                 pa.array([low[many]], pa.list_(pa.int64()))],
                names=["bucket", "bits", "hashes", "counts", "lows"])

    spark = packed.sparkSession
    counted = stored(bucketed(packed).mapInArrow(tidy(count), "bucket int, bits binary, hashes array<long>, counts array<long>, lows array<long>"), spark, tag)
    bits = np.zeros((buckets, width // 8), np.uint8)
    for r in counted.select("bucket", "bits").toLocalIterator():  # ``size`` bits in all
        bits[r["bucket"]] = np.frombuffer(r["bits"], np.uint8)
    often = (counted.select(F.explode(F.arrays_zip("hashes", "counts", "lows")).alias("x")).select("x.*")
             .orderBy(F.col("counts").desc(), "hashes").limit(top).toPandas())
    hashes = often["hashes"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return bits.ravel(), hashes[order], often["counts"].to_numpy(np.int64)[order], often["lows"].to_numpy(np.int64)[order]


def top_bits(hashes: np.ndarray, size: int = MAP_BITS) -> np.ndarray:
    """Place of each hash in a map of ``size`` bits."""
    return (hashes >> np.uint64(64 - (size.bit_length() - 1))).astype(np.int64)


def in_map(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def look_up(table: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which hashes are in the sorted ``table``, and where."""
    if not len(table):
        return np.zeros(len(hashes), bool), np.zeros(len(hashes), np.int64)
    at = np.minimum(np.searchsorted(table, hashes), len(table) - 1)
    return table[at] == hashes, at
