"""Document fingerprints by winnowing.

The hashes of all ``K``-byte grams of a text are rolled in doubling steps; of every
``W`` consecutive hashes the smallest is kept, the rightmost of equal ones, together
with its position. Any passage of at least ``K + W - 1`` bytes that two texts share is
certain to leave a common fingerprint. A text shorter than ``K`` bytes keeps the hash
of the whole text, one with fewer than ``W`` grams the smallest of all.

A fingerprint is a string: base64 of four bytes of hash and one byte of distance from
the position before (at most ``W``) for each kept gram. ``likeness`` is the Jaccard
similarity of the kept hashes.

For the comparison with the following document the corpus is dealt into slices of
consecutive keys; the first document of a slice also travels to the slice before it,
so each document meets its successor with one shuffle and without a global order in
one task.

Defined results: a null text is empty; an empty text has the empty fingerprint, whose
likeness is 1 to an empty one and 0 to any other; null keys come after every other key;
repeated keys are ordered by their text's hash, then by text; one document alone is its own
successor; an empty table gives an empty result; only the named columns are read, so
extra columns cannot clash.
"""
from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_hashes, quoted, text_blocks

K, W = 12, 48
_BYTES = byte_hashes(5)
_BASE = 0x2545F4914F6CDD1D
_LOW = np.uint64((1 << 24) - 1)
#: Bytes hashed at once; a longer text is cut into overlapping stretches.
STRETCH = 1 << 22


def grams(body: np.ndarray, k: int = K) -> np.ndarray:
    """64-bit hash of the k bytes that start at each position."""
    rolled, out, have = _BYTES[body], None, 0
    width = 1
    while width <= k:
        if k & width:
            if out is None:
                out, have = rolled, width
            else:  # `out` covers the bytes after the `width` bytes that `rolled` covers
                n = len(body) - have - width + 1
                out = rolled[:n] * np.uint64(pow(_BASE, have, 1 << 64)) + out[width:width + n]
                have += width
        if width * 2 <= k:
            n = len(body) - 2 * width + 1
            rolled = rolled[:n] * np.uint64(pow(_BASE, width, 1 << 64)) + rolled[width:width + n]
        width *= 2
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(32)
    return out


def window_minima(x: np.ndarray, w: int) -> np.ndarray:
    """Smallest of each w consecutive values, in doubling steps."""
    out, have = x, 1
    while have * 2 <= w:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[:len(out) - (w - have)], out[w - have:]) if have < w else out


def _stretch(body: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) kept in texts that lie at [starts, ends) of ``body``."""
    if len(body) < K:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    hashed = grams(body)
    at = np.arange(len(hashed), dtype=np.uint64)
    packed = (hashed & ~_LOW) | (_LOW - at)  # of equal hashes the rightmost is smallest
    picks = []
    if len(packed) >= W:
        least = window_minima(packed, W)
        inside = np.zeros(len(least) + 1, np.int64)  # windows that lie in one text
        long = ends - starts >= K + W - 1
        np.add.at(inside, starts[long], 1)
        np.add.at(inside, ends[long] - (K + W - 1) + 1, -1)
        kept = least[np.cumsum(inside[:-1]) > 0]
        if len(kept):
            picks.append(kept[np.concatenate(([True], kept[1:] != kept[:-1]))])
    short = np.flatnonzero((ends - starts >= K) & (ends - starts < K + W - 1))
    if len(short):
        picks.append(np.array([packed[starts[i]:ends[i] - K + 1].min() for i in short], np.uint64))
    kept = np.sort((_LOW - (np.concatenate(picks) & _LOW)).astype(np.int64)) if picks else np.zeros(0, np.int64)
    return kept, hashed[kept] >> np.uint64(32)


def winnow(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(positions, 32-bit hashes) of each text."""
    out: list = [None] * len(texts)
    first = 0
    while first < len(texts):
        last, size = first, 0
        while last < len(texts) and (last == first or size + len(texts[last]) <= STRETCH):
            size += len(texts[last])
            last += 1
        if size <= STRETCH:
            sizes = np.array([len(t) for t in texts[first:last]], np.int64)
            ends = np.cumsum(sizes)
            at, hashed = _stretch(np.frombuffer(b"".join(texts[first:last]), np.uint8), ends - sizes, ends)
            cut = np.searchsorted(at, np.concatenate((ends - sizes, ends[-1:])))
            for i, start in enumerate(ends - sizes):
                out[first + i] = (at[cut[i]:cut[i + 1]] - start, hashed[cut[i]:cut[i + 1]])
        else:  # one long text, in stretches that overlap by a window
            body, parts = np.frombuffer(texts[first], np.uint8), []
            for a in range(0, len(body) - (K + W - 2), STRETCH):
                piece = body[a:a + STRETCH + K + W - 2]
                at, hashed = _stretch(piece, np.array([0]), np.array([len(piece)]))
                parts.append(np.stack([at + a, hashed.astype(np.int64)]))
            at, index = np.unique(np.concatenate([p[0] for p in parts]), return_index=True)
            out[first] = (at, np.concatenate([p[1] for p in parts])[index].astype(np.uint64))
        first = last
    for i, text in enumerate(texts):
        if 0 < len(text) < K:
            whole = int.from_bytes(hashlib.blake2b(text, digest_size=4).digest(), "little")
            out[i] = (np.zeros(1, np.int64), np.array([whole], np.uint64))
    return out


def encode(kept: tuple[np.ndarray, np.ndarray]) -> str:
    at, hashed = kept
    cells = np.empty((len(at), 5), np.uint8)
    cells[:, :4] = np.ascontiguousarray(hashed.astype("<u4")).view(np.uint8).reshape(-1, 4)
    cells[:, 4] = np.diff(at, prepend=0)
    return base64.b64encode(cells.tobytes()).decode("ascii")


def decode(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    cells = np.frombuffer(base64.b64decode(fingerprint), np.uint8).reshape(-1, 5)
    return np.cumsum(cells[:, 4].astype(np.int64)), np.ascontiguousarray(cells[:, :4]).view("<u4").ravel().astype(np.uint64)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted arrays of distinct hashes."""
    if len(a) == 0 or len(b) == 0:
        return float(len(a) == len(b))
    both = np.concatenate((a, b))
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return common / (len(both) - common)


def fingerprints(docs: DataFrame, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key and fingerprint of every text."""
    slim = docs.select(quoted(key).alias("key"), quoted(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, body, ends in text_blocks(batches, "text"):
            texts = [body[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([encode(x) for x in winnow(texts)], pa.string())], names=["key", "fingerprint"])

    return slim.mapInArrow(run, f"key {slim.schema['key'].dataType.simpleString()}, fingerprint string")


# ---- each document beside its successor ------------------------------------------

_NULL = np.iinfo(np.int64).min


def _long(col: pa.Array) -> np.ndarray:
    return col.fill_null(_NULL).to_numpy(zero_copy_only=False)


def sliced(docs: DataFrame, text: str, key: str, per_partition: int = 4) -> DataFrame:
    """(slice, guest, key, text): slices of consecutive keys, descending, each ended by
    the first document of the next slice (after the last: of the first)."""
    spark = docs.sparkSession
    slim = docs.select(quoted(key).cast("long").alias("key"), quoted(text).cast("string").alias("text"))
    n = per_partition * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = slim.agg(F.percentile_approx("key", [i / n for i in range(1, n)], 100 * n)).first()[0] or []
    cuts = np.unique(np.array(cuts, np.int64))  # at most n - 1 values

    def number(keys: np.ndarray) -> np.ndarray:
        return len(cuts) - np.searchsorted(cuts, keys, "left")  # large keys first

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top: dict[int, int] = {}
        for b in batches:
            keys = _long(b.column(0))
            for s, k in zip(number(keys).tolist(), keys.tolist()):
                top[s] = max(top.get(s, k), k)
        yield pa.RecordBatch.from_arrays([pa.array(list(top), pa.int32()), pa.array(list(top.values()), pa.int64())], names=["slice", "top"])

    tops = slim.select("key").mapInArrow(ends, "slice int, top long").groupBy("slice").agg(F.max("top")).orderBy("slice").collect()
    # first key of a slice -> the slice before it, which takes that document as its guest
    goes = {top: tops[i - 1][0] for i, (_, top) in enumerate(tops)}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        guests = np.array(sorted(goes), np.int64)
        for b in batches:
            if b.num_rows == 0:
                continue
            keys = _long(b.column(0))
            own = number(keys)
            more = np.flatnonzero(guests[np.minimum(np.searchsorted(guests, keys), len(guests) - 1)] == keys)
            take = pa.array(np.concatenate((np.arange(len(keys)), more)))
            where = np.concatenate((own, [goes[int(k)] for k in keys[more]])).astype(np.int32)
            guest = np.concatenate((np.zeros(len(keys), bool), np.ones(len(more), bool)))
            yield pa.RecordBatch.from_arrays([pa.array(where), pa.array(guest), b.column(0).take(take), b.column(1).take(take)],
                                             names=["slice", "guest", "key", "text"])

    return (slim.mapInArrow(deal, "slice int, guest boolean, key long, text string").repartition("slice")
            .sortWithinPartitions("slice", "guest", F.col("key").desc_nulls_last(), F.xxhash64("text"), "text"))


RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    waiting: list[tuple] = []  # the last row seen, until its successor comes
    for part, _, _ in text_blocks(batches, "text", 1 << 20):
        rows = waiting + list(zip(*(part.column(i).to_pylist() for i in range(4))))
        texts = [r[3] or "" for r in rows]
        own = winnow([t.encode() for t in texts])
        sets = [np.unique(h) for _, h in own]
        at = [i for i in range(len(rows) - 1) if rows[i][0] == rows[i + 1][0] and not rows[i][1]]
        edited = []
        for i in at:
            half = len(texts[i]) // 2
            edited.append((texts[i][:len(texts[i]) - half] + texts[i + 1][:half]).encode())
        other = winnow(edited)
        yield pa.RecordBatch.from_arrays([
            pa.array([rows[i][2] for i in at], pa.int64()), pa.array([len(texts[i]) for i in at], pa.int64()),
            pa.array([hashlib.sha256(e).hexdigest() for e in edited], pa.string()),
            pa.array([encode(own[i]) for i in at], pa.string()), pa.array([encode(x) for x in other], pa.string()),
            pa.array([likeness(sets[i], np.unique(x[1])) for i, x in zip(at, other)], pa.float64()),
            pa.array([likeness(sets[i], sets[i + 1]) for i in at], pa.float64()),
        ], names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
        waiting = rows[-1:]


def query(docs: DataFrame) -> DataFrame:
    return sliced(docs, "text", "doc_id").mapInArrow(_compared, RESULT)
