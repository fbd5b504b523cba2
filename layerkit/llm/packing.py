"""Best-fit packing: pattern packing by non-negative least squares.

1. Every text is tokenised, closed with an end id, and cut into pieces of at most
   ``length`` tokens (only a longer document is cut; its first piece may be shorter).
2. The pieces are counted by length: one histogram of at most ``length`` bins.
3. Patterns of two or three lengths that fill a sequence exactly are enumerated, and
   non-negative least squares fits how often each is used to the histogram. The fitted
   counts are rounded by their running sum and clipped to the pieces there are; the
   residual lengths are packed best fit, preferring lengths that complete a sequence.
   All of this works on the histogram: its cost does not grow with the corpus.
4. Each piece gets its rank among the pieces of its length, and the pattern slots of
   that length, laid end to end, say which sequence and offset the rank falls on. The
   slots number at most three for each pattern used, whatever the corpus size.

Defined results: a null text is empty and becomes the end id alone; rows that repeat
are packed separately; a null key is kept; a very long text is encoded as a whole and cut
into as many pieces as it needs; ties are ordered by a hash of key and piece;
an empty table gives an empty result; only the named columns are read, so extra columns
cannot clash.
"""
from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import quoted, stored, text_blocks

LENGTH = 2048
END_ID = 0
#: Fixed value: what the byte-level pre-tokenizer takes as one word.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Encoder:
    """Token ids with one byte-level BPE tokenizer file.

    The file is read by ``tokenizers``; the merges run in ``tiktoken``, which gives the
    same ids several times faster: a token's id is its merge rank in such vocabularies.
    ``ids`` gives what the file's tokenizer gives by default: the string of an added token
    is that token. A call takes such strings as ordinary text. A text that ``tiktoken``
    refuses (about a million blanks on end are too deep for its pattern) is encoded by
    ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer
        tokenizer = self.library = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        special = {t["content"]: t["id"] for t in json.loads(tokenizer.to_str())["added_tokens"]}
        vocabulary = tokenizer.get_vocab(with_added_tokens=False)
        # fixed values: printable bytes stand for themselves, the others for 256, 257, ...
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        letters = {chr(x): x for x in plain} | {chr(256 + i): x for i, x in enumerate(sorted({*range(256)} - {*plain}))}
        ranks = {bytes(letters[c] for c in token): rank for token, rank in vocabulary.items() if token not in special}
        self.encoding = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def __call__(self, text: str) -> np.ndarray:
        return np.array(self.encoding.encode_ordinary(text), "<u4")

    def ids(self, text: str) -> np.ndarray:
        try:
            return np.array(self.encoding.encode(text, allowed_special="all"), "<u4")
        except ValueError:
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def pieces(docs: DataFrame, tokenizer: str, *, text: str = "text", key: str = "doc_id", length: int = LENGTH,
           end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """key, piece, start, length, ids_crc32 and, if asked for, the ids (little-endian
    unsigned 32-bit) of every piece."""
    schema = docs.select(quoted(key).alias("key")).schema.simpleString()[len("struct<"):-1].replace("key:", "key ") \
        + ", piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for part, _, _ in text_blocks(batches, "text", 1 << 20):
            row, piece, start, size, crc, body = [], [], [], [], [], []
            for i, words in enumerate(part.column(1).to_pylist()):
                ids = np.append(enc.ids(words or ""), np.array(end_id, "<u4"))
                cuts = range((len(ids) - 1) % length + 1, len(ids) + 1, length)
                a = 0
                for k, b in enumerate(cuts):
                    raw = ids[a:b].tobytes()
                    row.append(i)
                    piece.append(k)
                    start.append(a)
                    size.append(b - a)
                    crc.append(zlib.crc32(raw))
                    body.append(raw if with_ids else None)
                    a = b
            cols = [part.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                    pa.array(size, pa.int64()), pa.array(crc, pa.int64())]
            names = ["key", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                cols, names = [*cols, pa.array(body, pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return docs.select(quoted(key).alias("key"), quoted(text).cast("string").alias("text")).mapInArrow(run, schema)


# ---- the plan, on the histogram -------------------------------------------------

def patterns(length: int, present: np.ndarray) -> np.ndarray:
    """Rows of three lengths (0: no third piece), largest first, that fill ``length``
    exactly and of which all occur."""
    has = np.zeros(length + 1, bool)
    has[present] = True
    rows = []
    for a in present[present < length]:
        b = np.arange((length - a + 1) // 2, min(a, length - a) + 1)
        c = length - a - b
        ok = (b >= 1) & has[b] & (has[c] | (c == 0)) & (c <= b)
        if ok.any():
            rows.append(np.stack([np.full(ok.sum(), a), b[ok], c[ok]], 1))
    return np.concatenate(rows) if rows else np.zeros((0, 3), np.int64)


def fit(rows: np.ndarray, counts: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Non-negative x that minimises |A x - counts|, where A counts the lengths of each
    pattern: accelerated projected gradient steps."""
    goal = counts.astype(float).copy()
    goal[0] = 0

    def forward(x):
        y = np.bincount(rows.ravel(), np.repeat(x, 3), len(goal))
        y[0] = 0
        return y

    def back(r):
        r[0] = 0
        return r[rows].sum(1)

    v = np.ones(len(rows))
    for _ in range(12):
        v = back(forward(v))
        size = np.linalg.norm(v)
        v /= size
    x = y = np.zeros(len(rows))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(y - back(forward(y) - goal) / (1.02 * size), 0)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t2 * (new - x)
        x, t = new, t2
    return x


def best_fit(left: np.ndarray, length: int) -> list[tuple[tuple[int, ...], int]]:
    """Pack the histogram ``left`` (changed in place): the largest length first, then
    one or two lengths that complete the sequence, else the largest that fits."""
    out = []
    top = length
    while True:
        while top and not left[top]:
            top -= 1
        if not top:
            return out
        used, space = [top], length - top
        left[top] -= 1
        while space:
            if left[space]:
                used.append(space)
                left[space] -= 1
                break
            low = np.arange(1, space // 2 + 1)
            pair = np.flatnonzero((left[low] > 0) & (left[space - low] > (space - low == low)))
            if len(pair):
                b = int(low[pair[-1]])
                used += [space - b, b]
                left[b] -= 1
                left[space - b] -= 1
                break
            fits = np.flatnonzero(left[1:space + 1])
            if not len(fits):
                break
            used.append(int(fits[-1]) + 1)
            left[used[-1]] -= 1
            space -= used[-1]
        sizes, need = np.unique(used, return_counts=True)
        more = int((left[sizes] // need).min())
        left[sizes] -= more * need
        out.append((tuple(used), 1 + more))


def plan(counts: np.ndarray, length: int = LENGTH) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, how many such sequences); counts[n]: pieces of length n."""
    left = counts.astype(np.int64).copy()
    out = []
    rows = patterns(length, np.flatnonzero(left))
    if len(rows):
        x = fit(rows, left)
        order = np.argsort(-x, kind="stable")
        order = order[x[order] > 1e-9]
        total = np.floor(np.cumsum(x[order]) + 0.5).astype(np.int64)
        times = np.diff(total, prepend=0)
        for k in np.flatnonzero(times):
            used = rows[order[k]][rows[order[k]] > 0]
            sizes, need = np.unique(used, return_counts=True)
            n = int(min(times[k], (left[sizes] // need).min()))
            if n:
                left[sizes] -= n * need
                out.append((tuple(int(u) for u in used), n))
    return out + best_fit(left, length)


def slots(sequences: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, int]:
    """Rows (length, first rank, first sequence, offset), sorted; number of sequences."""
    rows, used, base = [], {}, 0
    for lengths, n in sequences:
        offset = 0
        for size in lengths:
            rows.append((size, used.get(size, 0), base, offset))
            used[size] = used.get(size, 0) + n
            offset += size
        base += n
    return np.array(sorted(rows), np.int64).reshape(-1, 4), base


def pack(cut: DataFrame, spark: SparkSession, length: int = LENGTH, buckets: int = 256) -> DataFrame:
    """``cut`` (a stored table of pieces) with sequence_id and offset."""
    short = cut.where(F.col("length") < length).withColumn("_bucket", F.pmod(F.xxhash64("key", "piece"), F.lit(buckets)))
    groups = short.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    counts = np.zeros(length + 1, np.int64)
    for size, n in groups.groupBy("length").agg(F.sum("_rows")).collect():  # at most `length` rows
        counts[size] = n
    table, base = slots(plan(counts, length))
    shared = spark.sparkContext.broadcast(((table[:, 0] << 40) + table[:, 1], table))
    running = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = groups.select("length", "_bucket", F.coalesce(F.sum("_rows").over(running), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("length", "_bucket").orderBy("key", "piece", "start", "ids_crc32")
    ranked = (short.withColumn("_rank", F.row_number().over(inside) - 1).join(offsets, ["length", "_bucket"])
              .select(*cut.columns, (F.col("_rank") + F.col("_before")).alias("_rank")))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema) + ", sequence_id long, offset long"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, rows = shared.value
        for b in batches:
            size = b.column(b.schema.get_field_index("length")).to_numpy()
            rank = b.column(b.schema.get_field_index("_rank")).to_numpy()
            at = rows[np.searchsorted(keys, (size << 40) + rank, "right") - 1] if len(rows) else np.zeros((0, 4), np.int64)
            cols = [b.column(i) for i in range(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(at[:, 2] + rank - at[:, 1]), pa.array(at[:, 3])],
                                             names=[*b.schema.names[:-1], "sequence_id", "offset"])

    full = (cut.where(F.col("length") >= length)
            .withColumn("sequence_id", F.lit(base).cast("long") + F.monotonically_increasing_id())
            .withColumn("offset", F.lit(0).cast("long")))
    return ranked.mapInArrow(place, fields).unionByName(full)


def query(docs: DataFrame, tokenizer: str) -> DataFrame:
    spark = docs.sparkSession
    cut = stored(pieces(docs, tokenizer), spark, "packing-pieces")
    return pack(cut, spark).withColumnRenamed("key", "doc_id")
