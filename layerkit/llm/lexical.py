"""Ranked lexical search over a K2-treap of the term-document grid.

1. The terms of a block of items (bounded in number and size; more items make more
   blocks) are the rows of the grid. One pass over all documents counts the documents
   that have terms, all their terms, and for each row the documents that hold it.
2. In a second pass every task deals its documents into shards. A shard's cells are its
   (term, document) pairs with their impact, the part of the score that needs no term
   weight. Cells are sorted in Morton order (row bit, column bit, row bit, ...), and from
   the cells up each level keeps one entry for every quadrant that holds any: the mask of
   its four children, where they begin, and the largest impact below it. Empty quadrants
   take no space. Columns are ordered by document length, so near columns have near
   impacts; rows by first appearance in the items, so an item's own terms lie together.
3. An item descends from the root along the paths of all its rows at once: a state is a
   range of documents together with, for each row, the quadrant that covers row and
   range, and its bound is the weighted sum of their maxima. States are taken best first
   from a heap, ``BATCH`` at a time, and split into two halves of their range; one document
   wide, the bound is the score. A state below the item's k-th best score so far is
   dropped; that score is carried on through all shards of a task.
4. Each task hands out at most k documents for each item; they are cut to k in two rounds.

The result is exact: bounds never lie below a score, and equal ones are followed.

Defined results: terms, weights and scores as the module's SQL; a null text, of a
document or an item, has no terms; repeated rows of documents are ranked each, repeated
rows of items answered each; equal scores by ascending key, a null key last; items
without a match give no row; empty tables give none; long texts are read in stretches;
only the named columns are read, so extra columns cannot clash.
"""
from __future__ import annotations

import heapq
import math
from bisect import insort
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import quoted, tidy
from .runs import runs, stretches

K = 20
BLOCK_ITEMS, BLOCK_BYTES = 2048, 1 << 22  # items, and bytes of their texts, answered by one pass (on average)
SHARD_DOCS, SHARD_CELLS = 4096, 1 << 21
STRETCH, BATCH, SALTS = 1 << 20, 64, 64

# The bytes of terms (letters, digits and all of a non-ASCII character).
TERM = np.array([48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])


@dataclass
class Block:
    """A block of items: their terms are the rows of the grid."""
    ids: pa.Array          # of the items
    words: pa.Array        # row -> term
    rows: list[np.ndarray]     # item -> its rows
    repeats: list[np.ndarray]  # item -> how often each occurs


def read_block(items: pa.Table) -> Block:
    """Rows are numbered by first appearance."""
    known: dict[bytes, int] = {}
    rows, repeats = [], []
    for text in items.column("text"):
        body = np.frombuffer((text.as_py() or "").encode(), np.uint8)
        values, _, _ = runs(body, np.array([0, len(body)]), TERM)
        some = np.array([known.setdefault(v, len(known)) for v in values.to_pylist()], np.int64)
        row, times = np.unique(some, return_counts=True)
        rows.append(row)
        repeats.append(times)
    return Block(items.column("id").combine_chunks(), pa.array(known, pa.large_binary()), rows, repeats)


def counted(batches: Iterator[pa.RecordBatch], words: pa.Array, stretch: int = STRETCH) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each slice of texts: the slice, each text's number of terms, and its cells as
    (text, row, occurrences). A long text is one slice, put together from its stretches."""
    def joined(group):
        part, sizes, cells = group[0][0], sum(g[1] for g in group), [c for g in group for c in g[2]]
        if not cells:
            return part, sizes, *[np.zeros(0, np.int64)] * 3
        key, times = (np.concatenate(x) for x in zip(*cells))
        if len(cells) > 1:
            key, at = np.unique(key, return_inverse=True)
            times = np.bincount(at, times).astype(np.int64)
        return part, sizes, key // max(len(words), 1), key % max(len(words), 1), times

    open_ = []
    for part, body, offsets in stretches(batches, "text", TERM, stretch):
        values, _, heads = runs(body, offsets, TERM)
        code = pc.index_in(values, value_set=words).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(heads))
        has = code >= 0
        cells = [np.unique(text[has] * len(words) + code[has], return_counts=True)] if has.any() else []
        if open_ and open_[0][0] is not part:
            yield joined(open_)
            open_ = []
        open_.append((part, np.diff(heads), cells))
    if open_:
        yield joined(open_)


class Treap:
    """Compressed quadtree over cells (row, column, value): see the module."""

    def __init__(self, row: np.ndarray, column: np.ndarray, value: np.ndarray, height: int):
        self.height = height
        code = np.zeros(len(row), np.uint64)
        for bit in range(height):
            code |= ((row >> bit & 1) << (2 * bit + 1) | (column >> bit & 1) << (2 * bit)).astype(np.uint64)
        order = np.argsort(code)
        code, value = code[order], value[order]
        #: level -> (mask of children, first child, largest value); level 0 is the root.
        self.mask, self.first, self.top = [], [], [value]
        for _ in range(height):
            up = code >> np.uint64(2)
            begin = np.flatnonzero(np.append(True, up[1:] != up[:-1]))
            self.mask.append(np.bitwise_or.reduceat(np.left_shift(1, (code & np.uint64(3)).astype(np.uint8)).astype(np.uint8), begin))
            self.first.append(begin)
            self.top.append(np.maximum.reduceat(self.top[-1], begin))
            code = up[begin]
        for levels in (self.mask, self.first, self.top):
            levels.reverse()

    def halves(self, level: int, nodes: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Children of ``nodes`` (-1: none) that cover each row's half (``low``: its bit at this
        level) and the left, then the right half of the columns; and their largest values."""
        mask, first = self.mask[level][nodes], self.first[level][nodes]
        child = np.empty((2, *nodes.shape), np.int64)
        for right in (0, 1):
            quarter = 2 * low + right
            below = first + _ONES[mask & ((1 << quarter) - 1)]
            child[right] = np.where((nodes >= 0) & (mask >> quarter & 1 == 1), below, -1)
        return child, np.where(child >= 0, self.top[level + 1][child], 0)


_ONES = np.array([bin(x).count("1") for x in range(16)])


def search(treap: Treap, rows: np.ndarray, weight: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(columns, scores) of the documents found, best bound first. The caller sends the
    score that a document must reach from now on."""
    height = treap.height
    start = np.zeros(len(rows), np.int64)
    heap = [(-int(weight.sum()) * int(treap.top[0][0]), 0, 0, start)]
    while heap and -heap[0][0] >= least:
        taken: dict[int, list] = {}
        for _ in range(BATCH):
            if not heap or -heap[0][0] < least:
                break
            _, level, column, nodes = heapq.heappop(heap)
            taken.setdefault(level, []).append((column, nodes))
        for level, states in taken.items():
            nodes = np.stack([s[1] for s in states])
            columns = np.array([s[0] for s in states])
            child, value = treap.halves(level, nodes, rows >> (height - 1 - level) & 1)
            bound = value @ weight
            for right in (0, 1):
                good = np.flatnonzero(bound[right] >= least)
                if level + 1 == height:
                    if len(good):
                        least = yield columns[good] * 2 + right, bound[right][good]
                    continue
                for i in good:
                    heapq.heappush(heap, (-int(bound[right][i]), level + 1, int(columns[i]) * 2 + right, child[right][i]))


def _shards(batches: Iterator[pa.RecordBatch], words: pa.Array, docs: int, terms: int, most: int, stretch: int) -> Iterator[tuple[pa.Array, Treap]]:
    """(keys by column, treap of impacts) of the documents, some thousand at a time."""
    held, n_docs, n_cells = [], 0, 0

    def built():
        keys = pa.concat_arrays([h[0] for h in held])
        size = np.concatenate([h[1] for h in held])
        base = np.cumsum([0] + [len(h[1]) for h in held])
        text = np.concatenate([h[2] + b for h, b in zip(held, base)])
        row, times = np.concatenate([h[3] for h in held]), np.concatenate([h[4] for h in held])
        order = np.argsort(size, kind="stable")
        column = np.empty(len(size), np.int64)
        column[order] = np.arange(len(size))
        m = np.array([100 - 25 + 25 * int(s) * docs // terms for s in size], np.int64)
        impact = 1_000_000_000 * times // (1000 * times + 12 * m[text])
        height = max(int(max(len(words), len(size)) - 1).bit_length(), 1)
        return keys.take(pa.array(order)), Treap(row, column[text], impact, height)

    for part, size, text, row, times in counted(batches, words, stretch):
        if not len(text):
            continue
        held.append((part.column(0), size, text, row, times))
        n_docs, n_cells = n_docs + len(size), n_cells + len(text)
        if n_docs >= most or n_cells >= SHARD_CELLS:
            yield built()
            held, n_docs, n_cells = [], 0, 0
    if held:
        yield built()


def _answer(docs: DataFrame, block: Block, k: int, shard: int, stretch: int) -> DataFrame | None:
    """(item, item_id, doc_id, score): at most k documents of each task for each item."""
    spark = docs.sparkSession
    words = block.words

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(len(words) + 2, np.int64)
        for _, size, _, row, _ in counted(batches, words, stretch):
            held[:-2] += np.bincount(row, minlength=len(words))
            held[-2] += np.count_nonzero(size)
            held[-1] += size.sum()
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at])], names=["row", "n"])

    found = np.zeros(len(words) + 2, np.int64)
    for r in docs.mapInArrow(tidy(count), "row long, n long").groupBy("row").agg(F.sum("n").alias("n")).collect():
        found[r["row"]] = r["n"]
    n_docs, n_terms = int(found[-2]), int(found[-1])
    if not n_terms:
        return None
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(df) + 1))) for df in found[:-2]], np.int64)
    key_type = docs.schema["key"].dataType.simpleString()
    shared = spark.sparkContext.broadcast(block)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        top: list[list] = [[] for _ in block.rows]
        kind = None
        for keys, treap in _shards(batches, block.words, n_docs, n_terms, shard, stretch):
            kind = keys.type
            for item, (rows, repeats) in enumerate(zip(block.rows, block.repeats)):
                have, gain = top[item], weight[rows] * repeats
                if not gain.any():
                    continue
                least = -have[-1][0] if len(have) == k else 1
                finding = search(treap, rows, gain, least)
                some = next(finding, None)
                while some is not None:
                    for column, score in zip(*some):
                        name = keys[int(column)].as_py()
                        entry = (-int(score), name is None, 0 if name is None else name)
                        if len(have) < k or entry < have[-1]:
                            insort(have, entry)
                            del have[k:]
                    if len(have) == k:
                        least = -have[-1][0]
                    try:
                        some = finding.send(least)
                    except StopIteration:
                        some = None
        if kind is not None:
            item = [i for i, have in enumerate(top) for _ in have]
            names = [None if none else name for have in top for _, none, name in have]
            scores = [-score for have in top for score, _, _ in have]
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(names, kind), pa.array(scores, pa.int64())],
                                             names=["item", "doc_id", "score"])

    answers = docs.mapInArrow(tidy(best), f"item long, doc_id {key_type}, score long")
    names = spark.createDataFrame(pa.table({"at": pa.array(range(len(block.ids)), pa.int64()), "item_id": block.ids}))
    return answers.join(F.broadcast(names), F.col("item") == F.col("at")).select("item", "item_id", "doc_id", "score")


def query(docs: DataFrame, items: DataFrame, *, text: str = "text", key: str = "doc_id", item_text: str = "text",
          item_key: str = "item_id", k: int = K, shard: int = SHARD_DOCS, block: int = BLOCK_ITEMS, stretch: int = STRETCH) -> DataFrame:
    """item_id, rank, doc_id, score: each item's k highest-scoring documents."""
    docs = docs.select(quoted(key).alias("key"), quoted(text).cast("string").alias("text"))
    items = items.select(quoted(item_key).alias("id"), quoted(item_text).cast("string").alias("text"))
    size = items.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    blocks = max(-(-size["n"] // block), -(-size["bytes"] // BLOCK_BYTES), 1)
    parts = []
    for b in range(blocks):  # a block's items are bounded on average, and meet all documents in one pass
        some = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b) if blocks > 1 else items
        answers = _answer(docs, read_block(some.toArrow()), k, shard, stretch)
        if answers is not None:
            parts.append(answers.withColumn("block", F.lit(b)))
    if not parts:
        return docs.sparkSession.createDataFrame([], f"item_id {items.schema['id'].dataType.simpleString()}, rank int, "
                                                     f"doc_id {docs.schema['key'].dataType.simpleString()}, score long")
    every = reduce(DataFrame.union, parts).withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    some = every.withColumn("rank", F.row_number().over(Window.partitionBy("block", "item", "salt").orderBy(*order))).where(f"rank <= {k}")
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("block", "item").orderBy(*order))).where(f"rank <= {k}")
    return ranked.select("item_id", "rank", "doc_id", "score")


SQL = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
item AS (
  SELECT row_number() OVER () AS i, item_id,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
wanted AS (SELECT i, item_id, term, count(*) AS times FROM item GROUP BY ALL),
total AS (SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM doc WHERE len(terms) > 0),
cell AS (SELECT r, doc_id, len(terms) AS n, term, count(*) AS tf
         FROM (SELECT r, doc_id, terms, unnest(terms) AS term FROM doc) GROUP BY ALL),
weight AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
           FROM cell, total WHERE term IN (SELECT term FROM wanted) GROUP BY term, n_docs),
scored AS (
  SELECT i, item_id, r, doc_id,
         sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * n_docs) // n_terms)))))::BIGINT AS score
  FROM cell JOIN weight USING (term) JOIN wanted USING (term), total GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""
