"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics of many texts are computed at once with numpy over Arrow buffers. The
trees are grown level by level on quantile histograms of a bounded sample of labelled
rows outside fold 0 (``labelled.MOST`` for each label), then flattened into arrays
(feature, threshold, children, value) that are traversed for all rows and trees at once.

Defined results: a null or empty text has statistics of 0 and is scored like any
other; without labelled rows of both kinds every score is the share of label 1 (0.5
without any); rows that repeat are scored alike; an empty table gives an empty result;
only the named columns are read, so extra columns cannot clash; key, language and
source are no inputs.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import labelled
from .common import fold, quoted, text_blocks
from .words import words

BINS, TREES, DEPTH, RATE, LEAF = 64, 60, 5, 0.15, 10.0
#: Byte classes whose share of a text is a statistic.
CLASSES = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digit": b"0123456789",
           "stop": b".", "comma": b",", "space": b" \t", "line": b"\n", "bang": b"!?", "bar": b"|", "sign": b"#$%&*@^~=+<>",
           "bracket": b"()[]{}", "slash": b"/\\_", "quote": b"'\"`", "high": bytes(range(128, 256))}
STATISTICS = ["log_bytes", *CLASSES, "log_words", "word_size", "word_size_sd", "longest_word", "distinct_words", "same_as_before",
              "distinct_pairs", "one_letter", "line_size", "distinct_lines", "most_common_word", "cased_words"]

_CLASS = np.full(256, len(CLASSES), np.int64)
for _i, _bytes in enumerate(CLASSES.values()):
    _CLASS[list(_bytes)] = _i
_UPPER = np.zeros(256, bool)
_UPPER[list(CLASSES["upper"])] = True


def statistics(body: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of STATISTICS for each text at ``offsets`` of ``body``."""
    n, kinds = len(offsets) - 1, len(CLASSES) + 1
    sizes = np.diff(offsets)
    owner = np.repeat(np.arange(n), sizes)
    share = np.bincount(owner * kinds + _CLASS[body], minlength=n * kinds).reshape(n, kinds)[:, :-1] / np.maximum(sizes, 1)[:, None]
    hashed, starts, length, heads = words(body, offsets, lower=False)
    count = np.diff(heads)
    some = np.maximum(count, 1)
    of = np.repeat(np.arange(n), count)
    mean = np.bincount(of, length, n) / some
    spread = np.sqrt(np.maximum(np.bincount(of, length.astype(float) ** 2, n) / some - mean ** 2, 0))
    again = np.zeros(len(hashed), bool)
    pair = np.zeros(len(hashed), np.uint64)
    if len(hashed) > 1:
        again[1:] = (hashed[1:] == hashed[:-1]) & (of[1:] == of[:-1])
        pair[1:] = hashed[1:] * np.uint64(3) + hashed[:-1]
    lines = np.flatnonzero(body == 10)
    cased = _UPPER[body[starts]] & (length > 1) & _UPPER[body[np.minimum(starts + 1, max(len(body) - 1, 0))]]
    rest = np.zeros((n, 8))
    for i in range(n):
        a, b = heads[i], heads[i + 1]
        if a == b:
            continue
        k = b - a
        ordered = np.sort(hashed[a:b])
        new = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
        rest[i, 0] = length[a:b].max()
        rest[i, 1] = len(new) / k
        rest[i, 2] = len(np.unique(pair[a + 1:b])) / max(k - 1, 1)
        rest[i, 3] = np.diff(np.append(new, k)).max() / k
    bounds = np.searchsorted(lines, offsets)
    for i in np.flatnonzero(np.diff(bounds)):
        cuts = np.concatenate(([offsets[i]], lines[bounds[i]:bounds[i + 1]] + 1, [offsets[i + 1]]))
        parts = [body[x:y].tobytes().rstrip(b"\n") for x, y in zip(cuts[:-1], cuts[1:])]
        rest[i, 4] = len(set(parts)) / len(parts)
    n_lines = np.diff(bounds) + 1
    return np.column_stack([
        np.log1p(sizes), share, np.log1p(count), mean, spread, np.log1p(rest[:, 0]), rest[:, 1],
        np.bincount(of, again, n) / some, rest[:, 2], np.bincount(of, length == 1, n) / some, np.log1p(sizes / n_lines),
        rest[:, 4], rest[:, 3], np.bincount(of, cased, n) / some])


@dataclass
class Forest:
    """Trees side by side in flat arrays; a leaf is its own child on both sides."""
    base: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = np.full(len(x), self.base)
        if len(self.roots) and len(x):
            at = np.broadcast_to(self.roots, (len(x), len(self.roots)))
            rows = np.arange(len(x))[:, None]
            for _ in range(self.depth):
                at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            raw = raw + self.value[at].sum(1)
        return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def quantiles(x: np.ndarray, weight: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Quantiles of weighted values, between neighbours by straight lines."""
    order = np.argsort(x, kind="stable")
    before = np.cumsum(weight[order]) - weight[order]
    return np.interp(at * before[-1], before, x[order])


def grow(x: np.ndarray, y: np.ndarray, weight: np.ndarray, *, bins: int = BINS, trees: int = TREES, depth: int = DEPTH, rate: float = RATE,
         leaf: float = LEAF, ridge: float = 1.0) -> Forest:
    """Boosted trees for labels 0 and 1 by second-order gains on histograms of weighted
    rows. The weights are scaled to a mean of 1: ``leaf`` and ``ridge`` are in rows seen."""
    n = len(y)
    weight = weight / weight.mean() if n else weight
    mean = float(np.average(y, weights=weight)) if n else 0.5
    none = np.zeros(0, np.int64)
    if not n or not 0 < mean < 1:
        edge = float(np.clip(mean, 0.02, 0.98))
        return Forest(np.log(edge / (1 - edge)), none, none, none.astype(float), none, none, none.astype(float), 0)
    cuts = [np.unique(quantiles(x[:, f], weight, np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    coded = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], 1)  # bin b: x <= cuts[b]
    many = x.shape[1]
    cell = coded + np.arange(many) * bins
    base = np.log(mean / (1 - mean))
    raw = np.full(n, base)
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def node() -> int:
        for column, start in ((feature, 0), (threshold, np.inf), (value, 0.0)):
            column.append(start)
        left.append(len(left))
        right.append(len(right))
        return len(left) - 1

    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = weight * (y - p), weight * p * (1 - p)
        root = node()
        roots.append(root)
        at, level = np.zeros(n, np.int64), [root]
        for _ in range(depth):
            k = len(level)
            where = (at[:, None] * (many * bins) + cell)[at >= 0].ravel()
            hist = [np.bincount(where, np.repeat(v[at >= 0], many), k * many * bins).reshape(k, many, bins) for v in (g, h)]
            G, H = (v.cumsum(2) for v in hist)
            tg, th = G[:, :1, -1:], H[:, :1, -1:]
            gain = G ** 2 / (H + ridge) + (tg - G) ** 2 / (th - H + ridge) - tg ** 2 / (th + ridge)
            gain[(H < leaf / 10) | (th - H < leaf / 10)] = 0
            for f, c in enumerate(cuts):
                gain[:, f, len(c):] = 0
            best = gain.reshape(k, -1).argmax(1)
            move = np.full((k, 2), -1, np.int64)
            following = []
            for i, name in enumerate(level):
                f, b = divmod(int(best[i]), bins)
                if gain[i, f, b] <= 1e-6:
                    continue
                feature[name], threshold[name] = f, float(cuts[f][b])
                a, c = node(), node()
                left[name], right[name] = a, c
                move[i] = len(following), len(following) + 1
                for child, gs, hs in ((a, G[i, f, b], H[i, f, b]), (c, tg[i, 0, 0] - G[i, f, b], th[i, 0, 0] - H[i, f, b])):
                    value[child] = rate * gs / (hs + ridge)
                    following.append(child)
            f, b = np.divmod(best, bins)
            live = at >= 0
            node_of = np.where(live, at, 0)
            side = (coded[np.arange(n), f[node_of]] > b[node_of]).astype(np.int64)
            nxt = move[node_of, side]
            stop = live & (nxt < 0)
            raw[stop] += np.array(value)[np.array(level)[at[stop]]]
            at = np.where(live, nxt, -1)
            level = following
            if not level:
                break
        live = at >= 0
        if live.any():
            raw[live] += np.array(value)[np.array(level)[at[live]]]
    return Forest(base, np.array(roots), np.array(feature), np.array(threshold), np.array(left), np.array(right), np.array(value), depth)


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, body, offsets in text_blocks(batches, "text"):
        rows = statistics(body, offsets)
        yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(3), pa.array(list(rows), pa.list_(pa.float64()))],
                                         names=["key", "label", "weight", "x"])


def fitted(docs: DataFrame, labels: DataFrame) -> Forest:
    rows = labelled.sample(docs, labels, "quality", tag="quality-sample")
    kind = rows.schema["key"].dataType.simpleString()
    seen = rows.select("key", "label", "text", "weight").mapInArrow(_measured, f"key {kind}, label int, weight double, x array<double>").toPandas()  # the bounded sample
    seen = seen.sort_values(["key", "label"], kind="stable")
    x = np.array(seen["x"].to_list(), float).reshape(-1, len(STATISTICS))
    return grow(x, seen["label"].to_numpy(float), seen["weight"].to_numpy(float))


def score(docs: DataFrame, forest: Forest, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    slim = docs.select(quoted(key).alias("key"), quoted(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, body, offsets in text_blocks(batches, "text"):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(forest.score(statistics(body, offsets)))], names=["key", "score"])

    return slim.mapInArrow(run, f"key {slim.schema['key'].dataType.simpleString()}, score double")


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fitted(docs, labels)).select(
        F.col("key").alias("doc_id"), (fold("key") == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
