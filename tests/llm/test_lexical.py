"""Ranked search against brute force over the whole grid."""
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as E
from layerkit.llm import lexical
from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k=20):
    split = [(key, terms(text)) for key, text in docs]
    n_docs, n_terms = sum(bool(t) for _, t in split), sum(len(t) for _, t in split)
    df = Counter(t for _, ts in split for t in set(ts))
    out = []
    for item, text in items:
        scores = []
        for key, ts in split:
            tf, score = Counter(ts), 0
            for t in terms(text):
                if tf[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * (1_000_000_000 * tf[t] // (1000 * tf[t] + 12 * (75 + 25 * len(ts) * n_docs // n_terms)))
            if score > 0:
                scores.append((-score, key is None, key or 0, key))
        out += [(item, rank, key, -score) for rank, (score, _, _, key) in enumerate(sorted(scores)[:k], 1)]
    return out


def made(seed=5):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(120)] + ["été", "ÉTÉ", "日本", "Straße", "x1"]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 60))) for _ in range(150)]
    texts += [texts[4]] * 30 + [texts[9].upper(), None, "", "...", "w1 " * 3000, "z" * 5000, "unseen-only"]
    rows = [(i, t, "key", "row") for i, t in enumerate(texts)] + [(7, texts[7], None, None), (None, texts[4], None, None)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 25))), "s") for i in range(25)]
    items += [(25, texts[4], "s"), (25, texts[4], "s"), (26, None, "s"), (27, "", "s"), (28, "nowhere", "s"), (None, "w1 W1 w2", "s")]
    return rows, items


@pytest.fixture(scope="module")
def frames(spark):
    rows, items = made()
    return (spark.createDataFrame(rows, "doc_id long, text string, key string, row string").repartition(5),
            spark.createDataFrame(items, "item_id long, text string, salt string"), rows, items)


def got(df):
    return sorted(map(repr, map(tuple, df.select("item_id", "rank", "doc_id", "score").collect())))


def test_equals_brute_force(frames):
    docs, items, rows, asked = frames
    want = sorted(map(repr, brute([r[:2] for r in rows], [r[:2] for r in asked])))
    assert got(lexical.query(docs, items)) == want


def test_small_shards_stretches_and_blocks_change_nothing(frames):
    docs, items, rows, asked = frames
    want = sorted(map(repr, brute([r[:2] for r in rows], [r[:2] for r in asked], 7)))
    assert got(lexical.query(docs, items, k=7, shard=16, block=9, stretch=64)) == want


def test_empty_tables(frames):
    docs, items, *_ = frames
    assert lexical.query(docs.limit(0), items).collect() == []
    assert lexical.query(docs, items.limit(0)).collect() == []
    assert lexical.query(docs, items).dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]


def test_treap_holds_every_cell_and_its_maxima():
    rng = np.random.default_rng(2)
    cells = np.unique(rng.integers(0, 64, (300, 2)), axis=0)
    value = rng.integers(1, 1000, len(cells))
    treap = lexical.Treap(cells[:, 0], cells[:, 1], value, 6)
    assert int(treap.top[0][0]) == value.max() and len(treap.top[6]) == len(cells)
    for row in range(64):
        found = {}
        for columns, scores in lexical.search(treap, np.array([row]), np.array([1]), 1):
            found.update(zip(columns.tolist(), scores.tolist()))
            break
        assert all(found[c] == v for (r, c), v in zip(cells.tolist(), value.tolist()) if r == row and c in found)
        assert bool(found) == bool((cells[:, 0] == row).any())


def test_registered_query_matches_its_sql(spark):
    res = compare(spark, "op11_lexical", E.queries()["op11_lexical"], E.oracle_sql()["op11_lexical"], SF_SMALL, duck(SF_SMALL))
    assert res["ok"], res
