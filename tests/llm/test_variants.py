"""Spelling variants against brute force over all pairs of words."""
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as E
from layerkit.llm import variants
from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] or a[i + 1:] == b[i:] or a[i:] == b[i + 1:]


def counts(rows):
    out = Counter()
    for key, text in rows:
        for run in RUN.findall(text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            out[run[:h % len(run)] + run[h % len(run) + 1:] if h % 199 == 0 else run] += 1
    return {w: n for w, n in out.items() if len(w) >= 6 and n >= 5}


def brute(words):
    form, out = {}, []
    for w, n in words.items():
        others = [(-words[o], o) for o in words if near(w, o)]
        best = min(others, default=None)
        form[w] = best[1] if best and -best[0] >= 5 * n else None
        out.append([w, len(others)])
    rows = []
    for w, n_near in out:
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, form[w], root, words[w], n_near, words.get(form[w])))
    return rows


def got(df):
    return sorted(map(repr, map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect())))


def made(seed=4):
    rng = random.Random(seed)
    stems = ["".join(rng.choices("abcéñÿ", k=rng.randint(6, 12))) for _ in range(40)] + ["aaaaaaa", "aaaaaa", "aaaaaaaa", "ababab", "bababab"]
    words = []
    for i, s in enumerate(stems):
        words += [s] * (300 if i % 7 == 0 else 40)
        for _ in range(4):
            k = rng.randrange(len(s))
            words += [rng.choice([s[:k] + s[k + 1:], s[:k] + rng.choice("abz") + s[k:], s[:k] + rng.choice("abz") + s[k + 1:]])] * rng.choice([5, 9, 60])
    rng.shuffle(words)
    texts = [" ".join(words[i:i + 25]) for i in range(0, len(words), 25)]
    texts += [None, "", "Á1É2", "日本 aaaaaaa×bababab", "q" * 70_000 + " " + "tail " * 5, "AAAAAAA-Éaaaaaa " * 20_000, texts[3].upper()]
    return [(i, t, "w", "n") for i, t in enumerate(texts)] + [(3, texts[3], None, None), (None, texts[4], None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(made(), "doc_id long, text string, word string, n string").repartition(4)


def test_equals_brute_force(docs):
    rows = brute(counts([r[:2] for r in made()]))
    assert any(r[1] for r in rows) and any(r[1] and r[2] != r[1] for r in rows)
    assert got(variants.query(docs)) == sorted(map(repr, rows))


def test_small_stretches_buffers_and_tables_change_nothing(docs):
    words = variants.word_counts(docs, stretch=50, distinct=3)
    assert got(variants.variants(words, slots=3)) == sorted(map(repr, brute(counts([r[:2] for r in made()]))))


def test_empty_tables_and_words_without_near_ones(spark, docs):
    assert variants.query(docs.limit(0)).collect() == []
    words = spark.createDataFrame([("abcdef", 5), ("uvwxyz", 25), ("bcdefg", 5)], "word string, n long")
    assert sorted(map(tuple, variants.variants(words).select("word", "form", "root", "n", "n_near", "form_n").collect())) == [
        ("abcdef", None, "abcdef", 5, 0, None), ("bcdefg", None, "bcdefg", 5, 0, None), ("uvwxyz", None, "uvwxyz", 25, 0, None)]


def test_near_pairs_of_random_words(spark):
    rng = random.Random(8)
    words = sorted({"".join(rng.choices("ab", k=rng.randint(4, 9))) for _ in range(250)} | {"".join(rng.choices("abcd日é", k=6)) for _ in range(250)})
    from layerkit.llm.common import stored
    frame = stored(spark.createDataFrame([(w, 1) for w in words], "word string, n long"), spark, "test-words")
    pairs = [tuple(r) for r in variants.near_pairs(frame).collect()]
    assert sorted(pairs) == [(a, b) for i, a in enumerate(words) for b in words[i + 1:] if near(a, b)]


def test_pivots_are_the_cheapest_disjoint_places():
    rng = random.Random(6)
    for _ in range(500):
        places = sorted(rng.sample(range(12), rng.randint(3, 7)))
        count = [rng.randint(1, 9) for _ in places]
        best = min(((count[i] + count[j]), (p, q)) for i, p in enumerate(places) for j, q in enumerate(places) if q >= p + 2)
        assert tuple(variants.pivots(places, count)) == best[1]


def test_crc_of_runs():
    rng = random.Random(7)
    runs = ["".join(rng.choices("abé", k=rng.choice([1, 3, 40, 64, 65, 200]))).encode() for _ in range(300)]
    before = np.array([zlib.crc32(f"{i}:".encode()) for i in range(300)], np.uint32)
    assert variants.crc_of_runs(pa.array(runs, pa.large_binary()), before).tolist() == [zlib.crc32(r, int(b)) for r, b in zip(runs, before)]


def test_registered_query_matches_its_sql(spark):
    res = compare(spark, "op13_variants", E.queries()["op13_variants"], E.oracle_sql()["op13_variants"], SF_SMALL, duck(SF_SMALL))
    assert res["ok"], res
