"""The training-data operators against brute force, on small made frames with nulls,
empty and long texts, ties, repeated rows, empty tables and clashing column names."""
import hashlib
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from layerkit.llm import chat, graph, jaccard, labelled, mixing, packing, quality, queries, suffixes, toxicity, warc, winnow
from layerkit.llm.common import stored
from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, size string, id string"


def texts():
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(400)] + ["été", "straße", "ñu"]
    base = [" ".join(rng.choice(vocabulary, int(n))) for n in rng.integers(1, 160, 60)]
    passage = " ".join(rng.choice(vocabulary, 40))
    rows = base + [base[3], base[3].upper(), base[7] + " tail", base[9] + " " + passage, passage + " x", "a" + passage]
    for k in range(12):  # near copies of one text
        words = base[int(np.argmax([len(b) for b in base]))].split(" ")
        words[(7 * k) % len(words)] = f"edit{k}"
        rows.append(" ".join(words))
    return rows + [None, "", " \t\n", "one", "one two three four", "z" * 5000, "é" * 300, ("long " * 9000) + "end"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", [None, "b", "a", "c"][i % 4], None if t is None else len(t), "r", "s", "i") for i, t in enumerate(texts())]
    rows += [rows[5], (None, "a null id " * 9, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def as_pairs(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


def test_mixing_reaches_its_targets_and_agrees_with_itself(docs):
    rows = mixing.query(docs).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, mixing.query(docs.repartition(3)).collect()))
    by = {}
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"]
        s = by.setdefault((r["source_size"], r["target"]), [0, 0])
        s[0] += r["taken"]
        s[1] = max(s[1], r["size"])
    assert abs(sum(t for _, t in by) - 1.5 * sum(r["size"] for r in rows)) < 1e-6
    for (size, target), (taken, largest) in by.items():
        assert target <= 2 * size and abs(taken - target) <= 2 * largest
    emitted = mixing.emit(mixing.mix(docs))
    assert emitted.columns == docs.columns and emitted.count() == sum(r["copies"] for r in rows)


def brute_suffixes(pairs):
    seen = {}
    last = lambda d: float("inf") if d is None else d
    for d, t in pairs:
        b = (t or "").encode()
        for g in {b[i:i + 50] for i in range(len(b) - 49)}:
            seen[g] = min(seen.get(g, float("inf")), last(d))
    out = []
    for d, t in pairs:
        b = (t or "").encode()
        cover = bytearray(len(b))
        for i in range(len(b) - 49):
            if seen[b[i:i + 50]] < last(d):
                cover[i:i + 50] = b"\1" * 50
        kept = bytes(x for x, c in zip(b, cover) if not c)
        out.append((d, len(b), sum(cover), len(re.findall(rb"\x01+", bytes(cover))), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("often", [8192, 3])
def test_suffixes_match_brute_force(docs, often, monkeypatch):
    monkeypatch.setattr(suffixes, "OFTEN", often)
    monkeypatch.setattr(suffixes, "BLOCK", 4000)
    monkeypatch.setattr(suffixes, "STRETCH", 7000)
    assert sorted(map(tuple, suffixes.query(docs).collect()), key=repr) == brute_suffixes(as_pairs(docs))
    clean = suffixes.deduplicated(docs)
    assert clean.columns == docs.columns and clean.count() == docs.count()


def test_minimizer_hashes_fill_all_buckets_alike():
    rng = np.random.default_rng(5)
    body = rng.integers(97, 123, 200_000, dtype=np.uint8)
    hashed = suffixes.minimizers(body, np.array([0]), np.array([len(body)]))[3]
    held = np.bincount((hashed >> np.uint64(60)).astype(np.int64), minlength=16)
    assert held.max() < 1.2 * held.mean()  # the smallest hashes of 27 lie in the first of 16 parts, mostly


def test_a_map_of_more_hashes_has_more_bits():
    from layerkit.llm import packed
    assert [packed.map_bits(n) for n in (0, 10**8, 1 << 28, (1 << 28) + 1, 10**12)] == [1 << 27, 1 << 27, 1 << 28, 1 << 29, 1 << 29]


def test_stored_steps_leave_no_shuffle_files(spark):
    kept = lambda: {f.getName() for f in spark._jvm.java.util.ArrayList(spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(
        spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles())) if f.getName().startswith("shuffle_")}
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = kept(), spark.conf.get(name)
    out = stored(spark.range(20_000).repartition(7, "id").groupBy(F.col("id") % 9).count(), spark, "test-released")
    assert out.count() == 9
    for _ in range(50):
        if not (left := {f for f in kept() - before if f.endswith(".data")}):
            break
        time.sleep(0.1)
    assert len(left) <= 1  # that of the count, of one partition
    assert spark.conf.get(name) == setting


def test_chat_masks_are_the_speakers_own_words(spark):
    turns = spark.createDataFrame([(1, 0, "ann", "hi"), (1, 1, "bob", None), (1, 2, None, "x y"), (1, 2, None, "x y"), (None, 0, "ann", "")],
                                  "conv_id long, turn long, role string, text string")
    whole = {(r["dialogue"], r["perspective"]): r for r in chat.rendered(chat.segments(turns)).collect()}
    assert set(whole) == {(1, "ann"), (1, "bob"), (1, "unknown"), (None, "ann")}
    own = {k: [r["text"][s["start"]:s["end"]] for s in r["spans"]] for k, r in whole.items()}
    assert own[1, "ann"] == ["hi"] and own[1, "bob"] == [""] and own[1, "unknown"] == ["x y", "x y"]
    assert whole[1, "bob"]["text"].startswith("<|im_start|>user name=ann\nhi<|im_end|>\n<|im_start|>assistant\n")


def test_grammar_weighs_clauses():
    g = toxicity.Grammar(toxicity.seeds())
    plain, aimed = g.evidence("what an idiot"), g.evidence("you idiot")
    assert aimed > plain > g.evidence("he is not an idiot") and g.evidence("she said he is an idiot") < g.evidence("he is an idiot")
    assert g.evidence("kill you") > g.evidence("kill time") and g.evidence("") == 0 == g.evidence("you never said it")
    assert 0 <= g.score("") < g.score("you idiot, you moron")


def made_words(n, seed=5):
    rng = np.random.default_rng(seed)
    return sorted({"".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 7)) for _ in range(n)})


def test_toxic_texts_that_share_a_word_all_teach():
    rng = np.random.default_rng(6)
    body = [" ".join(["es", *rng.choice(made_words(500), 30)]) for _ in range(60)]
    copies = [b + " tail" for b in body[:20]] + body[:10]
    assert toxicity.apart(list(toxicity.sketches(body + copies))) == list(range(60))
    long = " ".join(rng.choice(made_words(500), 3000))
    found = list(toxicity.sketches([long, long + " end", long[:len(long) // 2], "", " "]))
    assert toxicity.apart(found) == [0, 2, 3] and abs(toxicity.resemblance(found[0], found[2]) - 0.5) < 0.1


def test_toxic_words_are_learned_from_texts_with_one_common_word(spark):
    rng = np.random.default_rng(7)
    shared, *others = sorted(made_words(300), key=lambda w: zlib.crc32(w.encode()) * 0x9E3779B1 & 0xFFFFFFFF)
    rows = [(y, " ".join([shared, *rng.choice(others, 20), *["zorg"] * y])) for y in [1] * 40 + [0] * 200]
    assert any(w.startswith("zor") for w in toxicity.learn(spark.createDataFrame(rows, "label int, text string").withColumn("weight", F.lit(1.0))).lexicon)


def test_a_word_of_a_small_share_of_the_toxic_texts_is_learned(spark):
    rng = np.random.default_rng(9)
    words = made_words(900)
    rows = [(y, " ".join([*rng.choice(words, 20), *["zorg" if i < 20 else "grob"] * y]), 1.0) for y in (0, 1) for i in range(1000)]
    learned = set(toxicity.learn(spark.createDataFrame(rows, "label int, text string, weight double")).lexicon) - set(toxicity.seeds())
    assert any(w.startswith("zor") for w in learned) and any(w.startswith("gro") for w in learned)  # zorg: 2%
    assert len(learned) <= 6  # words that chance puts into toxic texts are not


@pytest.mark.parametrize("operator", [toxicity, quality])
def test_a_small_sample_gives_the_scores_of_the_whole_fit(spark, operator, monkeypatch):
    monkeypatch.setattr(toxicity, "features", lambda text: set())  # seeds alone: the sample moves the curve only
    rng = np.random.default_rng(8)
    name, rare, mark = ("toxic", 1, "you idiot") if operator is toxicity else ("quality", 0, "## $$ ## $$")
    rows, vocabulary = [], made_words(200)
    for i in range(6000):  # the mark is a hint only: borderline texts of both labels
        y = int(rng.random() < 0.1)
        rows.append((i, " ".join(rng.choice(vocabulary, 25)) + (" " + mark if rng.random() < (0.5 if y else 0.1) else ""), rare if y else 1 - rare))
    table = stored(spark.createDataFrame(rows, f"doc_id long, text string, {name} int"), spark, "test-weights")
    mean = []
    for most in (6000, 400):
        monkeypatch.setitem(labelled.sample.__kwdefaults__, "most", most)
        mean.append({r[0]: r[1] for r in operator.query(table, table).join(table, "doc_id").groupBy(F.contains("text", F.lit(mark))).agg(F.avg("score")).collect()})
    assert all(abs(mean[0][k] - mean[1][k]) < 0.12 for k in (False, True)), mean


@pytest.mark.parametrize("operator", [toxicity, quality])
def test_classifiers_on_held_out_rows_and_odd_ones(spark, docs, operator):
    sf = "/root/testdata/sf0.1"
    docs_, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    label = "toxic" if operator is toxicity else "quality"
    rows = operator.query(docs_, labels).join(labels, "doc_id").where("held_out").select("predicted", F.col(label).alias("y")).collect()
    assert np.mean([r["predicted"] == r["y"] for r in rows]) > 0.97
    odd = operator.query(docs, labels.limit(0)).collect()  # nothing to learn from
    assert len(odd) == docs.count() and all(0 <= r["score"] <= 1 for r in odd)


def test_winnowing_keeps_window_minima(docs, monkeypatch):
    rng = np.random.default_rng(1)
    body = [bytes(rng.integers(97, 100, n, dtype=np.uint8)) for n in (0, 1, 11, 12, 40, 59, 60, 61, 500)] + [b"a" * 300]
    got = winnow.winnow(body)
    for text, (at, hashed) in zip(body, got):
        if len(text) >= winnow.K:
            h = [int(winnow.grams(np.frombuffer(text[i:i + winnow.K], np.uint8))[0]) >> 24 for i in range(len(text) - winnow.K + 1)]
            w = min(winnow.W, len(h))
            want = sorted({max(j for j in range(i, i + w) if h[j] == min(h[i:i + w])) for i in range(len(h) - w + 1)})
            assert at.tolist() == want and hashed.tolist() == [h[j] >> 8 for j in want]
    monkeypatch.setattr(winnow, "STRETCH", 64)
    assert all((a[0] == b[0]).all() and (a[1] == b[1]).all() for a, b in zip(got, winnow.winnow(body)))
    rows = winnow.query(docs).collect()
    assert len(rows) == docs.count()
    prints = {}
    for r in winnow.fingerprints(docs).join(docs.select(F.col("doc_id").alias("key"), "text"), "key").collect():
        assert prints.setdefault(r["text"] or "", r["fingerprint"]) == r["fingerprint"]


def test_edited_texts_follow_the_next_document(spark):
    pairs = [(i, t) for i, t in enumerate(texts())]
    rows = {r["doc_id"]: r for r in winnow.query(spark.createDataFrame(pairs, "doc_id long, text string").repartition(4)).collect()}
    for i, t in pairs:
        t, nxt = t or "", (pairs[i - 1][1] or "")
        half = len(t) // 2
        assert rows[i]["edited_sha256"] == hashlib.sha256((t[:len(t) - half] + nxt[:half]).encode()).hexdigest() and rows[i]["n_chars"] == len(t)


def test_packing_is_gapless_and_tight(docs):
    rows = packing.query(docs, queries.tokenizer_path()).collect()
    sequences, whole = {}, 0
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        whole += r["length"]
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.LENGTH
    assert len(sequences) <= -(-whole // packing.LENGTH) + 2
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    tokenizer.encode_special_tokens = True
    for t in [*texts(), "<|endoftext|> a  b\n\n c  d"]:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        assert packing.encoder(queries.tokenizer_path())(t or "").tolist() == ids
    first = {(r["doc_id"], r["piece"]): r for r in rows}
    ids = np.array([*tokenizer.encode("one", add_special_tokens=False).ids, 0], "<u4")
    doc = [i for i, t in enumerate(texts()) if t == "one"][0]
    assert first[doc, 0]["ids_crc32"] == zlib.crc32(ids.tobytes())


def test_packing_gives_the_ids_of_the_tokenizer_by_default(spark):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    made = [t for t in texts() if t] + ["<|endoftext|>", "a <|endoftext|> b", "<|endoftext|><|endoftext|>\n x", "<|endoftext| >", " <|endoftext|>\n\n c"]
    table = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    got = {r["key"]: b"" for r in table.select(F.col("doc_id").alias("key")).collect()}
    for r in packing.pieces(table, queries.tokenizer_path(), with_ids=True).orderBy("key", "piece").collect():
        got[r["key"]] += bytes(r["ids"])
    for i, t in enumerate(made):
        assert np.frombuffer(got[i], "<u4").tolist() == [*tokenizer.encode(t, add_special_tokens=False).ids, packing.END_ID], t


def brute_components(pairs):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for d, t in pairs:
        w = WORD.findall((t or "").translate(low))
        sets[d] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set()
    top = {d: d for d in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x
    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                top[y] = x
    return {d: (len(s), find(d)) for d, s in sets.items()}


@pytest.mark.parametrize("small", [False, True])
def test_jaccard_matches_brute_force(docs, small, monkeypatch):
    if small:  # long lists over blocks, a short order, no help from leaders
        for name, value in (("LIST", 2), ("FREQUENT", 2), ("HOT", 5), ("VOTES", 9)):
            monkeypatch.setattr(jaccard, name, value)
    want = brute_components([p for p in as_pairs(docs) if p[0] is not None])
    rows = jaccard.query(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["component_id"] is None if r["doc_id"] is None else want[r["doc_id"]] == (r["n_shingles"], r["component_id"])
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len({c for _, c in want.values()}) + 1


def test_graph_recall_and_measures(spark, monkeypatch):
    monkeypatch.setattr(graph, "SHARD", 300)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 16))
    x[200:500] = x[200]
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    odd = [(1000, None), (1100, [0.0] * 16), (1200, [float("nan")] * 16), (1300, [None] * 16), (None, rows[0][1]), (1400, []), (1500, [1.0, 2.0])]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    got = {}
    for r in graph.query(table).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert set(got) == set(range(0, 900, 100))
    hits = 0
    for q, found in got.items():
        dist = np.sqrt(((x - x[q]) ** 2).sum(1))
        dist[q] = np.inf
        want = np.lexsort((np.arange(900), dist))[:10]
        assert sorted(found) == list(range(1, 11)) and all(abs(s - dist[v]) < 1e-12 for v, s in found.values())
        hits += len(set(want.tolist()) & {v for v, _ in found.values()})
    assert hits >= 0.9 * 10 * len(got)


def test_warc_round_trip(spark):
    big = "<p>é</p>" * 30000
    rows = [(1, "http://a", big), (2, "http://a\r\nX: y", big), (2, "http://b", big), (3, None, None), (None, "u", "s" * 2000), (5, "u", "s" * 2000),
            (6, "u", "t"), (7, "u", "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    archive = stored(warc.write(pages, chunk=5000), spark, "test-warc")
    got = sorted(map(tuple, warc.read(archive).collect()), key=repr)
    sha = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
    size = lambda t: len((t or "").encode())
    kind = {0: ("revisit", 2), 4: ("revisit", 5)}
    assert got == sorted([(p, size(t), sha(t), *kind.get(i, ("response", None))) for i, (p, _, t) in enumerate(rows)], key=repr)
    assert archive.agg(F.max(F.octet_length("data"))).first()[0] < 6000
    raw = b"".join(bytes(r["data"]) for r in archive.orderBy("archive", "record_id", "chunk").collect())
    assert raw.count(b"WARC/1.1\r\n") == len(rows) and big.encode() in raw


OWN_SQL = sorted(n for n in E.oracle_sql() if n.startswith("op"))


@pytest.mark.parametrize("name", OWN_SQL)
def test_queries_match_their_sql(spark, name):
    res = compare(spark, name, E.queries()[name], E.oracle_sql()[name], SF_SMALL, duck(SF_SMALL))
    assert res["ok"], res


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    pages, turns, vectors = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet").limit(0) for t in ("pages", "conversations", "embeddings"))
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    for out in (mixing.query(none), suffixes.query(none), chat.query(turns), toxicity.query(none, labels), winnow.query(none),
                packing.query(none, queries.tokenizer_path()), jaccard.query(none), quality.query(none, labels), graph.query(vectors),
                warc.read(warc.write(pages))):
        assert out.count() == 0


def test_jaccard_pair_leaves_its_first_shared_list_only():
    rng = np.random.default_rng(5)
    base = np.sort(rng.integers(1, 1 << 63, 400, dtype=np.uint64))
    sets = [np.sort(np.where(rng.random(400) < 0.05, rng.integers(1, 1 << 63, 400, dtype=np.uint64), base)) for _ in range(30)]
    sets += [base[:len(base) - k] for k in range(10)]
    heads = [s[:jaccard.prefix_size(len(s))] for s in sets]
    rows = []
    for i, (s, h) in enumerate(zip(sets, heads)):
        row = np.zeros(len(h), jaccard.POSTING)
        row["hash"], row["id"], row["component"], row["n"], row["at"] = h, i, i, len(s), np.arange(len(h))
        row["before"] = jaccard.named_before(h)
        rows.append(row)
    rows = np.concatenate(rows)

    def found(rows):
        lists = [rows[rows["hash"] == h] for h in np.unique(rows["hash"])]
        return [tuple(p) for one in lists if len(one) > 1 for some in jaccard.list_pairs(one) for p in some.T]
    made = found(rows)
    linked = {(a, b) for a in range(len(sets)) for b in range(a) if 100 * len(np.intersect1d(sets[a], sets[b])) >= 75 * len(np.union1d(sets[a], sets[b]))}
    assert linked and linked <= set(made)
    unnamed = rows.copy()
    unnamed["before"] = 0
    every = found(unnamed)
    assert set(every) == set(made)
    assert len(made) < 1.1 * len(set(made)) and len(every) > 10 * len(made)
