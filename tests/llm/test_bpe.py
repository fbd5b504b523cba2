"""Encoding and decoding against the ``tokenizers`` library, the brute-force version."""
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from layerkit.llm import bpe, queries

PATH = queries.tokenizer_path("word_bpe_49k.json")
PARTS = ["a", "B", "É", "é", "́", "Σ", "ς", "İ", "'s", "'LL", " ", "\n", "\t", " ", "1", "²", "<|endoftext|>", "<|startoftext|>",
         "<|", "!!", "日", "😀", "ﬁ", "\x1c", "\x00", "-", "ñ", "th", "Tion", "ing", "ՙ", "Ᲊ"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH)


def made(n, most, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(PARTS, k=rng.randint(0, most))) for _ in range(n)]


def ids_of(codec, texts):
    raw = [t.encode() for t in texts]
    ids, ends = codec.encode(np.frombuffer(b"".join(raw), np.uint8), np.append(0, np.cumsum([len(r) for r in raw])))
    return [ids[a:b].to_pylist() for a, b in zip(ends[:-1], ends[1:])]


def test_ids_are_those_of_the_library(library, monkeypatch):
    codec = bpe.Codec(PATH)
    texts = made(2000, 40, 1)
    assert ids_of(codec, texts) == [library.encode(t, add_special_tokens=False).ids for t in texts]
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    assert ids_of(codec, texts) == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_every_code_point_is_read_as_the_library_reads_it(library):
    codec = bpe.Codec(PATH)
    texts = [f"A{chr(x)}'S b{chr(x)}{chr(x)}.re1" for x in range(0x20000) if not 0xD800 <= x < 0xE000]
    for text, got, want in zip(texts, ids_of(codec, texts), library.encode_batch(texts, add_special_tokens=False)):
        assert got == want.ids, repr(text)


def test_pieces_of_long_lists(monkeypatch):
    lists = pa.array([[1, 2, 3, 4, 5, 6, 7], None, [], [8], [9, 10], [11, 12, 13, 14]], pa.list_(pa.int32()))
    want = [" ".join(map(str, x or [])) for x in lists.to_pylist()]
    for most in (1, 2, 3, 100):
        monkeypatch.setattr(bpe, "JOINED", most)
        assert [" ".join(p) for p in bpe.joined(lists, lambda a: a.cast(pa.string()))] == want
        assert [" ".join(p) for p in bpe.joined(lists.slice(1, 4), lambda a: a.cast(pa.string()))] == want[1:5]


def test_another_kind_of_file_is_refused():
    with pytest.raises(ValueError):
        bpe.Codec(queries.tokenizer_path("byte_bpe_50k.json"))


def test_query_on_odd_rows(spark, library):
    texts = made(60, 50, 3) + [None, "", "   ", "x" * 3000, "<|endoftext|>", "word, " * 500_000, " " * 700_000 + "end"]
    rows = [(i, t, "row", "ids") for i, t in enumerate(texts)] + [(3, texts[3], None, None), (None, "A null id", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string, ids string").repartition(4)

    def sha(s):
        return hashlib.sha256(s.encode()).hexdigest()

    want = []
    for key, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((key, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert sorted(map(repr, map(tuple, bpe.query(docs, PATH).collect()))) == sorted(map(repr, want))
    assert bpe.query(docs.limit(0), PATH).collect() == []
    encoded = bpe.encode(docs, PATH)
    assert encoded.columns == ["row", "ids"] and encoded.select("row.*").columns == docs.columns
    back = bpe.decode(encoded.where("row.doc_id = 2"), PATH).first()
    assert back["decoded"] == library.decode(back["ids"], skip_special_tokens=False)
