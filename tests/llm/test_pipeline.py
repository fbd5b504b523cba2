"""Each pipeline stage judged on its own input."""
from pyspark.sql import functions as F

import corpus_pipeline as P
from layerkit.llm import jaccard, packing, queries, toxicity
from layerkit.llm.common import stored
from tests.conftest import SF_SMALL


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    assert [n for n, _ in P.STAGES] == ["toxicity", "jaccard", "suffixes", "mixing", "packing"]
    grammar = toxicity.fitted(docs, labels)
    seen = {}
    for name, stage in P.STAGES[:-1]:
        out = stored(stage(spark, docs, SF_SMALL), spark, "test-pipeline")
        assert out.columns == docs.columns
        seen[name] = (docs, out)
        docs = out
    before, after = seen["toxicity"]
    scores = {r["key"]: r["score"] for r in toxicity.score(before, grammar).collect()}
    assert {r[0] for r in after.select("doc_id").collect()} == {k for k, s in scores.items() if s < 0.5}
    before, after = seen["jaccard"]
    assert {r[0] for r in after.select("doc_id").collect()} == {r["component_id"] for r in jaccard.query(before).collect()}
    before, after = seen["suffixes"]
    assert before.count() == after.count() and after.agg(F.sum(F.length("text"))).first()[0] <= before.agg(F.sum(F.length("text"))).first()[0]
    assert P.STAGES[-1][1](spark, docs, SF_SMALL).count() == packing.pieces(docs, queries.tokenizer_path()).count()


def test_rows_that_share_an_id_are_told_apart_by_their_text(spark):
    from layerkit.llm import jaccard
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    docs = spark.createDataFrame([(1, a), (1, b), (1, a), (2, b + " x"), (3, a)], "doc_id long, text string")
    assert sorted(map(tuple, jaccard.keep_one(docs).collect())) == [(1, a), (1, b)]


def test_packing_takes_a_text_of_a_million_blanks(spark):
    import zlib

    import numpy as np
    from tokenizers import Tokenizer

    from layerkit.llm import packing, queries
    texts = [" " * 1_500_000 + "x", "\n" * 1_200_000, "<|endoftext|>" + " " * 1_300_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = packing.query(docs, queries.tokenizer_path()).collect()
    library = Tokenizer.from_file(queries.tokenizer_path())
    for key, text in enumerate(texts):
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 0], "<u4")
        pieces = sorted((r for r in rows if r["doc_id"] == key), key=lambda r: r["piece"])
        assert sum(r["length"] for r in pieces) == len(ids) and all(r["length"] <= 2048 for r in pieces)
        for r in pieces:
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes())
