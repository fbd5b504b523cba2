"""The registered queries of this subpackage: each applies one operator, with
production parameters, to its whole table. SQL where SQL can express the result."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import load
from . import bpe, chat, graph, jaccard, lexical, mixing, packing, quality, suffixes, toxicity, variants, warc, winnow
from .common import stored


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.query(load(spark, sf_dir, "documents"))


def op2_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.query(load(spark, sf_dir, "documents"))


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.query(load(spark, sf_dir, "conversations"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.query(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op5_winnow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.query(load(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.query(load(spark, sf_dir, "documents"), tokenizer_path())


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.query(load(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.query(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op9_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.query(load(spark, sf_dir, "embeddings"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read(stored(warc.write(load(spark, sf_dir, "pages")), spark, "warc"))


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.query(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.query(load(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.query(load(spark, sf_dir, "documents"))


NAMES = ("op1_mixing", "op2_suffixes", "op3_chat", "op4_toxicity", "op5_winnow", "op6_packing", "op7_jaccard", "op8_quality", "op9_graph", "op10_warc", "op11_lexical", "op12_bpe", "op13_variants")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: globals()[name] for name in NAMES}


def oracle_sql() -> dict[str, str]:
    return {"op1_mixing": mixing.SQL, "op3_chat": chat.SQL, "op10_warc": warc.SQL, "op11_lexical": lexical.SQL,
            "op13_variants": variants.SQL}
