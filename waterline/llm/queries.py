"""The registered queries of this subpackage: each operator on its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from waterline.llm import conversations, fingerprints, html, language, licenses, mixing, neardup, negatives, packing, pii, quality, search, sharding
from waterline.llm.oracle import ORACLE
from waterline.llm.tables import n_words, read
from waterline.sources.staging import materialise

Query = Callable[[SparkSession, str], DataFrame]
SHARDS = 8


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree, grown = sharding.even_tree(range(SHARDS)), sharding.even_tree(range(SHARDS + 1))
    return sharding.shard_documents(read(spark, sf_dir, "documents"), tree, grown)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), tokenizer_path())


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    # texts are read once, for their sizes
    sizes = materialise(docs.select("doc_id", "source", n_words(F.col("text")).alias("words")), "sizes")
    mixed = mixing.with_copies(sizes, F.col("words"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op4_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.link_documents(read(spark, sf_dir, "documents"), words=4, percent=80)


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_documents(read(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_documents(read(spark, sf_dir, "documents"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_documents(read(spark, sf_dir, "documents"))


def op9_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.top_k(read(spark, sf_dir, "embeddings"))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_pages(read(spark, sf_dir, "pages"))


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mine(read(spark, sf_dir, "embeddings"))


def op12_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.score_documents(read(spark, sf_dir, "documents"))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_conversations(read(spark, sf_dir, "conversations"))


def queries() -> dict[str, Query]:
    found = (
        op1_sharding, op2_packing, op3_mixing, op4_neardup, op5_fingerprints, op6_quality, op7_pii,
        op8_licenses, op9_search, op10_html, op11_negatives, op12_language, op13_conversations,
    )
    return {f.__name__: f for f in found} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    pipeline = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return ORACLE | pipeline
