"""A corpus made ready for training: five stages, each on all that the one before kept."""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from waterline.llm import mixing, neardup, packing, pii, quality  # noqa: E402
from waterline.llm.tables import n_words, read  # noqa: E402
from waterline.sources.staging import materialise  # noqa: E402


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier rejects go."""
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def unlike(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: five words to a shingle, 0.8 alike."""
    return neardup.keep_one(docs)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return pii.mask_documents(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought to their target sizes; documents taken twice are there twice."""
    return mixing.mix(docs, n_words(F.col("text")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of fixed length, a row per piece."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", good), ("near_duplicates", unlike), ("personal_data", private), ("mix", mixed), ("pack", packed)]

# Trees, sketches and token ids are beyond SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written as Parquet and read again by the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
