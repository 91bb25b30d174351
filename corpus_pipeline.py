"""From raw documents to tokens: the stages of a training-data pipeline, in order.

Every stage reads what the one before it wrote and returns the columns of documents;
the last adds token ids.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import mixing, ngram_join, pieces, quality, substring
from tidemark.session import scratch_folder

MODEL = "piece_bpe_32k.model"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every quality rule."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest id, of each group linked by shared 5-word shingles."""
    return ngram_join.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that stand earlier in another, or in themselves."""
    return substring.remove_repeats(docs)


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in equal shares by domain, language and source, as often as the mixture holds them."""
    return mixing.mixture(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the ids of their pieces, decoded once to prove them."""
    return pieces.tokenized(docs, pieces.load(public_tokenizers.path(MODEL)))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("source_mixture", source_mixture),
    ("token_ids", token_ids),
]

ORACLE_SQL = None  # SQL cannot express the stages; tests hold them against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over the documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch_folder(spark)
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
