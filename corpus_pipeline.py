"""From documents to token ids: five stages, each written as Parquet and read back by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from kiosklake.llm import byte_bpe, mixing, near_dedup, quality_rank, quality_rules
from kiosklake.llm.common import fold_of, table
from kiosklake.session import materialize

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pairwise ranking accepts."""
    learned = fold_of(F.col("doc_id"), 4) != 2
    model = quality_rank.train(docs, table(spark, sf_dir, "labels"), train_on=learned)
    return quality_rank.keep_good(docs, model)


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break no quality rule."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near_dedup.keep_one(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources at their target weights: every document once at least, those of rarer sources repeated."""
    return mixing.mix(docs).drop("_mix")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, packed, with the byte offset at which each ends."""
    coded = byte_bpe.encode(docs, RANKS, keep=["doc_id", "source"])
    return coded.select("doc_id", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", "ends")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", rules),
    ("near_duplicates", near_duplicates),
    ("source_mix", source_mix),
    ("token_ids", token_ids),
]

#: Learning, alignment and merging are beyond SQL; tests/llm compares the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
