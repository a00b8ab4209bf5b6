"""A training corpus from raw documents, stage by stage.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transitlens.llm import bpe_coding, line_dedup, mixing, near_dedup, quality_rules
from transitlens.llm.common import read_table, stored

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _with_length(docs: DataFrame) -> DataFrame:
    """``n_chars``, where there is one, counts the text as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.filter_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; documents stay, if need be with an empty text."""
    return _with_length(line_dedup.dedup(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    return near_dedup.keep_one(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document's tokens, and digests of these and of the decoded text."""
    return bpe_coding.encode(docs, TOKENIZER)


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("near_dedup", near_duplicates),
          ("mixing", mixture), ("bpe_coding", tokens)]

#: SimHash, MinHash, the draws of the mix and the tokenizer aren't SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
