"""The registered queries of the training-data operators.

Each reads a whole table, applies its operator with production parameters and
returns the operator's full result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from transitlens.llm import bpe_coding, chat_format, collocation, line_dedup, lm_scoring, mixing, near_dedup, packing, quality_rules, token_counts, topk_search, toxicity as toxic, whitening
from transitlens.llm.common import read_table

#: The operators' vocabulary files; parameters of the operators themselves.
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return line_dedup.dedup(docs, removed_col="n_removed").select("doc_id", "n_removed", "text")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxic.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(read_table(spark, sf_dir, "documents"))


def op4_bpe_coding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_coding.encode(read_table(spark, sf_dir, "documents"), WORD_BPE, with_ids=False)


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(read_table(spark, sf_dir, "documents"))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op7_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(read_table(spark, sf_dir, "embeddings"), k=10, every=100)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.budget_answers(read_table(spark, sf_dir, "documents"), BYTE_BPE, limit=1024)


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.rotate(read_table(spark, sf_dir, "conversations"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"), k=8)


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), BYTE_BPE, capacity=2048, end_id=0)


def op13_collocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocation.collocations(read_table(spark, sf_dir, "documents"), least=30, top=2000)


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_quality_rules": op3_quality_rules,
    "op4_bpe_coding": op4_bpe_coding,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_near_dedup": op6_near_dedup,
    "op7_topk_search": op7_topk_search,
    "op8_token_counts": op8_token_counts,
    "op9_chat_format": op9_chat_format,
    "op10_mixing": op10_mixing,
    "op11_whitening": op11_whitening,
    "op12_packing": op12_packing,
    "op13_collocation": op13_collocation,
}
ORACLES: dict[str, str] = {
    "op3_quality_rules": quality_rules.ORACLE_SQL,
    "op7_topk_search": topk_search.ORACLE_SQL,
    "op9_chat_format": chat_format.ORACLE_SQL,
    "op13_collocation": collocation.ORACLE_SQL,
}
