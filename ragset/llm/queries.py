"""The queries of this subpackage, one an operator, over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ragset.llm import divergence, periods
from ragset.llm.chat import format_chats
from ragset.llm.common import fold, table
from ragset.llm.media import media_columns
from ragset.llm.mixing import score_texts
from ragset.llm.nearest import nearest
from ragset.llm.ngram_join import ngram_join
from ragset.llm.packing import pack_documents
from ragset.llm.pieces import piece_digests
from ragset.llm.private import private_query
from ragset.llm.quality import quality_query
from ragset.llm.records import token_records
from ragset.llm.toxicity import toxicity_query


def op1_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = fold("doc_id", 7) == 2
    return score_texts(table(spark, sf_dir, "documents"), ~held).withColumn("held_out", held)


def op2_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_columns(table(spark, sf_dir, "documents"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents"))


def op4_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(table(spark, sf_dir, "documents"))


def op6_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(table(spark, sf_dir, "conversations"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_records(table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.run_digests(table(spark, sf_dir, "documents"))


def op13_private_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private_query(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    return {"op11_source_divergence": divergence.SQL, "op12_periodic_runs": periods.SQL}
