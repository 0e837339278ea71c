"""The corpus pipeline: documents, good ones, harmless ones, one of each group of near copies, packed sequences.

Each stage takes the documents that its predecessor kept. Near copies are documents that share at least 0.8 of their
five-word shingles, directly or over others; the one with the smallest doc_id stays. SQL has no classifier, and so
ORACLE_SQL is None; tests hold each stage against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ragset.llm.common import small_batches, staged, table
from ragset.llm.ngram_join import ngram_join, possible
from ragset.llm.packing import pack_documents
from ragset.llm.quality import quality_query
from ragset.llm.toxicity import toxicity_query

ORACLE_SQL = None


KEY = ("key_a", "key_b")


def keyed(docs: DataFrame) -> DataFrame:
    """docs with KEY, 128 bits of doc_id and text: rows of one key are equal in both. Nulls have keys as well."""
    return docs.withColumns({k: F.xxhash64(F.lit(i), "doc_id", "text") for i, k in enumerate(KEY)})


def without(docs: DataFrame, gone: DataFrame, *by: str) -> DataFrame:
    """docs without the rows whose columns by are in gone (null is in none). Only rows that may be in gone are joined, whatever their number."""
    gone = staged(gone.select(*by).distinct(), "gone")
    hit = possible(gone, list(by))
    return docs.where(~hit).union(docs.where(hit).join(gone, list(by), "left_anti").select(docs.columns))


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality classifier does not reject; each row is judged by itself and carries its columns along."""
    return _judged(docs, quality_query, table(spark, sf_dir, "labels"), 0)


def harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the toxicity classifier does not reject; each row is judged by itself and carries its columns along."""
    return _judged(docs, toxicity_query, table(spark, sf_dir, "labels"), 1)


def _judged(docs: DataFrame, classify, labels: DataFrame, bad: int) -> DataFrame:
    """docs without the rows that classify predicts as bad; columns keep their names, types and order."""
    small_batches(docs.sparkSession)
    rest = [c for c in docs.columns if c != "text"]
    named = docs.select("doc_id", "text", F.struct(*rest).alias("rest"))  # the text goes through the classifier once
    out = classify(named, labels, keep=("rest", "text")).where(F.col("predicted") != bad)
    return out.select(*(F.col("text") if c == "text" else F.col("rest")[c].alias(c) for c in docs.columns))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest doc_id of each group of near copies, once; rows without a doc_id stay.

    Rows of one doc_id are documents of their own: one goes only as a near copy, or if it is another's equal in text.
    """
    small_batches(spark)
    if not docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").limit(1).count():
        return without(docs, ngram_join(docs, words=5, percent=80).where("component_id <> doc_id"), "doc_id")
    rows = staged(docs.withColumn("row_id", F.monotonically_increasing_id()), "rows")
    named = rows.where("doc_id is not null")
    linked = ngram_join(named.select(F.col("row_id").alias("doc_id"), "text"), words=5, percent=80)
    ids = keyed(named).select("row_id", F.col("doc_id").cast("long").alias("doc_id"), *KEY)
    ids = staged(ids.join(linked.select(F.col("doc_id").alias("row_id"), "component_id"), "row_id"), "ids")
    first = F.min(F.struct("doc_id", "row_id"))["row_id"].alias("first")
    copies = [ids.join(ids.groupBy(*by).agg(first), list(by)).where("row_id <> first").select("row_id") for by in (["component_id"], KEY)]
    return without(rows, copies[0].union(copies[1]), "row_id").drop("row_id")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed pieces of every row, as pack_documents() has them for null texts, repeated rows and empty tables."""
    small_batches(spark)
    return pack_documents(docs)


STAGES = [("quality", good), ("toxicity", harmless), ("near_copies", distinct_documents), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
