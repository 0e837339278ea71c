"""Evaluation metrics over claims, relevance and vectors, and dataset statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ragset.functions.text import clean, cosine


def supported_share(ids: DataFrame, claims: DataFrame, key: str = "qa_id") -> DataFrame:
    """(key, score): supported claims over claims; 1 without claims."""
    s = claims.groupBy(key).agg(F.avg(F.col("supported").cast("double")).alias("score"))
    return ids.select(key).join(s, key, "left").select(key, F.coalesce("score", F.lit(1.0)).alias("score"))


def context_precision(relevance: DataFrame, key: str = "qa_id") -> DataFrame:
    """(key, score): mean of the precision at each relevant position (rel, k from 1); 0 without one."""
    run = F.sum("rel").over(Window.partitionBy(key).orderBy("k").rowsBetween(Window.unboundedPreceding, 0))
    r = relevance.withColumn("at", run / F.col("k"))
    return r.groupBy(key).agg(F.coalesce(F.avg(F.when(F.col("rel") == 1, F.col("at"))), F.lit(0.0)).alias("score"))


def answer_relevancy(questions: DataFrame, reverse: DataFrame, key: str = "qa_id") -> DataFrame:
    """(key, score): mean cosine of a question's vector with its reverse questions', within 0 and 1; 0 without any."""
    c = questions.join(reverse.withColumnRenamed("v", "w"), key).groupBy(key).agg(F.avg(cosine("v", "w")).alias("c"))
    return questions.select(key).join(c, key, "left").select(key, F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce("c", F.lit(0.0)))).alias("score"))


def semantic_diversity(vectors: DataFrame) -> DataFrame:
    """1 - mean cosine of all pairs, within 0 and 1, from the sum of the unit vectors in one pass; 0 for fewer than 2."""
    from ragset.functions.text import l2_normalize

    u = vectors.select(l2_normalize("v").alias("u"))
    dims = u.select(F.posexplode("u").alias("pos", "x")).groupBy("pos").agg(F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("q"))
    sums = dims.agg(F.sum(F.col("s") * F.col("s")).alias("ss"), F.sum("q").alias("qq"))
    n = vectors.agg(F.count("*").alias("n"))
    mean = (F.col("ss") - F.col("qq")) / (F.col("n") * (F.col("n") - 1))
    return sums.crossJoin(n).select(F.when(F.col("n") > 1, F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - mean))).otherwise(0.0).alias("diversity"))  # one row each


def necessity(label):
    """How much an answer needs its context, by the judge's reply: an error, CANNOT_ANSWER, MATCH: YES, MATCH: PARTIAL, anything else."""
    up = F.upper(F.coalesce(label, F.lit("")))
    return F.when(up.startswith("ERROR:"), 0.5).when(up.contains("CANNOT_ANSWER"), 1.0).when(up.contains("MATCH: YES"), 0.0).when(up.contains("MATCH: PARTIAL"), 0.5).otherwise(0.9)


def visual_dependency(reply):
    """1 where the visual is essential (or missing, in the older form), 0.5 where it helps, else 0."""
    up = F.upper(F.coalesce(reply, F.lit("")))
    return F.when(up.contains("VISUAL_ESSENTIAL") | up.contains("MISSING_VISUAL"), 1.0).when(up.contains("VISUAL_HELPFUL"), 0.5).otherwise(0.0)


def multihop_reasoning(replies: DataFrame, reply: str = "reply") -> DataFrame:
    """replies with hop_count (1 if absent), reasoning_score (0.5 if absent, within 0 and 1) and bridge_entity; an error gives 1, 0 and Error."""
    said = lambda p: F.regexp_extract(reply, p, 1)
    score = said(r"REASONING_SCORE:\s*([0-9.]+)").try_cast("double")
    bridge = clean(said(r"BRIDGE_ENTITY:[ \t]*([^\n]+)"))
    bad = F.col(reply).startswith("ERROR:")
    return replies.withColumns(
        {
            "hop_count": F.when(bad, 1).otherwise(F.coalesce(said(r"HOP_COUNT:\s*([0-9]+)").try_cast("long"), F.lit(1))),
            "reasoning_score": F.when(bad, 0.0).otherwise(F.when(score.isNull(), 0.5).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)))),
            "bridge_entity": F.when(bad, "Error").when(bridge == "", "None").otherwise(bridge),
        }
    )


def flag_issues(scores: DataFrame, claims: DataFrame | None = None, faithful: float = 0.8, relevant: float = 0.7, most: int = 100) -> DataFrame:
    """(qa_id, issue, score, question, unsupported_claims) of rows (qa_id, faithfulness, relevancy, question) of low faithfulness and of low relevancy; a row may have both.

    question is cut to `most` characters. The claims (qa_id, i, claim, supported) that are not supported go, in order, with a row of low
    faithfulness; it has an empty array without any, and a row of low relevancy a null.
    """
    question = F.substring("question", 1, most).alias("question") if "question" in scores.columns else F.lit(None).cast("string").alias("question")
    none = F.lit(None).cast("array<string>")
    low = scores.where(F.col("faithfulness") < faithful)
    if claims is not None:
        bad = claims.where("not supported").groupBy("qa_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "claim"))), lambda c: c["claim"]).alias("bad"))
        low = low.join(bad, "qa_id", "left")
    bad = F.coalesce(F.col("bad"), F.array().cast("array<string>")) if claims is not None else none
    out = low.select("qa_id", F.lit("LOW_FAITHFULNESS").alias("issue"), F.col("faithfulness").alias("score"), question, bad.alias("unsupported_claims"))
    return out.unionByName(scores.where(F.col("relevancy") < relevant).select("qa_id", F.lit("LOW_RELEVANCY").alias("issue"), F.col("relevancy").alias("score"), question, none.alias("unsupported_claims")))


def qa_category_by_hop(rows: DataFrame) -> DataFrame:
    """(category, hop_count, n) of rows (has_table, has_image, hop_count): the four exclusive categories, and any table and any image,
    by hop count and in all (hop_count null); category null is all rows."""
    kind = F.when(F.col("has_table") & F.col("has_image"), "table+image").when(F.col("has_table"), "table").when(F.col("has_image"), "image").otherwise("text")
    some = F.array_compact(F.array(F.when(F.col("has_table"), F.lit("any table")), F.when(F.col("has_image"), F.lit("any image"))))
    exclusive = rows.select(kind.alias("category"), "hop_count").cube("category", "hop_count").agg(F.count("*").alias("n"))
    any_ = rows.select(F.explode(some).alias("category"), "hop_count")
    return exclusive.unionByName(any_.groupBy("category", "hop_count").agg(F.count("*").alias("n"))).unionByName(any_.groupBy("category").agg(F.count("*").alias("n")).withColumn("hop_count", F.lit(None).cast(dict(rows.dtypes)["hop_count"])))


def context_has_table(chunks: Column, context: Column) -> Column:
    """Whether a chunk's content or the context holds a table of markdown."""
    table = lambda c: F.coalesce(c.contains("|") & c.contains("-|"), F.lit(False))
    return F.coalesce(F.exists(chunks, lambda c: table(c["content"])), F.lit(False)) | table(context)


def context_has_image(chunks: Column) -> Column:
    """Whether a chunk has an image's path, or an image's mark in its content."""
    return F.coalesce(F.exists(chunks, lambda c: F.coalesce((c["image_path"] != "") & (c["image_path"] != "null"), F.lit(False)) | F.coalesce(c["content"].contains("!["), F.lit(False))), F.lit(False))
