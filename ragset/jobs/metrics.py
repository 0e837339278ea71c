"""Queries of evaluation metrics and question statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ragset.jobs.replies import VISUAL
from ragset.operators import datasets as DS
from ragset.operators import evaluation as V
from ragset.operators import metrics as E
from ragset.operators import replies as P
from ragset.operators import seams
from ragset.operators.html import html_to_markdown
from ragset.sources.tables import chunks, claims, lineage, qa, read, sql, vectors


def _with_chunks(s, d):
    """Questions with the chunks they rest on, in order. Some have no chunk but a final context, some the original chunk alone; paths of images may be 'null' or missing."""
    path = F.when(F.col("artifact") == "None", F.when(F.col("w") % 2 == 0, "null")).otherwise(F.col("artifact"))
    c = chunks(s, d).select("file_name", "chunk_id", "content", path.alias("image_path"))
    r = lineage(s, d).join(c, ["file_name", "chunk_id"]).groupBy("qa_id").agg(F.array_sort(F.collect_list(F.struct("i", "content", "image_path"))).alias("x"), F.max("hop_count").alias("hop_count"))
    e = qa(s, d).join(r, "qa_id", "left")
    own = F.when(F.col("qa_id") % 5 > 0, F.transform("x", lambda c: F.struct(F.when(c["i"] == 2, "").otherwise(c["content"]).alias("content"), c["image_path"].alias("image_path"))))
    final = F.when(F.col("qa_id") % 2 == 0, F.concat(F.lit("final "), F.col("qa_id").cast("string")))
    return e.withColumns({"context_chunks": own, "final_context": final, "original_chunk": F.lit("original"), "context_status": F.when(F.col("turn") > 0, "COMPLETE"), "domain": (F.col("conv_id") % 4).cast("string")})


def v1_to_eval_rows(s, d):
    """Contexts, images, type and metadata of every question."""
    e = V.to_eval_rows(_with_chunks(s, d))
    digest = lambda c: F.md5(c.cast("binary"))
    return e.select(
        "qa_id", digest(F.col("ground_truth")).alias("ground_truth_md5"), F.size("contexts").cast("long").alias("n_contexts"), digest(F.array_join("contexts", "\n")).alias("contexts_md5"),
        F.array_join("image_contexts", " ").alias("images"), "type", F.col("metadata.hop_count").alias("hop_count"), F.col("metadata.context_status").alias("context_status"), F.col("metadata.domain").alias("domain"),
    )


def v2_parse_claims(s, d):
    """Sections of preparation replies; of later turns the reply is an error and the texts themselves count."""
    lines = F.regexp_replace(F.regexp_replace("answer", "\n", " "), r"\. ", "\n")
    hops = F.repeat(F.lit("x --> "), F.pmod("conv_id", F.lit(4)).cast("int"))
    more = F.concat(F.lit("\nREFERENCE_CLAIMS:\n- r"), F.col("relevance_score"), F.lit("\n-\n\n  - s\nCONCEPT_HOPS_QUESTION:\n"), hops, F.lit("y\nREVERSE_QUESTIONS:\n- w1?\nw2?\n- "), F.col("difficulty_score"), F.lit("?\nw4?"))
    reply = F.when(F.col("turn") == 0, F.concat(F.lit("ANSWER_CLAIMS:\n"), lines, more)).otherwise("ERROR: late")
    g = V.parse_claims(qa(s, d).withColumns({"reply": reply, "reference": F.lit("")}))
    n = lambda c: F.size(c).cast("long")
    joined = lambda c: F.md5(F.array_join(c, "|").cast("binary"))
    return g.select("qa_id", n("answer_claims").alias("n_claims"), joined("answer_claims").alias("claims_md5"), n("reference_claims").alias("n_reference"), joined("reverse_questions").alias("reverse_md5"), F.regexp_count("concept_hops", F.lit("-->")).cast("long").alias("hops"))


def v3_parse_verdicts(s, d):
    """Replies label the first two claims and leave the others to their lines."""
    n = claims(s, d).groupBy("qa_id").agg(F.count("*").alias("n"))
    r = n.withColumn("reply", F.when(F.col("qa_id") % 2 == 0, "claim_1: Supported\nCLAIM_2: NOT_SUPPORTED\nsupported\nClaim_1: NOT_SUPPORTED").otherwise("NOT_SUPPORTED\nSUPPORTED"))
    return P.claim_verdicts(r, "qa_id", "reply", "n")


def v4_faithfulness(s, d):
    return E.supported_share(qa(s, d), claims(s, d)).select("qa_id", F.round("score", 6).alias("score"))


def _relevance(s, d):
    return lineage(s, d).select("qa_id", (F.col("i") + 1).alias("k"), F.when((F.col("qa_id") + F.col("i") + 1) % 2 == 0, 1).otherwise(0).alias("rel"))


def v5_context_precision(s, d):
    return E.context_precision(_relevance(s, d)).select("qa_id", F.round("score", 6).alias("score"))


def _question_vectors(s, d):
    v = vectors(s, d)
    n = v.count()
    q = qa(s, d).select("qa_id", F.pmod("qa_id", F.lit(n)).alias("vec_id"), F.pmod(F.col("qa_id") * 3 + 1, F.lit(n)).alias("other"))
    return q.join(v.select("vec_id", "v"), "vec_id"), q.join(v.select(F.col("vec_id").alias("other"), "v"), "other")


def v6_answer_relevancy(s, d):
    q, r = _question_vectors(s, d)
    return E.answer_relevancy(q.select("qa_id", "v"), r.select("qa_id", "v")).select("qa_id", F.round("score", 6).alias("score"))


def v7_multimodal_faithfulness(s, d):
    """Replies with a verdict and a source a claim; some leave the source out, some fail, some items have no image or no chunk."""
    c = claims(s, d).withColumn("i", F.col("i") + 1)
    verdict = F.concat(F.lit("CLAIM_"), F.col("i").cast("string"), F.lit(": "), F.when(F.col("supported"), "Supported").otherwise("NOT_SUPPORTED"), F.when(F.col("i") % 5 == 0, F.lit("")).otherwise(F.concat(F.lit(" | SOURCE: "), F.col("source"))))
    r = c.groupBy("qa_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", verdict.alias("v")))), lambda x: x["v"]), "\n").alias("reply"), F.count("*").alias("n"))
    r = r.withColumns({"reply": F.when(F.col("qa_id") % 11 == 0, "ERROR: late").otherwise(F.col("reply")), "has_image": F.col("qa_id") % 3 != 0, "text_score": F.lit(0.25), "n_chunks": F.col("qa_id") % 7})
    m = V.multimodal_faithfulness(r, "reply", "n", "has_image", "text_score", "n_chunks")
    return m.select("qa_id", F.round("score", 6).alias("score"), F.col("text_claims").cast("long").alias("text_claims"), F.col("image_claims").cast("long").alias("image_claims"), "text_grounded", "visual_grounded")


def v8_multimodal_relevance(s, d):
    q, r = _question_vectors(s, d)
    r = E.answer_relevancy(q.select("qa_id", "v"), r.select("qa_id", "v"))
    reply = F.when(F.col("qa_id") % 3 == 0, "none").otherwise(F.concat(F.lit("RELEVANCE: "), (F.col("qa_id") % 13 / 10).cast("string")))
    return r.select("qa_id", F.round(V.multimodal_relevance(V.labelled_score(reply, "RELEVANCE"), F.col("score"), F.col("qa_id") % 5 != 0), 6).alias("score"))


def _labels(s, d):
    words = F.array(*map(F.lit, ["CANNOT_ANSWER", "Match: Yes", "MATCH: PARTIAL - half", "MATCH: NO, though yes in part", "ERROR: x"]))
    return qa(s, d).select("qa_id", F.element_at(words, (F.pmod("qa_id", F.lit(5)) + 1).cast("int")).alias("label"))


def v9_context_necessity(s, d):
    n = V.necessity_report(_labels(s, d), "label")
    return n.select(F.round("mean", 6).alias("mean"), "answerable", F.round("leakage_rate", 6).alias("leakage_rate"), "high", "medium", "low")


def v10_multihop_reasoning(s, d):
    """Questions by the hops that the judge counts, their mean score, and how many name a bridge."""
    r = lineage(s, d).groupBy("qa_id").agg(F.max("hop_count").alias("h"))
    full = F.concat(F.lit("HOP_COUNT: "), F.col("h").cast("string"), F.lit("\nREASONING_SCORE: "), (F.col("qa_id") % 13 / 10).cast("string"), F.lit("\nBRIDGE_ENTITY: river \nend"))
    reply = F.when(F.col("qa_id") % 3 == 0, full).when(F.col("qa_id") % 3 == 1, "no idea").otherwise("ERROR: late")
    m = E.multihop_reasoning(r.withColumn("reply", reply))
    return V.multihop_report(m).withColumn("score", F.round("score", 6))


def v11_visual_dependency(s, d):
    """The report of judged questions; a judge's word is the reply's, in either form."""
    words = F.array(*map(F.lit, ["Verdict: VISUAL_ESSENTIAL", "visual_helpful", "TEXT_SUFFICIENT", "MISSING_VISUAL"]))
    x = qa(s, d).select(F.element_at(words, (F.pmod(F.length("question"), F.lit(4)) + 1).cast("int")).alias("label"))
    return V.visual_report(x, "label").withColumns({"mean": F.round("mean", 6), "necessity_rate": F.round("necessity_rate", 6)})


def v12_semantic_diversity(s, d):
    return E.semantic_diversity(vectors(s, d)).select(F.round("diversity", 6).alias("diversity"))


def _scored(s, d):
    """Questions with scores, an error for some, a text of concept hops and the flags of subsets."""
    f = v4_faithfulness(s, d).withColumnRenamed("score", "faithfulness").join(v5_context_precision(s, d).withColumnRenamed("score", "context_precision"), "qa_id")
    h = lineage(s, d).groupBy("qa_id").agg(F.max("hop_count").alias("hop_count"))
    r = f.join(h, "qa_id", "left").join(qa(s, d).select("qa_id", "conv_id", "question"), "qa_id")
    r = r.withColumns({"error": F.when(F.col("qa_id") % 7 == 0, "late"), "hops": F.repeat(F.lit("a --> "), (F.col("qa_id") % 4).cast("int")), "image": F.when(F.col("conv_id") % 3 == 0, "p.png")})
    r = r.withColumn("multimodal_relevance", F.when(F.col("image").isNotNull(), F.col("context_precision")).otherwise(0.0))
    return V.subset_flags(r, "hop_count", "question", "image")


SCORES = ["faithfulness", "context_precision", "multimodal_relevance"]


def _six(df):
    return df.select(*[F.round(c, 6).alias(c) if kind == "double" else c for c, kind in df.dtypes])


def v16_aggregate_scores(s, d):
    return _six(V.aggregate_scores(_scored(s, d), SCORES, ["multimodal_relevance"], "error", "hops"))


def v17_flag_issues(s, d):
    """Flagged questions with what is unsupported in their answers."""
    f = v4_faithfulness(s, d).withColumnRenamed("score", "faithfulness").join(v6_answer_relevancy(s, d).withColumnRenamed("score", "relevancy"), "qa_id").join(qa(s, d).select("qa_id", "question"), "qa_id")
    i = E.flag_issues(f, claims(s, d))
    return i.select("qa_id", "issue", "score", F.md5(F.col("question").cast("binary")).alias("question_md5"), F.size("unsupported_claims").cast("long").alias("n_unsupported"), F.md5(F.array_join("unsupported_claims", "|").cast("binary")).alias("unsupported_md5"))


def v18_qa_subsets(s, d):
    return V.subset_counts(_scored(s, d))


def v19_attach_metrics(s, d):
    labels = _labels(s, d).select("qa_id", E.necessity(F.col("label")).alias("necessity"))
    return V.attach_metrics(qa(s, d).select("qa_id"), "qa_id", v5_context_precision(s, d), labels)


def v20_data_completeness(s, d):
    return V.data_completeness(qa(s, d).withColumn("n_images", F.col("conv_id") % 3), "n_images")


def v21_basic_report(s, d):
    """Scores by status, by domain and in all; first turns have no status and a blank difficulty."""
    q = qa(s, d).withColumns({"difficulty_score": F.when(F.col("turn") == 0, "").otherwise(F.col("difficulty_score")), "context_status": F.when(F.col("turn") > 0, F.when(F.col("conv_id") % 2 == 0, "COMPLETE").otherwise("INCOMPLETE_MAX_DEPTH")), "domain": F.col("conv_id") % 4})
    return _six(V.basic_report(q))


def v22_parse_vlm_scores(s, d):
    reply = F.when(F.col("qa_id") % 3 == 0, F.concat(F.lit("FAITHFULNESS: "), (F.col("qa_id") % 17 / 10).cast("string"), F.lit("\nTEXT_SUPPORTED: YES\nImage supported: no\nANSWER_QUALITY: 0.5."))).otherwise("Text Supported<|#|>NA")
    q = qa(s, d).select("qa_id", reply.alias("r"))
    flag = lambda c: V.labelled_flag(F.col("r"), c)
    return q.select("qa_id", F.round(V.labelled_score(F.col("r"), "FAITHFULNESS"), 6).alias("score"), V.labelled_score(F.col("r"), "ANSWER_QUALITY").alias("quality"), flag("TEXT_SUPPORTED").alias("text_supported"), flag("IMAGE_SUPPORTED").alias("image_supported"))


def v23_evaluation_report(s, d):
    """A row a subset (all, multihop, multimodal, both) with the dataset's diversity and necessity and the means of the groups."""
    r = V.aggregate_scores(V.by_subset(_scored(s, d)), SCORES, ["multimodal_relevance"], "error", "hops", "subset")
    whole = E.semantic_diversity(vectors(s, d)).crossJoin(V.necessity_report(_labels(s, d), "label").select(F.col("mean").alias("necessity")))  # one row each
    g = V.group_means(r.crossJoin(whole), {"quality": ["faithfulness", "context_precision"], "multimodal": ["multimodal_relevance_valid"], "health": ["diversity", "necessity"]})
    return _six(g)


def p7_context_stats(s, d):
    return _six(DS.context_stats(lineage(s, d), "qa_id", "hop_count"))


def p8_qa_category_by_hop(s, d):
    """Questions by the tables and images in their contexts; every fourth context has a table, every third an image's mark."""
    table, image = F.when(F.col("qa_id") % 4 == 0, "| a |\n|---|").otherwise("a | b"), F.when(F.col("qa_id") % 3 == 0, "![x](y)").otherwise("none")
    h = lineage(s, d).groupBy("qa_id").agg(F.max("hop_count").alias("hop_count")).withColumn("chunks", F.array(F.struct(image.alias("content"), F.lit("null").alias("image_path")), F.struct(F.lit(None).cast("string").alias("content"), F.when(F.col("qa_id") % 5 == 0, "p.png").alias("image_path"))))
    return E.qa_category_by_hop(h.withColumns({"has_table": E.context_has_table(F.col("chunks"), table), "has_image": E.context_has_image(F.col("chunks"))}))


def p9_qa_category_stats(s, d):
    n = lineage(s, d).groupBy("qa_id").agg(F.count("*").alias("n"))
    return DS.qa_category_stats(qa(s, d).join(n, "qa_id"), F.col("n") > 1, F.col("qa_id") % 3 == 0)


def e1_embed_chunks(s, d):
    """Vectors of all chunks of documents by the default encoder."""
    e = seams.embed(chunks(s, d).select("file_name", "chunk_id", "content"), "content")
    return e.select("file_name", "chunk_id", F.size("v").alias("dim"), F.round(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x), 6).alias("norm"))


def u3_scorer(s, d):
    """For each question the best three answers of its conversation, by the default score."""
    q = qa(s, d)
    pairs = q.select(F.col("qa_id").alias("query_id"), "conv_id", "question").join(q.select(F.col("qa_id").alias("item_id"), "conv_id", "answer"), "conv_id")
    return seams.score(pairs, "question", "answer", top=3).select("query_id", "item_id", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


def s8_html_to_markdown(s, d):
    """Every page, with a link, a table and an image put behind it."""
    more = F.concat(F.lit("<p>see <a href='p/"), F.col("page_id").cast("string"), F.lit("'>page</a></p><table><tr><th>a</th><th>b</th></tr><tr><td>1</td><td>"), F.col("page_id").cast("string"), F.lit("</td></tr></table><img src='i.png' alt='x'>"))
    m = html_to_markdown(read(s, d, "pages").withColumn("html", F.concat("html", more)), "page_id", "html")
    return m.select("page_id", F.md5(F.col("markdown").cast("binary")).alias("markdown_md5"))


#: The steps to markdown as SQL has them: what goes, headings and items, links, rows and blocks; pages hold no other tags.
MARKDOWN = [
    (r"(?is)<head\b.*?</head>|<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->", ""), (r"<img src=''([^'']*)'' alt=''([^'']*)''>", r"![\2](\1)"), (r"(?is)<a\b[^>]*?href=[\"'']([^\"'']*)[\"''][^>]*>(.*?)</a>", r"[\2](\1)"),
    ("(?i)<h1[^>]*>", "\x01# "), ("(?i)<h2[^>]*>", "\x01## "), ("(?i)<h3[^>]*>", "\x01### "), ("(?i)<h4[^>]*>", "\x01#### "), ("(?i)</h[1-6]>", "\x01"), (r"(?i)<li\b[^>]*>", "\x01- "), ("(?i)<t[dh]>", " | "), ("(?i)</tr>", " |\x01"),
    (r"(?i)</?(p|div|section|article|ul|ol|li|table|tr|br|blockquote|body|html)\b[^>]*>", "\x01"), ("<[a-zA-Z/!?][^>]*>", ""), ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&"),
]
TRIM = r"regexp_replace({}, '^[ \t\n\r\f\x0b]+|[ \t\n\r\f\x0b]+$', '', 'g')"
FAITH = "faith AS (SELECT qa_id, round(coalesce(avg(CASE WHEN supported THEN 1.0 WHEN NOT supported THEN 0.0 END), 1), 6) AS f FROM qa LEFT JOIN claims USING (qa_id) GROUP BY 1)"
PREC = "prec AS (SELECT qa_id, round(coalesce(avg(CASE WHEN rel = 1 THEN run / k END), 0), 6) AS p FROM (SELECT *, sum(rel) OVER (PARTITION BY qa_id ORDER BY k ROWS UNBOUNDED PRECEDING) AS run FROM (SELECT qa_id, i + 1 AS k, CASE WHEN (qa_id + i + 1) % 2 = 0 THEN 1 ELSE 0 END AS rel FROM lineage)) GROUP BY 1)"
RELV = "relv AS (SELECT qa_id, round(greatest(0, least(1, list_cosine_similarity(a.v, b.v))), 6) AS r FROM qa JOIN vectors a ON a.vec_id = qa_id % (SELECT count(*) FROM vectors) JOIN vectors b ON b.vec_id = (qa_id * 3 + 1) % (SELECT count(*) FROM vectors))"
NEC = "nec AS (SELECT qa_id, ([1.0, 0.0, 0.5, 0.9, 0.5])[CAST(qa_id % 5 + 1 AS INTEGER)]::DOUBLE AS x FROM qa)"
DIV = "(SELECT greatest(0, least(1, 1 - (ss - qq) / (n * (n - 1)))) AS diversity FROM (SELECT sum(s * s) AS ss, sum(q) AS qq FROM (SELECT sum(x) AS s, sum(x * x) AS q FROM (SELECT unnest(u) AS x, generate_subscripts(u, 1) AS pos FROM (SELECT list_transform(v, lambda e: e / sqrt(list_dot_product(v, v))) AS u FROM vectors)) GROUP BY pos)), (SELECT count(*) AS n FROM vectors))"
SCORED = (
    "scored AS (SELECT qa_id, f AS faithfulness, p AS context_precision, CASE WHEN conv_id % 3 = 0 THEN p ELSE 0.0 END AS multimodal_relevance, qa_id % 7 <> 0 AS ok, qa_id % 4 AS arrows, coalesce(h, 0) > 0 AS multihop,"
    f" conv_id % 3 = 0 OR regexp_matches(question, '{VISUAL}') AS multimodal FROM faith JOIN prec USING (qa_id) JOIN qa USING (qa_id) LEFT JOIN (SELECT qa_id, max(hop_count) AS h FROM lineage GROUP BY 1) USING (qa_id))"
)
AGG = """round(avg(faithfulness) FILTER (WHERE ok), 6) AS faithfulness, round(avg(context_precision) FILTER (WHERE ok), 6) AS context_precision, round(avg(multimodal_relevance) FILTER (WHERE ok), 6) AS multimodal_relevance, count(*) FILTER (WHERE ok) AS evaluated, count(*) FILTER (WHERE NOT ok) AS errors,
    round(avg(multimodal_relevance) FILTER (WHERE ok AND multimodal_relevance > 0), 6) AS multimodal_relevance_valid, round(coalesce(avg(arrows) FILTER (WHERE ok AND arrows > 0), 0), 6) AS mean_hops, count(*) FILTER (WHERE ok AND arrows > 0) AS hops_count"""
SUBSETS = "(SELECT 'all' AS subset, * FROM scored UNION ALL SELECT 'multihop', * FROM scored WHERE multihop UNION ALL SELECT 'multimodal', * FROM scored WHERE multimodal UNION ALL SELECT 'both', * FROM scored WHERE multihop AND multimodal)"


def _with(extra: str, query: str, *tables: str) -> str:
    return sql("", *tables).rstrip() + ",\n" + extra + "\n" + query


SQLS = {
    "v1_to_eval_rows": sql("""SELECT qa_id, md5(answer) AS ground_truth_md5, CASE WHEN qa_id % 5 > 0 AND m > 0 THEN n ELSE 1 END AS n_contexts, md5(CASE WHEN qa_id % 5 > 0 AND m > 0 THEN coalesce(texts, '') WHEN qa_id % 2 = 0 THEN 'final ' || qa_id ELSE 'original' END) AS contexts_md5,
        CASE WHEN qa_id % 5 > 0 THEN coalesce(images, '') ELSE '' END AS images, CASE WHEN qa_id % 5 > 0 AND images <> '' THEN 'visual' ELSE 'text' END AS type, hop_count, CASE WHEN turn > 0 THEN 'COMPLETE' END AS context_status, CAST(conv_id % 4 AS VARCHAR) AS domain
        FROM qa LEFT JOIN (SELECT qa_id, count(*) AS m, count(*) FILTER (WHERE i <> 2 AND content <> '') AS n, string_agg(content, chr(10) ORDER BY i) FILTER (WHERE i <> 2 AND content <> '') AS texts, string_agg(artifact, ' ' ORDER BY i) FILTER (WHERE artifact <> 'None') AS images, max(hop_count) AS hop_count
            FROM lineage JOIN chunks USING (file_name, chunk_id) GROUP BY 1) USING (qa_id)""", "chunks", "lineage"),
    "v2_parse_claims": sql(rf"""SELECT qa_id, len(c) AS n_claims, md5(array_to_string(c, '|')) AS claims_md5, CASE WHEN turn = 0 THEN 4 ELSE 0 END AS n_reference, md5(CASE WHEN turn = 0 THEN 'w1?|w2?|' || difficulty_score || '?' ELSE question END) AS reverse_md5, CASE WHEN turn = 0 THEN conv_id % 4 ELSE 0 END AS hops
        FROM (SELECT *, CASE WHEN turn > 0 THEN CASE WHEN answer = '' THEN [] ELSE [answer] END ELSE list_transform(list_filter(list_transform(string_split(replace(answer, chr(10), ' '), '. '), lambda x: {TRIM.format('x')}), lambda x: x <> '' AND x <> '-'), lambda x: {TRIM.format("regexp_replace(x, '^[- ]+', '')")}) END AS c FROM qa)""", "qa"),
    "v3_parse_verdicts": sql("SELECT qa_id, CAST(i + 1 AS INTEGER) AS i, CASE WHEN qa_id % 2 = 0 THEN i IN (0, 2) ELSE i = 1 END AS supported FROM claims", "claims"),
    "v4_faithfulness": _with(FAITH, "SELECT qa_id, f AS score FROM faith", "claims"),
    "v5_context_precision": _with(PREC, "SELECT qa_id, p AS score FROM prec", "lineage"),
    "v6_answer_relevancy": _with(RELV, "SELECT qa_id, r AS score FROM relv", "qa", "vectors"),
    "v7_multimodal_faithfulness": sql("""SELECT qa_id, round(CASE WHEN qa_id % 7 = 0 THEN 0 WHEN qa_id % 3 = 0 THEN 0.25 WHEN qa_id % 11 = 0 THEN 0 ELSE score END, 6) AS score, CASE WHEN seen THEN t ELSE 0 END AS text_claims, CASE WHEN seen THEN g ELSE 0 END AS image_claims, seen AND t > 0 AS text_grounded, seen AND g > 0 AS visual_grounded
        FROM (SELECT qa_id, qa_id % 7 <> 0 AND qa_id % 3 <> 0 AND qa_id % 11 <> 0 AS seen, avg(CASE WHEN supported THEN 1.0 ELSE 0.0 END) AS score, count(*) FILTER (WHERE supported AND (i + 1) % 5 <> 0 AND source IN ('TEXT','BOTH')) AS t, count(*) FILTER (WHERE supported AND (i + 1) % 5 <> 0 AND source IN ('IMAGE','BOTH')) AS g FROM claims GROUP BY 1)""", "claims"),
    "v8_multimodal_relevance": _with(RELV.replace("round(", "(").replace(", 6) AS r", ") AS r"), "SELECT qa_id, round(CASE WHEN qa_id % 5 = 0 THEN r WHEN r > 0 THEN 0.5 * m + 0.5 * r ELSE m END, 6) AS score FROM (SELECT qa_id, r, CASE WHEN qa_id % 3 = 0 THEN 0.5 ELSE least(1.0, (qa_id % 13) / 10) END AS m FROM relv)", "qa", "vectors"),
    "v9_context_necessity": _with(NEC, "SELECT round(avg(x), 6) AS mean, count(*) FILTER (WHERE x = 0) AS answerable, round(count(*) FILTER (WHERE x = 0) / count(*), 6) AS leakage_rate, count(*) FILTER (WHERE x >= 0.8) AS high, count(*) FILTER (WHERE x >= 0.5 AND x < 0.8) AS medium, count(*) FILTER (WHERE x < 0.5) AS low FROM nec", "qa"),
    "v10_multihop_reasoning": sql("SELECT CASE WHEN qa_id % 3 = 0 THEN h ELSE 1 END AS hops, count(*) AS n, round(avg(CASE WHEN qa_id % 3 = 0 THEN least(1.0, (qa_id % 13) / 10) WHEN qa_id % 3 = 1 THEN 0.5 ELSE 0.0 END), 6) AS score, count(*) FILTER (WHERE qa_id % 3 = 0) AS bridges FROM (SELECT qa_id, max(hop_count) AS h FROM lineage GROUP BY 1) GROUP BY ROLLUP (1)", "lineage"),
    "v11_visual_dependency": sql("SELECT count(*) AS n, count(*) FILTER (WHERE x IN (0, 3)) AS essential, count(*) FILTER (WHERE x = 1) AS helpful, count(*) FILTER (WHERE x = 2) AS sufficient, round(avg(CASE WHEN x IN (0, 3) THEN 1.0 WHEN x = 1 THEN 0.5 ELSE 0 END), 6) AS mean, round(count(*) FILTER (WHERE x IN (0, 3)) / count(*), 6) AS necessity_rate FROM (SELECT length(question) % 4 AS x FROM qa)", "qa"),
    "v12_semantic_diversity": sql(f"SELECT round(diversity, 6) AS diversity FROM {DIV}", "vectors"),
    "v16_aggregate_scores": _with(f"{FAITH}, {PREC}, {SCORED}", f"SELECT {AGG} FROM scored", "claims", "lineage"),
    "v17_flag_issues": _with(f"{FAITH}, {RELV}", """SELECT qa_id, 'LOW_FAITHFULNESS' AS issue, f AS score, md5(left(question, 100)) AS question_md5, n AS n_unsupported, md5(coalesce(t, '')) AS unsupported_md5 FROM faith JOIN qa USING (qa_id) JOIN (SELECT qa_id, count(*) FILTER (WHERE NOT supported) AS n, string_agg(claim, '|' ORDER BY i) FILTER (WHERE NOT supported) AS t FROM claims GROUP BY 1) USING (qa_id) WHERE f < 0.8
        UNION ALL SELECT qa_id, 'LOW_RELEVANCY', r, md5(left(question, 100)), NULL, NULL FROM relv JOIN qa USING (qa_id) WHERE r < 0.7""", "claims", "vectors"),
    "v18_qa_subsets": _with(f"{FAITH}, {PREC}, {SCORED}", "SELECT count(*) AS total, count(*) FILTER (WHERE multihop) AS multihop, count(*) FILTER (WHERE multimodal) AS multimodal, count(*) FILTER (WHERE multihop AND multimodal) AS both, count(*) FILTER (WHERE NOT multihop) AS not_multihop, count(*) FILTER (WHERE NOT multimodal) AS not_multimodal, count(*) FILTER (WHERE NOT multihop AND NOT multimodal) AS neither FROM scored", "claims", "lineage"),
    "v19_attach_metrics": _with(f"{PREC}, {NEC}", "SELECT qa_id, p AS score, x AS necessity FROM qa LEFT JOIN prec USING (qa_id) LEFT JOIN nec USING (qa_id)", "lineage"),
    "v20_data_completeness": sql("""SELECT metric, NOT visual OR w > 0 AS can_evaluate, CASE WHEN NOT visual OR w > 0 THEN q ELSE 'NOT_APPLICABLE' END AS quality, items, w AS items_with_images, images FROM (SELECT count(*) AS items, count(*) FILTER (WHERE conv_id % 3 > 0) AS w, CAST(coalesce(sum(conv_id % 3), 0) AS BIGINT) AS images FROM qa),
        (VALUES ('faithfulness', FALSE, 'FULL'), ('answer_relevance', FALSE, 'FULL'), ('context_precision', FALSE, 'APPROXIMATED'), ('context_recall', FALSE, 'APPROXIMATED'), ('multihop_reasoning', FALSE, 'FULL'), ('visual_dependency', TRUE, 'FULL'), ('multimodal_faithfulness_vlm', TRUE, 'FULL'),
            ('multimodal_answer_quality_vlm', TRUE, 'FULL'), ('semantic_diversity', FALSE, 'FULL'), ('context_necessity', FALSE, 'FULL'), ('domain_coverage', FALSE, 'FULL')) m(metric, visual, q)""", "qa"),
    "v21_basic_report": sql("""SELECT kind, value, count(*) AS n, round(avg(CAST(relevance_score AS DOUBLE)), 6) AS relevance, round(avg(CASE WHEN turn <> 0 THEN CAST(difficulty_score AS DOUBLE) END), 6) AS difficulty
        FROM (SELECT 'domain' AS kind, CAST(conv_id % 4 AS VARCHAR) AS value, * FROM qa UNION ALL SELECT 'status', CASE WHEN turn = 0 THEN 'UNKNOWN' WHEN conv_id % 2 = 0 THEN 'COMPLETE' ELSE 'INCOMPLETE_MAX_DEPTH' END, * FROM qa UNION ALL SELECT 'all', NULL, * FROM qa) GROUP BY 1, 2""", "qa"),
    "v22_parse_vlm_scores": sql("SELECT qa_id, round(CASE WHEN qa_id % 3 = 0 THEN least(1.0, (qa_id % 17) / 10) ELSE 0.5 END, 6) AS score, CAST(0.5 AS DOUBLE) AS quality, CASE WHEN qa_id % 3 = 0 THEN 'YES' ELSE 'NA' END AS text_supported, CASE WHEN qa_id % 3 = 0 THEN 'NO' END AS image_supported FROM qa", "qa"),
    "v23_evaluation_report": _with(f"{FAITH}, {PREC}, {NEC}, {SCORED}", f"""SELECT r.subset, faithfulness, context_precision, multimodal_relevance, evaluated, errors, multimodal_relevance_valid, mean_hops, hops_count, round(diversity, 6) AS diversity, round(necessity, 6) AS necessity, round((f0 + p0) / 2, 6) AS quality_mean, multimodal_relevance_valid AS multimodal_mean, round((diversity + necessity) / 2, 6) AS health_mean
        FROM (SELECT subset, {AGG}, avg(faithfulness) FILTER (WHERE ok) AS f0, avg(context_precision) FILTER (WHERE ok) AS p0 FROM {SUBSETS} GROUP BY 1) r, {DIV}, (SELECT avg(x) AS necessity FROM nec)""", "claims", "lineage", "vectors"),
    "s8_html_to_markdown": "WITH steps AS (SELECT page_id, " + reduce(lambda c, x: f"regexp_replace({c}, '{x[0]}', '{x[1]}', 'g')", MARKDOWN, "html || '<p>see <a href=''p/' || page_id || chr(39) || '>page</a></p><table><tr><th>a</th><th>b</th></tr><tr><td>1</td><td>' || page_id || '</td></tr></table><img src=''i.png'' alt=''x''>'") + r""" AS t FROM pages),
        b AS (SELECT page_id, unnest(x) AS b, generate_subscripts(x, 1) AS i FROM (SELECT page_id, list_filter(list_transform(string_split(t, chr(1)), lambda b: trim(regexp_replace(b, '[ \t\n\r\f\x0b]+', ' ', 'g'))), lambda b: b NOT IN ('', '#', '##', '###', '####', '-', '|')) AS x FROM steps)),
        g AS (SELECT *, starts_with(b, '|') AS r, coalesce(starts_with(lag(b) OVER (PARTITION BY page_id ORDER BY i), '|'), FALSE) AS p FROM b)
        SELECT page_id, md5(string_agg(CASE WHEN i = 1 THEN '' WHEN r AND p THEN chr(10) ELSE chr(10) || chr(10) END || b || CASE WHEN r AND NOT p THEN chr(10) || '|' || repeat('---|', length(regexp_replace(b, '[^|]', '', 'g')) - 1) ELSE '' END, '' ORDER BY i)) AS markdown_md5 FROM g GROUP BY page_id""",
    "p7_context_stats": sql("SELECT hop_count, count(*) AS contexts, round(avg(n), 6) AS mean_chunks, max(n) AS max_chunks FROM (SELECT qa_id, max(hop_count) AS hop_count, count(*) AS n FROM lineage GROUP BY 1) GROUP BY 1", "lineage"),
    "p8_qa_category_by_hop": sql("""SELECT category, hop_count, count(*) AS n FROM (SELECT CASE WHEN t AND i THEN 'table+image' WHEN t THEN 'table' WHEN i THEN 'image' ELSE 'text' END AS category, hop_count FROM (SELECT qa_id % 4 = 0 AS t, qa_id % 3 = 0 OR qa_id % 5 = 0 AS i, max(hop_count) AS hop_count FROM lineage GROUP BY qa_id)) GROUP BY CUBE (1, 2)
        UNION ALL SELECT 'any table', hop_count, count(*) FROM (SELECT max(hop_count) AS hop_count FROM lineage WHERE qa_id % 4 = 0 GROUP BY qa_id) GROUP BY ROLLUP (hop_count) HAVING count(*) > 0
        UNION ALL SELECT 'any image', hop_count, count(*) FROM (SELECT max(hop_count) AS hop_count FROM lineage WHERE qa_id % 3 = 0 OR qa_id % 5 = 0 GROUP BY qa_id) GROUP BY ROLLUP (hop_count) HAVING count(*) > 0""", "lineage"),
    "u3_scorer": sql("""SELECT query_id, item_id, round(score, 6) AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 12) DESC, item_id) AS rank FROM (SELECT q.qa_id AS query_id, a.qa_id AS item_id, CASE WHEN len(q.w) = 0 THEN 0 ELSE len(list_intersect(q.w, a.v)) / len(q.w) END AS score
        FROM (SELECT qa_id, conv_id, list_distinct(regexp_extract_all(lower(question), '[^ \t\n\r\f\x0b]+')) AS w FROM qa) q JOIN (SELECT qa_id, conv_id, list_distinct(regexp_extract_all(lower(answer), '[^ \t\n\r\f\x0b]+')) AS v FROM qa) a USING (conv_id))) WHERE rank <= 3""", "qa"),
    "p9_qa_category_stats": sql(
        "SELECT count(*) AS total, " + ", ".join(f"count(*) FILTER (WHERE {c}) AS {n}, round_even(100 * count(*) FILTER (WHERE {c}) / count(*), 1) AS {n}_pct" for n, c in {"multihop": "n > 1", "multimodal": "qa_id % 3 = 0", "both": "n > 1 AND qa_id % 3 = 0", "only_multihop": "n > 1 AND qa_id % 3 <> 0", "only_multimodal": "n = 1 AND qa_id % 3 = 0", "neither": "n = 1 AND qa_id % 3 <> 0"}.items())
        + ", round_even(avg(CAST(difficulty_score AS DOUBLE)), 2) AS difficulty, round_even(avg(CAST(relevance_score AS DOUBLE)), 2) AS relevance FROM qa JOIN (SELECT qa_id, count(*) AS n FROM lineage GROUP BY 1) USING (qa_id)", "lineage"),
}
