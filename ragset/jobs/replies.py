"""Queries over replies, gates, results, caches and prompts."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import functions as F

from ragset.functions.text import WORD, keyed, upper
from ragset.jobs.corpus import TOK
from ragset.operators import contexts as X
from ragset.operators import datasets as DS
from ragset.operators import replies as P
from ragset.sources.files import load_results, save_results
from ragset.sources.shared import shared_dir, written
from ragset.sources.tables import chunks, claims, docs, lineage, qa, read, replies, sql

M = "<|#|>"


def q1_parse_kv(s, d):
    r = replies(s, d)
    return r.select("doc_id", keyed(F.col("reply"), "Status").alias("status"), keyed(F.col("reply"), "difficulty", last=True).alias("difficulty"), keyed(F.col("reply"), "Missing").alias("missing"))


def q2_parse_generated_qa(s, d):
    """Replies of one or two sections, with the decomposition cut; those of first turns have a header."""
    q = qa(s, d)
    one = F.concat(F.lit(f"{M}Question{M}"), F.col("question"), F.lit(f"{M}Answer{M}"), F.col("answer"), F.lit(f"{M}Relevance{M}"), F.col("relevance_score"))
    head = F.concat(F.lit("Chunk Count: 2\nKeywords per Chunk: <Chunk 1: [a"), F.col("relevance_score"), F.lit(", b], Chunk 2: [c question]>\nRelated Keywords: <[a] relates to [c] via d>\n"))
    two = F.concat(head, F.lit(f"{M}QA_GENERATION{M}"), one, F.lit(f"{M}NEXT{M}Question{M}second{M}Answer{M}yes{M}DECOMPOSITION Question: no"))
    g = P.parse_generated_qa(q.select("qa_id", F.when(F.col("turn") == 0, two).otherwise(F.concat(F.lit(f"{M}QA_GENERATION{M}"), one)).alias("reply")))
    words = F.array_join(F.transform(F.array_sort(F.map_keys("keywords_per_chunk")), lambda k: F.concat(k, F.lit("="), F.array_join(F.col("keywords_per_chunk")[k], "+"))), ";")
    return g.select("qa_id", F.md5(F.col("question").cast("binary")).alias("question_md5"), F.length("answer").cast("long").alias("n_answer"), "relevance", "difficulty", F.col("chunk_count").cast("long").alias("chunk_count"), words.alias("keywords"), "related_keywords")


def q3_parse_keyword_map(s, d):
    q = qa(s, d).select("qa_id", F.concat(F.lit("Chunk 1: [a"), F.col("relevance_score"), F.lit(", b], Chunk 2: [c"), F.col("difficulty_score"), F.lit("]")).alias("r"))
    m = P.parse_keyword_map(F.col("r"))
    return q.select("qa_id", F.explode(m).alias("chunk", "words")).select("qa_id", "chunk", F.array_join("words", "|").alias("words"))


def q4_parse_packs(s, d):
    q = qa(s, d)
    two = F.concat(F.lit(f"Question{M}q"), F.col("relevance_score"), F.lit(f"{M}Answer{M}a{M}NEXT{M}Question{M}only"), F.when(F.col("turn") == 0, F.lit(f"{M}Answer{M}b")).otherwise(""))
    p = P.parse_packs(q.select("qa_id", two.alias("reply")))
    return p.select("qa_id", F.col("pack").cast("long").alias("pack"), "question", "answer", "reorganized")


def q5_relevance_gate(s, d):
    """Documents kept and set aside, and the characters of those set aside after the cut."""
    status = F.when(F.col("quality") == 1, "RELEVANT").when(F.col("quality") == 0, "NOT_RELEVANT").otherwise("ERROR")
    r = replies(s, d).select("doc_id", F.concat(F.lit(f"{M}START{M}Status{M}"), status, F.lit(f"{M}Explanation{M}RELEVANT to some{M}END{M}")).alias("reply")).join(docs(s, d).select("doc_id", "text"), "doc_id")
    kept, aside = P.relevance_gate(r, content="text")
    n = lambda t, name, chars: t.agg(F.count("*").alias("n"), F.coalesce(F.sum(chars), F.lit(0)).alias("chars")).select(F.lit(name).alias("relevant"), "n", "chars")
    return n(kept, True, F.lit(0)).unionByName(n(aside, False, F.length("text")))


def q6_select_gate(s, d):
    g = P.select_gate(replies(s, d))
    return g.select("doc_id", "status", "relevance", "difficulty", "reason")


def _verification(s, d):
    r = replies(s, d)
    good = F.lit("QUESTION_CORRECT, ANSWER_CORRECT, REQUIRES_CONTENT")
    labels = F.when(F.col("toxic") == 1, F.lit("QUESTION_CORRECT, ANSWER_CORRECT, CAN_ANSWER_WITHOUT_CONTENT, REQUIRES_CONTENT")).when(F.col("quality") == 1, good).otherwise("Question_Correct, Answer_Incorrect")
    # the explanation names labels that do not count
    reply = F.when(F.col("quality").isNull(), "ERROR: none").otherwise(F.concat(F.lit(f"{M}START{M}Status{M}"), labels, F.lit(f"{M}Explanation{M}not ANSWER_INCORRECT, rather ANSWER_CORRECT and REQUIRES_CONTENT{M}END{M}")))
    return r.select("doc_id", reply.alias("reply"))


def q7_verify_gate(s, d):
    return _verification(s, d).groupBy(P.verified(F.col("reply")).alias("verified")).agg(F.count("*").alias("n"))


def q8_misleading_visual(s, d):
    q = qa(s, d).select("qa_id", F.concat(F.when(F.col("conv_id") % 2 == 0, F.lit("As shown in the Figure, ")).otherwise("What is graph theory? "), F.col("question")).alias("q"), F.concat(F.col("answer"), F.when(F.col("conv_id") % 3 == 0, F.lit(" See the legend.")).otherwise("")).alias("a"), (F.col("conv_id") % 4 == 0).alias("image"))
    return q.select("qa_id", P.misleading_visual(F.col("q"), F.col("a"), F.col("image")).alias("misleading"))


def q10_match_qa_type(s, d):
    n = lineage(s, d).groupBy("qa_id").agg(F.count("*").alias("n"))
    kinds = P.type_match(F.col("n"), F.when(F.col("qa_id") % 3 == 0, "![x](y.png)").otherwise("None"))
    return n.select(F.explode(kinds).alias("qa_type")).groupBy("qa_type").agg(F.count("*").alias("n"))


def q12_take_target(s, d, target: int = 100):
    """Up to target multi-chunk rows in key order, and how the target was met; target is the operator's feature."""
    n = lineage(s, d).groupBy("qa_id").agg(F.count("*").alias("n")).withColumn("kinds", P.type_match(F.col("n"), F.lit("None")))
    taken, aside, stats = DS.take_target(n, "kinds", "multihop", target, "qa_id")
    kept = taken.agg(F.count("*").alias("kept"), F.max("qa_id").alias("last"))
    return kept.crossJoin(aside.agg(F.count("failure_reason").alias("set_aside"))).crossJoin(stats)  # one row each


def q12_generate_to_target(s, d, target: int = 100):
    """Pairs from chunks in a seeded order until there are 100 of chunks with images, or 110 chunks have been asked; target is the operator's feature."""
    c = chunks(s, d).select("file_name", "chunk_id", "artifact", "content")

    def generate(text):
        return f"Question{M}{text[:40]}{M}Answer{M}a{len(text)}"

    taken, aside, stats = DS.generate_to_target(c, F.translate(F.col("content"), "\n", " "), generate, lambda t: P.type_match(F.lit(1), t["artifact"]), "multimodal", target, "file_name", "chunk_id")
    rows = taken.withColumn("failure_reason", F.lit(None).cast("string")).unionByName(aside)
    return rows.select("file_name", "chunk_id", "answer", F.md5(F.col("question").cast("binary")).alias("question_md5"), "failure_reason").crossJoin(stats.select("requests", "generated", "target_reached", "chunk_budget"))  # stats is one row


def q13_correction_rounds(s, d):
    """All pairs failed once. The corrector answers with the request's length, at times citing a figure, or with nothing; the verifier passes even ones; half of the pairs rest on an image."""
    failed = qa(s, d).select(F.col("qa_id").alias("id"), "question", "answer", F.lit("bad").alias("verification"), (F.floor(F.col("qa_id") / 100) % 2 == 0).alias("has_image"))

    def correct(text):
        n = len(text)
        q, a = ("As shown in the figure, q", "The figure shows a") if n % 3 == 0 else ("q", "a")
        return "none" if n % 5 == 0 else f"{M}Question{M}{q}{M}Answer{M}{a}{n}"

    def verify(text):
        return f"Status: {', '.join(P.GOOD) if int(text[-1]) % 2 == 0 else 'QUESTION_INCORRECT'}"

    passed, lost = DS.correction_rounds(failed, correct, verify, written)
    one = passed.select("id", "answer", "selection_status", F.col("correction_attempt").cast("long").alias("attempt"), F.lit(None).cast("string").alias("failure_reason"))
    two = lost.select("id", "answer", F.lit(None).cast("string").alias("selection_status"), F.lit(None).cast("long").alias("attempt"), "failure_reason")
    return one.unionByName(two).withColumn("answer", F.md5(F.col("answer").cast("binary")))


def q14_outcome_stats(s, d):
    g = P.select_gate(replies(s, d)).select("doc_id", DS.outcome_of(F.col("status")).alias("outcome"), (F.col("doc_id") % 3).alias("n_chunks"))
    return DS.outcome_stats(g, "outcome", "n_chunks").withColumn("success_rate", F.round("success_rate", 6))


def q15_build_prompts(s, d):
    """A question and its numbered references in order, in a template."""
    r = lineage(s, d).groupBy("qa_id").agg(F.array_sort(F.collect_list(F.struct("i", "file_name"))).alias("x")).join(qa(s, d).select("qa_id", "question"), "qa_id")
    text = DS.build_prompt("Q: {question}\n{chunks}\nEnd", question=F.col("question"), chunks=DS.numbered(F.transform("x", lambda e: e["file_name"])))
    return r.select("qa_id", F.md5(text.cast("binary")).alias("prompt_md5"))


def s6_write_outcomes(s, d):
    """Outcomes written by partition, with the chunks of all documents as contexts, and read again."""
    g = P.select_gate(replies(s, d)).select("doc_id", DS.outcome_of(F.col("status")).alias("outcome"))
    path = f"{shared_dir(s)}/ragset-outcomes-{uuid.uuid4().hex}"
    DS.write_outcomes(g, "outcome", path, chunks(s, d).select("doc_id", "chunk_id", "content"))
    rows, contexts = s.read.parquet(f"{path}/rows"), s.read.parquet(f"{path}/contexts")
    return rows.join(contexts.groupBy("doc_id").agg(F.count("*").alias("c")), "doc_id", "left").groupBy("outcome").agg(F.count("*").alias("n"), F.coalesce(F.sum("c"), F.lit(0)).alias("contexts"))


def s4_load_results(s, d):
    """Results saved as lines of JSON and loaded with a fixed schema."""
    path = f"{shared_dir(s)}/ragset-results-{uuid.uuid4().hex}"
    save_results(qa(s, d).select("qa_id", "question", "relevance_score"), path, "jsonl")
    got = load_results(s, path, "lines", "qa_id long, question string, relevance_score string")
    return got.select("qa_id", F.md5(F.col("question").cast("binary")).alias("question_md5"), "relevance_score")


def s5_save_csv(s, d):
    path = f"{shared_dir(s)}/ragset-csv-{uuid.uuid4().hex}"
    save_results(qa(s, d).select("qa_id", "question", "difficulty_score"), path, "csv")
    return s.read.schema("qa_id long, question string, difficulty_score string").option("header", True).option("multiLine", True).option("escape", '"').csv(path).select("qa_id", F.length("question").cast("long").alias("n"), "difficulty_score")


def m2_search_strings(s, d):
    q = qa(s, d)
    said = F.when(F.col("conv_id") % 3 == 0, F.lit("'a' | \"b c\" | None | d|e|f|g")).when(F.col("conv_id") % 3 == 1, "None").otherwise("")
    why = F.concat(F.lit("see figure "), F.col("relevance_score"), F.lit(", Table B.2.1 and Section 4, not Annex"))
    return q.select("qa_id", F.array_join(P.search_strings(said, why), "|").alias("queries"))


def m3_drop_visited(s, d):
    r = lineage(s, d)
    return X.drop_visited(r.where("i > 0").select("qa_id", "file_name").distinct(), r.where("i = 0").distinct(), "qa_id", "file_name")


def m4_accept_verdicts(s, d):
    """Replies in the marked form, in both older forms and without a status, by verdict."""
    word = F.when(F.col("source").isin("TEXT", "BOTH"), "explanatory").when(F.col("source") == "IMAGE", "RELATED").otherwise("Unrelated")
    reply = F.when(F.col("i") % 5 == 0, F.concat(F.lit(f"{M}START{M}Status{M}"), word, F.lit(f"{M}Explanation{M}not RELATED{M}END{M}"))).when(F.col("i") % 5 == 1, F.concat(F.lit("Status: "), word)).when(F.col("i") % 5 == 2, "Status: helpful").when(F.col("i") % 5 == 3, f"{M}Status{M}NOT_HELPFUL").otherwise("unclear")
    v = claims(s, d).select(X.addition_verdict(reply).alias("verdict"))
    return v.groupBy("verdict").agg(F.count("*").alias("n"), F.count_if(X.accepted(F.col("verdict"))).alias("strict"), F.count_if(X.accepted(F.col("verdict"), "RELATED")).alias("wide"))


def m8_hop_edges(s, d):
    """Edges from each question's first reference to the later ones, and the links of a keyword line (depth 0)."""
    said = F.concat(F.lit("[a"), F.col("relevance_score"), F.lit("] leads to [b] via road ; nothing; ["), F.col("difficulty_score"), F.lit("] - [c] via sea"))
    links = X.keyword_links(qa(s, d).select("qa_id", said.alias("t")), "qa_id", "t")
    edges = X.hop_edges(lineage(s, d), "qa_id", "i", "file_name").withColumn("via", F.lit(None).cast("string"))
    return edges.unionByName(links.select("qa_id", "source", "target", F.lit(0).cast("long").alias("depth"), "via"))


def m9_keyword_spans(s, d):
    k = s.createDataFrame([("the",), ("then",), ("hen",), ("of",)], "keyword string")
    return P.keyword_spans(read(s, d, "benchmark"), "item_id", "text", k)


def r1_cache_key(s, d):
    """Keys of questions; those of even conversations have the chunks they rest on."""
    r = lineage(s, d).groupBy("qa_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "file_name"))), lambda e: e["file_name"]).alias("x"))
    q = qa(s, d).join(r, "qa_id")
    return q.select("qa_id", DS.cache_key("select", "m", F.col("question"), F.when(F.col("conv_id") % 2 == 0, F.col("x"))).alias("cache_key"))


def _cache_table(s, d):
    """The same cache as a table in buckets, stored in two runs: replies to all its conversations, then the newer ones."""
    path = f"{shared_dir(s)}/ragset-cache-{uuid.uuid4().hex}"
    of = lambda n, mark, version: read(s, d, "conversations").where(F.col("conv_id") % n == 0).select(F.sha2("text", 256).alias("cache_key"), F.concat(F.lit(mark), "text").alias("response"), F.lit(version).alias("version"))
    for new in (of(4, "S:", 2), of(2, "R:", 1)):
        DS.cache_store(new, path, buckets=32)
    return path


STORED = "cache_key string, response string, version int"


def r2_cache_lookup(s, d):
    asked = read(s, d, "conversations").select("text", F.sha2("text", 256).alias("cache_key"))
    looked, missing = DS.cache_find(asked, _cache_table(s, d), STORED, buckets=32)
    n = DS.cache_stats(looked, "text").crossJoin(missing.agg(F.count("*").alias("distinct_misses")))  # one row each
    return n.withColumn("hit_rate", F.round("hit_rate", 6))


def r3_cache_upsert(s, d):
    return s.read.schema(STORED).parquet(_cache_table(s, d)).select("cache_key", "version", F.md5(F.col("response").cast("binary")).alias("response_md5"))


def r6_token_usage(s, d):
    return DS.token_usage(qa(s, d).withColumnRenamed("difficulty_score", "model"), "model", "question", "answer")


def g1_filter_results(s, d):
    q = qa(s, d).withColumn("domain", F.when(F.col("conv_id") % 3 == 0, F.lit("x")))
    return DS.filter_results(q, domain=None, relevance_score="1", absent=None).select("qa_id")


def g2_sample_results(s, d):
    """50 rows in a seeded order; the sample is the feature."""
    return DS.sample_results(qa(s, d), 50, "qa_id").select("qa_id", DS.seeded_order("qa_id").alias("k"))


def g3_flatten_results(s, d):
    n = lineage(s, d).groupBy("qa_id").agg(F.max("hop_count").alias("num_hops"))
    rows = qa(s, d).join(n, "qa_id", "left").select("qa_id", F.when(F.col("qa_id") % 2 == 0, F.lit("text")).alias("question_type"), F.col("difficulty_score").alias("difficulty"), "num_hops")
    return DS.flatten_results(rows, {"question_type": "unknown", "difficulty": "0", "num_hops": 0, "domain": "none"})


def g4_results_summary(s, d):
    return DS.results_summary(qa(s, d), chunks(s, d), "content", 100).withColumn("mean_tokens", F.round("mean_tokens", 6))


def u2_responder(s, d):
    """Distinct missing requests go to the responder once; a failure gives an error reply. Words and capitals are those of SQL."""
    from ragset.operators.seams import respond

    def first(text):
        return None if text is None else upper(re.findall(WORD, text)[0])

    asked = qa(s, d).select(F.col("question").alias("request")).distinct()
    return respond(asked, first, written).select(F.md5(F.col("request").cast("binary")).alias("request_md5"), "reply")


#: What questions and answers say of a figure, written out for SQL.
VISUAL = r"(?i)\b(depicted|shown|illustrated|displayed)\s+(in|by)\s+(the\s+)?(figure|diagram|schematic|image|chart|graph|picture)|\b(figure|diagram|schematic|image|chart|graph|picture)\s+(shows|depicts|illustrates)|\b(based\s+on|according\s+to|in|from)\s+(the\s+)?(figure|diagram|schematic|image|chart|graph|picture)"
ANSWERED = r"(?i)\b(figure|diagram|image|chart|graph)\s+(shows|indicates|displays)|\bvisual|\b(top|bottom|left|right|center)\s+(of|portion|section)|\b(axis|legend|label|arrow|line|curve|bar)"
GATE = "CASE WHEN quality IS NULL THEN 'ERROR' WHEN quality = 1 THEN 'SELECTED' ELSE 'REJECTED' END"
VER = "coalesce(quality = 1, FALSE) AND coalesce(toxic <> 1, TRUE)"
CACHE = "cache AS (SELECT sha256(text) AS cache_key, 'R:' || text AS response, 1 AS version FROM conversations WHERE conv_id % 2 = 0 UNION ALL SELECT sha256(text), 'S:' || text, 2 FROM conversations WHERE conv_id % 4 = 0)"
SPANS = r"""WITH k AS (SELECT unnest(['the','then','hen','of']) AS k), h AS (SELECT DISTINCT item_id, p - 1 AS s, p - 1 + length(k) AS e FROM benchmark, k, LATERAL (SELECT unnest(range(1, length(text) + 1)) AS p) WHERE substr(lower(text), p, length(k)) = k),
    m AS (SELECT *, max(e) OVER (PARTITION BY item_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM h),
    g AS (SELECT *, sum(CASE WHEN before IS NULL OR s >= before THEN 1 ELSE 0 END) OVER (PARTITION BY item_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM m)
    SELECT item_id, CAST(min(s) AS INTEGER) AS start, CAST(max(e) AS INTEGER) AS "end" FROM g GROUP BY item_id, island"""
TRIM = r"regexp_replace({}, '^[ \t\n\r\f\x0b]+|[ \t\n\r\f\x0b]+$', '', 'g')"

SQLS = {
    "q1_parse_kv": sql("SELECT doc_id, CASE WHEN quality = 1 THEN 'SELECTED' WHEN quality = 0 THEN 'REJECTED' END AS status, CASE WHEN quality IS NOT NULL THEN CAST(doc_id % 7 AS VARCHAR) END AS difficulty, CAST(NULL AS VARCHAR) AS missing FROM replies", "replies"),
    "q2_parse_generated_qa": sql(f"""SELECT qa_id, question_md5, n_answer, relevance, difficulty, CASE WHEN turn = 0 THEN 2 END AS chunk_count, CASE WHEN turn = 0 THEN 'chunk_1=a' || relevance_score || '+b;chunk_2=c question' END AS keywords, CASE WHEN turn = 0 THEN '[a] relates to [c] via d' END AS related_keywords
        FROM (SELECT qa_id, turn, relevance_score, md5({TRIM.format('question')}) AS question_md5, length({TRIM.format('answer')}) AS n_answer, relevance_score AS relevance, '0' AS difficulty FROM qa UNION ALL SELECT qa_id, turn, relevance_score, md5('second'), 3, '0', '0' FROM qa WHERE turn = 0)""", "qa"),
    "q3_parse_keyword_map": sql("SELECT qa_id, 'chunk_1' AS chunk, 'a' || relevance_score || '|b' AS words FROM qa UNION ALL SELECT qa_id, 'chunk_2', 'c' || difficulty_score FROM qa", "qa"),
    "q4_parse_packs": sql("SELECT qa_id, CAST(0 AS BIGINT) AS pack, 'q' || relevance_score AS question, 'a' AS answer, TRUE AS reorganized FROM qa UNION ALL SELECT qa_id, 1, 'only', 'b', TRUE FROM qa WHERE turn = 0", "qa"),
    "q5_relevance_gate": sql("SELECT coalesce(quality = 1, FALSE) AS relevant, count(*) AS n, CAST(sum(CASE WHEN quality = 1 THEN 0 ELSE least(2000, length(text)) END) AS BIGINT) AS chars FROM replies JOIN docs USING (doc_id) GROUP BY 1", "docs", "replies"),
    "q6_select_gate": sql(f"SELECT doc_id, {GATE} AS status, CASE WHEN quality IS NULL THEN '0' ELSE CAST(doc_id % 11 AS VARCHAR) END AS relevance, CASE WHEN quality IS NULL THEN '0' ELSE CAST(doc_id % 7 AS VARCHAR) END AS difficulty, CASE WHEN quality IS NOT NULL THEN 'r' END AS reason FROM replies", "replies"),
    "q7_verify_gate": sql(f"SELECT {VER} AS verified, count(*) AS n FROM replies GROUP BY 1", "replies"),
    "q8_misleading_visual": sql(f"SELECT qa_id, regexp_matches(q, '{VISUAL}') AND (conv_id % 4 <> 0 OR NOT regexp_matches(a, '{ANSWERED}')) AS misleading FROM (SELECT qa_id, conv_id, CASE WHEN conv_id % 2 = 0 THEN 'As shown in the Figure, ' ELSE 'What is graph theory? ' END || question AS q, answer || CASE WHEN conv_id % 3 = 0 THEN ' See the legend.' ELSE '' END AS a FROM qa)", "qa"),
    "q10_match_qa_type": sql("SELECT qa_type, count(*) AS n FROM (SELECT CASE WHEN qa_id % 3 = 0 THEN 'multimodal' ELSE 'text' END AS qa_type FROM (SELECT DISTINCT qa_id FROM lineage) UNION ALL SELECT 'multihop' FROM lineage GROUP BY qa_id HAVING count(*) > 1) GROUP BY 1", "lineage"),
    "q12_take_target": sql("SELECT least(m, 100) AS kept, (SELECT max(qa_id) FROM (SELECT qa_id FROM lineage GROUP BY 1 HAVING count(*) > 1 ORDER BY 1 LIMIT 100)) AS last, o AS set_aside, least(m, 100) AS generated, m >= 100 AS target_reached, m < 100 AS corpus_exhausted, o AS mismatched, CAST(110 AS BIGINT) AS chunk_budget FROM (SELECT count(*) FILTER (WHERE n > 1) AS m, count(*) FILTER (WHERE n = 1) AS o FROM (SELECT count(*) AS n FROM lineage GROUP BY qa_id))", "lineage"),
    "q12_generate_to_target": sql("""SELECT file_name, chunk_id, answer, question_md5, failure_reason, 110 AS requests, CAST(sum(CASE WHEN failure_reason IS NULL THEN 1 ELSE 0 END) OVER () AS BIGINT) AS generated, FALSE AS target_reached, 110 AS chunk_budget
        FROM (SELECT file_name, chunk_id, 'a' || length(content) AS answer, md5(trim(left(translate(content, chr(10), ' '), 40), ' ' || chr(9) || chr(13))) AS question_md5, CASE WHEN artifact = 'None' THEN 'Does not match target type ' || chr(39) || 'multimodal' || chr(39) END AS failure_reason FROM chunks ORDER BY md5('42' || file_name || '|' || chunk_id) LIMIT 110)""", "chunks"),
    "q13_correction_rounds": sql("""SELECT qa_id AS id, md5(CASE WHEN n % 5 = 0 THEN answer WHEN n % 3 = 0 THEN 'The figure shows a' || n ELSE 'a' || n END) AS answer, CASE WHEN ok THEN 'CORRECTED' END AS selection_status, CASE WHEN ok THEN CAST(1 AS BIGINT) END AS attempt,
        CASE WHEN n % 5 = 0 THEN 'Correction produced no valid pairs' WHEN NOT ok THEN 'Failed verification after 1 correction attempt(s)' END AS failure_reason FROM (SELECT *, n % 5 > 0 AND n % 2 = 0 AND (n % 3 > 0 OR conv_id % 2 = 0) AS ok FROM (SELECT *, 33 + length(question) + length(answer) AS n FROM qa))""", "qa"),
    "q14_outcome_stats": sql("SELECT count(*) FILTER (WHERE quality IS NULL) AS malformed, count(*) FILTER (WHERE quality = 0) AS failed, count(*) FILTER (WHERE quality = 1) AS passed, count(*) FILTER (WHERE quality = 1 AND doc_id % 3 > 1) AS multi_chunk, count(*) FILTER (WHERE quality = 1 AND doc_id % 3 <= 1) AS single_chunk, round(count(*) FILTER (WHERE quality = 1) / count(*), 6) AS success_rate FROM replies", "replies"),
    "q15_build_prompts": sql("SELECT qa_id, md5('Q: ' || question || chr(10) || string_agg('Chunk ' || CAST(i + 1 AS VARCHAR) || ': ' || file_name, chr(10) || '---' || chr(10) ORDER BY i) || chr(10) || 'End') AS prompt_md5 FROM lineage JOIN qa USING (qa_id) GROUP BY qa_id, question", "lineage"),
    "s6_write_outcomes": sql("SELECT CASE WHEN quality IS NULL THEN 'malformed' WHEN quality = 1 THEN 'pass' ELSE 'fail' END AS outcome, count(*) AS n, CAST(sum((SELECT count(*) FROM chunks c WHERE c.doc_id = r.doc_id)) AS BIGINT) AS contexts FROM replies r GROUP BY 1", "chunks", "replies"),
    "s4_load_results": sql("SELECT qa_id, md5(question) AS question_md5, relevance_score FROM qa", "qa"),
    "s5_save_csv": sql("SELECT qa_id, length(question) AS n, difficulty_score FROM qa", "qa"),
    "m2_search_strings": sql("SELECT qa_id, CASE WHEN conv_id % 3 = 0 THEN 'a|b c|d|e|f' ELSE 'figure|Table' END AS queries FROM qa", "qa"),
    "m3_drop_visited": sql("SELECT DISTINCT qa_id, file_name FROM lineage WHERE i > 0 AND (qa_id, file_name) NOT IN (SELECT qa_id, file_name FROM lineage WHERE i = 0)", "lineage"),
    "m4_accept_verdicts": sql("""SELECT verdict, count(*) AS n, count(*) FILTER (WHERE verdict = 'EXPLANATORY') AS strict, count(*) FILTER (WHERE verdict <> 'UNRELATED') AS wide FROM (SELECT CASE WHEN i % 5 = 2 THEN 'EXPLANATORY' WHEN i % 5 > 2 THEN 'UNRELATED' WHEN source IN ('TEXT', 'BOTH') THEN 'EXPLANATORY' WHEN source = 'IMAGE' THEN 'RELATED' ELSE 'UNRELATED' END AS verdict FROM claims) GROUP BY 1""", "claims"),
    "m8_hop_edges": sql("SELECT a.qa_id, b.file_name AS source, a.file_name AS target, a.i AS depth, NULL AS via FROM lineage a JOIN lineage b USING (qa_id) WHERE a.i > 0 AND b.i = 0 UNION ALL SELECT qa_id, 'a' || relevance_score, 'b', 0, 'road' FROM qa UNION ALL SELECT qa_id, difficulty_score, 'c', 0, 'sea' FROM qa", "lineage"),
    "m9_keyword_spans": SPANS,
    "r1_cache_key": sql("""SELECT qa_id, 'select_m_' || substr(sha256(question), 1, 32) || '_' || CASE WHEN conv_id % 2 = 0 THEN substr(sha256('["' || string_agg(file_name, '","' ORDER BY i) || '"]'), 1, 32) ELSE 'none' END AS cache_key FROM qa JOIN lineage USING (qa_id) GROUP BY qa_id, question, conv_id""", "lineage"),
    "r2_cache_lookup": f"WITH {CACHE} SELECT count(*) FILTER (WHERE hit) AS hits, count(*) FILTER (WHERE NOT hit) AS misses, round(100.0 * count(*) FILTER (WHERE hit) / count(*), 6) AS hit_rate, count(DISTINCT CASE WHEN NOT hit THEN text END) AS distinct_misses, CAST(coalesce(sum(CASE WHEN hit THEN length(text) // 4 ELSE 0 END), 0) AS BIGINT) AS tokens_saved FROM (SELECT text, sha256(text) IN (SELECT cache_key FROM cache) AS hit FROM conversations)",
    "r3_cache_upsert": f"WITH {CACHE} SELECT cache_key, version, md5(response) AS response_md5 FROM (SELECT *, row_number() OVER (PARTITION BY cache_key ORDER BY version DESC, response) AS r FROM cache WHERE response <> '') WHERE r = 1",
    "r6_token_usage": sql("SELECT model, i AS input_tokens, o AS output_tokens, i + o AS total_tokens, calls FROM (SELECT difficulty_score AS model, CAST(sum(length(question) // 4) AS BIGINT) AS i, CAST(sum(length(answer) // 4) AS BIGINT) AS o, count(*) AS calls FROM qa GROUP BY ROLLUP (difficulty_score))", "qa"),
    "g1_filter_results": sql("SELECT qa_id FROM qa WHERE conv_id % 3 <> 0 AND relevance_score = '1'", "qa"),
    "g2_sample_results": sql("SELECT qa_id, md5('42' || CAST(qa_id AS VARCHAR)) AS k FROM qa ORDER BY 2, 1 LIMIT 50", "qa"),
    "g3_flatten_results": sql("SELECT qa_id, CASE WHEN qa_id % 2 = 0 THEN 'text' ELSE 'unknown' END AS question_type, difficulty_score AS difficulty, max(hop_count) AS num_hops, 'none' AS domain FROM qa JOIN lineage USING (qa_id) GROUP BY ALL", "lineage"),
    "g4_results_summary": sql(f"SELECT (SELECT count(*) FROM qa) AS qa_pairs, count(*) AS chunks, CAST(sum({TOK}) AS BIGINT) AS tokens, round(avg({TOK}), 6) AS mean_tokens, CAST(100 AS BIGINT) AS requested FROM chunks", "chunks", "qa"),
    "u2_responder": sql(rf"SELECT DISTINCT md5(question) AS request_md5, CASE WHEN len(regexp_extract_all(question, '[^ \t\n\r\f\x0b]+')) = 0 THEN 'ERROR: list index out of range' ELSE upper(regexp_extract(question, '[^ \t\n\r\f\x0b]+')) END AS reply FROM qa", "qa"),
}
