"""Queries over vectors, rankings, contexts and topics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ragset.functions.text import dot, l2_normalize, letter_words
from ragset.operators import contexts as X
from ragset.operators import retrieval as R
from ragset.operators import seams
from ragset.operators import topics as T
from ragset.sources.shared import written
from ragset.sources.tables import chunks, read, sql, vectors

DOT = "list_dot_product(q.v, i.v)"
KNN = f"SELECT query_id, item_id, score, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 12) DESC, item_id) AS rank FROM (SELECT q.vec_id AS query_id, i.vec_id AS item_id, {DOT} AS score FROM vectors q, vectors i WHERE q.vec_id % 20 = 0)"


def _items(s, d):
    return vectors(s, d).select(F.col("vec_id").alias("item_id"), "v")


def _found(s, d, k):
    v = vectors(s, d)
    return R.knn_topk(v.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "v"), _items(s, d), k)


def e2_l2_normalize(s, d):
    v = vectors(s, d).select("vec_id", l2_normalize(F.transform("v", lambda x: x * 3)).alias("u"))
    return v.select("vec_id", F.round(F.element_at("u", 1), 6).alias("first"), F.round(dot("u", "u"), 6).alias("norm"))


def e3_knn_topk(s, d):
    return _found(s, d, 10).select("query_id", "item_id", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


def e4_nucleus_topp(s, d):
    return R.nucleus_topp(_found(s, d, 100)).select("query_id", "item_id", F.round("mass", 6).alias("mass"))


def _queries(s, d):
    return vectors(s, d).where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "v")


def e5_retrieve_rerank(s, d):
    """Ten by inner product, five by the distance of ids, two by rank."""
    best = R.retrieve_rerank(_queries(s, d), _items(s, d), 1.0 / (1 + F.abs(F.col("query_id") - F.col("item_id"))))
    return best.select("query_id", "item_id", F.col("rank").cast("long").alias("rank"), F.round("score", 6).alias("score"))


def e6_cosine_rerank(s, d):
    best = R.cosine_rerank(_found(s, d, 10), _queries(s, d), _items(s, d))
    return best.select("query_id", "item_id", F.col("rank").cast("long").alias("rank"), F.round("score", 6).alias("score"))


def e7_parse_rankings(s, d):
    """Rank replies over five chunks: rank r names chunk (item_id + r) % 5 + 1, and the fifth is left out."""
    b = read(s, d, "benchmark").select("item_id")
    ranks = F.transform(F.sequence(F.lit(1), F.lit(4)), lambda r: F.concat(F.lit("<Rank "), r.cast("string"), F.lit(">Chunk "), (F.pmod(F.col("item_id") + r, F.lit(5)) + 1).cast("string")))
    r = b.select("item_id", F.array_join(ranks, "\n").alias("reply"))
    got = T.parse_rankings(r, "item_id", "reply", F.sequence(F.lit(1), F.lit(5)))
    return got.select("item_id", "chunk", F.round("score", 6).alias("score"))


def e8_parse_score(s, d):
    b = read(s, d, "benchmark").select("item_id")
    reply = F.element_at(F.array(*map(F.lit, ["0.7", "about 0.25 or so", "7", "no number", " 0.5 "])), (F.pmod("item_id", F.lit(5)) + 1).cast("int"))
    return b.select("item_id", F.round(T.parse_score(reply), 6).alias("score"))


def e9_fuse_vectors(s, d):
    v = vectors(s, d)
    image = v.where("vec_id % 2 = 0").select((F.col("vec_id") + 1).alias("vec_id"), F.col("v").alias("w"))
    f = v.join(image, "vec_id", "left").select("vec_id", T.fuse_vectors("v", "w").alias("u"))
    return f.select("vec_id", F.round(F.element_at("u", 1), 6).alias("first"), F.round(dot("u", "u"), 6).alias("norm"))


def e10_align_chunks(s, d):
    """Chunks of every third window have a vector; those of every fourth one no chunk."""
    c = chunks(s, d).select("file_name", "chunk_id", "w")
    both, lost = R.align_chunks(c.where("w % 3 = 0").select("file_name", "chunk_id"), c.where("w % 4 <> 3"))
    return both.select("file_name", "chunk_id", F.lit(True).alias("found")).unionByName(lost.withColumn("found", F.lit(False)))


def j1_pictures_in_tables(s, d):
    """Pictures whose box lies in a table box of their page of their document."""
    place = lambda key: [F.pmod(key, F.lit(3)).alias("doc"), F.pmod(key, F.lit(1000)).alias("page_no")]
    p = read(s, d, "lineitem").select(
        *place("l_orderkey"), "l_orderkey", "l_linenumber", F.col("l_quantity").cast("double").alias("l"), (F.col("l_quantity") + 2).cast("double").alias("r"),
        F.round(F.col("l_discount") * 100).cast("double").alias("b"), (F.round(F.col("l_discount") * 100) + 2).cast("double").alias("t"),
    )
    left = F.pmod("o_orderkey", F.lit(30)).cast("double")
    o = read(s, d, "orders").select(*place("o_orderkey"), left.alias("l"), (left + 25).alias("r"), F.lit(0.0).alias("b"), F.lit(10.0).alias("t")).distinct()
    return T.pictures_in_tables(p, o, 20.0).groupBy("doc", "page_no").agg(F.count("*").alias("n"))


def t1_assign_topics(s, d):
    return T.assign_topics(vectors(s, d), 8, written, outliers=0.95).select("vec_id", "topic")


def _words(s, d):
    return read(s, d, "documents").select("doc_id", F.col("lang").alias("topic"), letter_words(F.col("text")).alias("words"))


def t2_ngram_vocabulary(s, d):
    return T.ngram_vocabulary(_words(s, d), written)


def t3_topic_keywords(s, d):
    return T.topic_keywords(_words(s, d), 15).select("topic", "word", F.col("rank").cast("long").alias("rank"), F.round("weight", 6).alias("weight"))


def t4_diversify_keywords(s, d):
    return T.diversify_keywords(T.topic_keywords(_words(s, d), 30).withColumn("v", T.letter_pairs(F.col("word"))), 10)


def t5_topic_summary(s, d):
    """Documents by language; those of every tenth id are outliers, which count in the total alone."""
    topic = F.when(F.col("doc_id") % 10 == 0, "-1").otherwise(F.col("lang"))
    return T.topic_summary(read(s, d, "documents").select(topic.alias("topic")), T.topic_keywords(_words(s, d), 5))


def _walk(s, d):
    seeds = vectors(s, d).where("vec_id % 20 = 0").select(F.col("vec_id").alias("seed"), F.col("vec_id").alias("item_id"))
    return seeds, R.expand_context(seeds, _items(s, d), 0.35, staged=written)


def m1_expand_context(s, d):
    _, (hops, _) = _walk(s, d)
    return hops.select("seed", F.col("depth").cast("long").alias("depth"), "query_item", "item_id", F.round("score", 6).alias("score"), "accepted")


def m5_termination_status(s, d):
    seeds, (hops, visited) = _walk(s, d)
    last = hops.where("accepted").groupBy("seed").agg(F.max("depth").alias("last"))
    status = F.when(F.col("last").isNull(), "INCOMPLETE_NO_RELEVANT_CHUNKS").when(F.col("last") < 2, "INCOMPLETE_NO_RELEVANT_CHUNKS").otherwise("INCOMPLETE_MAX_DEPTH")
    return seeds.select("seed").join(last, "seed", "left").select("seed", status.alias("status"))


def m6_context_rows(s, d):
    _, (_, visited) = _walk(s, d)
    return visited.groupBy("seed").agg((F.count("*") - 1).alias("hop_count"), F.array_join(F.array_sort(F.collect_list(F.lpad(F.col("item_id").cast("string"), 20, "0"))), ",").alias("items"))


def m7_iteration_logs(s, d):
    _, (hops, _) = _walk(s, d)
    return hops.groupBy("seed", "depth").agg(F.array_sort(F.collect_list(F.struct("query_item", "item_id", F.when(F.col("accepted"), "EXPLANATORY").otherwise("UNRELATED").alias("verdict")))).alias("retrieved"))


def _grown(s, d):
    """Contexts from the first chunk of every document whose id is divisible by 20, over all chunks, by plain lexical judges."""
    c = seams.embed(chunks(s, d).select((F.col("doc_id") * 1000000 + F.col("w")).alias("item_id"), "doc_id", "w", "content"), "content")
    items = written(c)
    seeds = items.where("w = 0 and doc_id % 20 = 0").select(F.col("doc_id").alias("seed"), "item_id")

    def judge(text):
        words = text.rsplit("\n---\n", 1)[-1].split()
        if text.rstrip().endswith("."):
            return "<|#|>Status<|#|>COMPLETE<|#|>Explanation<|#|>ends with a sentence"
        return f"<|#|>Status<|#|>INCOMPLETE<|#|>Query<|#|>{' '.join(words[-6:])}|{' '.join(words[:6])}<|#|>Explanation<|#|>cut"

    def verify(text):
        query, candidate = text[len("Query: ") :].split("\nCandidate: ", 1)
        shared = set(query.lower().split()) & set(candidate.split("\nContext:\n")[0].lower().split())
        return f"Status: {'EXPLANATORY' if len(shared) > 3 else 'RELATED' if shared else 'UNRELATED'}\nExplanation: {len(shared)} words"

    return X.grow_contexts(seeds, items, judge, verify, written)


def m1_grow_contexts(s, d):
    return _grown(s, d)[1].select("seed", "n", "item_id")


def m6_grown_context_rows(s, d):
    rows = X.context_rows(*_grown(s, d))
    return rows.select("seed", "status", "hop_count", "termination_reason", F.md5(F.col("context").cast("binary")).alias("context_md5"), "chunks_added", "search_history")


def m5_context_statuses(s, d):
    return _grown(s, d)[0]


def m7_context_logs(s, d):
    return _grown(s, d)[2]


WALK = f"""near AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 12) DESC, item_id) AS r FROM (SELECT q.vec_id AS query_id, i.vec_id AS item_id, {DOT} AS score FROM vectors q, vectors i WHERE q.vec_id <> i.vec_id)) WHERE r <= 2),
    h1 AS (SELECT query_id AS seed, 1 AS depth, query_id AS query_item, item_id, score, score >= 0.35 AS accepted FROM near WHERE query_id % 20 = 0),
    v1 AS (SELECT vec_id AS seed, vec_id AS item_id FROM vectors WHERE vec_id % 20 = 0 UNION ALL SELECT seed, item_id FROM h1 WHERE accepted),
    h2 AS (SELECT seed, 2 AS depth, query_item, item_id, score, score >= 0.35 AS accepted FROM (SELECT *, row_number() OVER (PARTITION BY seed, item_id ORDER BY round(score, 12) DESC, query_item) AS r2
        FROM (SELECT h1.seed, h1.item_id AS query_item, near.item_id, near.score FROM h1 JOIN near ON near.query_id = h1.item_id WHERE h1.accepted AND (h1.seed, near.item_id) NOT IN (SELECT seed, item_id FROM v1))) WHERE r2 = 1),
    hops AS (SELECT * FROM h1 UNION ALL SELECT * FROM h2), visited AS (SELECT * FROM v1 UNION ALL SELECT seed, item_id FROM h2 WHERE accepted)
"""
#: The words that are left out, written out for SQL.
STOPPED = ", ".join(f"'{w}'" for w in "a about after all also an and any are as at be been but by can could for from had has have he her his if in into is it its more no not of on or our she so some than that the their them then there these they this to was we were what when which who will with would you your".split())
KEYWORDS = """words AS (SELECT topic, word, count(*) AS tf FROM (SELECT lang AS topic, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM documents) GROUP BY 1, 2),
    weights AS (SELECT topic, word, tf / sum(tf) OVER (PARTITION BY topic) * ln(1 + (SELECT sum(tf) / count(DISTINCT topic) FROM words) / sum(tf) OVER (PARTITION BY word)) AS weight FROM words),
    keywords AS (SELECT topic, word, weight, row_number() OVER (PARTITION BY topic ORDER BY round(weight, 12) DESC, word) AS rank FROM weights)"""

SQLS = {
    "e2_l2_normalize": sql("SELECT vec_id, round(v[1] / sqrt(list_dot_product(v, v)), 6) AS first, CAST(1.0 AS DOUBLE) AS norm FROM vectors", "vectors"),
    "e3_knn_topk": sql(f"SELECT query_id, item_id, round(score, 6) AS score, rank FROM ({KNN}) WHERE rank <= 10", "vectors"),
    "e4_nucleus_topp": sql(f"SELECT query_id, item_id, round(mass, 6) AS mass FROM (SELECT *, coalesce(sum(mass) OVER (PARTITION BY query_id ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM (SELECT *, exp(score) / sum(exp(score)) OVER (PARTITION BY query_id) AS mass FROM ({KNN}) WHERE rank <= 100)) WHERE before < 0.9", "vectors"),
    "e5_retrieve_rerank": sql(f"SELECT query_id, item_id, r2 AS rank, round(1.0 / (1 + abs(query_id - item_id)), 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY abs(query_id - item_id), item_id) AS r2 FROM ({KNN}) WHERE rank <= 10) WHERE r2 <= 2", "vectors"),
    "e6_cosine_rerank": sql(f"SELECT query_id, item_id, r2 AS rank, round(cos, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(cos, 12) DESC, item_id) AS r2 FROM (SELECT k.query_id, k.item_id, list_cosine_similarity(q.v, i.v) AS cos FROM ({KNN}) k JOIN vectors q ON q.vec_id = k.query_id JOIN vectors i ON i.vec_id = k.item_id WHERE rank <= 10)) WHERE r2 <= 5", "vectors"),
    "e7_parse_rankings": "SELECT item_id, chunk, round(CASE WHEN r = 0 THEN 0 ELSE 1 - (r - 1) / 5 END, 6) AS score FROM (SELECT item_id, CAST(chunk AS INTEGER) AS chunk, (chunk - 1 - item_id % 5 + 10) % 5 AS r FROM benchmark, range(1, 6) t(chunk))",
    "e8_parse_score": "SELECT item_id, round(([0.7, 0.25, 1.0, 0.5, 0.5])[CAST(item_id % 5 + 1 AS INTEGER)]::DOUBLE, 6) AS score FROM benchmark",
    "e9_fuse_vectors": sql("""SELECT vec_id, round(u[1] / sqrt(list_dot_product(u, u)), 6) AS first, CAST(1.0 AS DOUBLE) AS norm FROM (SELECT a.vec_id, CASE WHEN b.v IS NULL THEN a.v ELSE list_transform(range(1, len(a.v) + 1), lambda i: (a.v[i] / sqrt(list_dot_product(a.v, a.v)) + b.v[i] / sqrt(list_dot_product(b.v, b.v))) / 2) END AS u
        FROM vectors a LEFT JOIN vectors b ON b.vec_id = a.vec_id - 1 AND b.vec_id % 2 = 0)""", "vectors"),
    "e10_align_chunks": sql("SELECT file_name, chunk_id, w % 4 <> 3 AS found FROM chunks WHERE w % 3 = 0", "chunks"),
    "j1_pictures_in_tables": """SELECT doc, page_no, count(*) AS n FROM (SELECT l_orderkey % 3 AS doc, l_orderkey % 1000 AS page_no, l_quantity AS l, round(l_discount * 100) AS b FROM lineitem) p
        WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderkey % 1000 = page_no AND o_orderkey % 3 = doc AND o_orderkey % 30 <= l AND l + 2 <= o_orderkey % 30 + 25 AND b >= 0 AND b + 2 <= 10) GROUP BY 1, 2""",
    "t2_ngram_vocabulary": f"""WITH w AS (SELECT doc_id, list_filter(regexp_extract_all(lower(text), '[a-z]+'), lambda x: x NOT IN ({STOPPED})) AS w FROM documents)
        SELECT gram, count(DISTINCT doc_id) AS df FROM (SELECT doc_id, unnest(w) AS gram FROM w UNION ALL SELECT doc_id, a || ' ' || b FROM (SELECT doc_id, unnest(w[:-2]) AS a, unnest(w[2:]) AS b FROM w WHERE len(w) > 1)) GROUP BY 1 HAVING count(DISTINCT doc_id) >= 2""",
    "t3_topic_keywords": f"WITH {KEYWORDS} SELECT topic, word, rank, round(weight, 6) AS weight FROM keywords WHERE rank <= 15",
    "t4_diversify_keywords": f"""WITH RECURSIVE {KEYWORDS}, counted AS (SELECT topic, word, weight, rank, list_transform(range(64), lambda i: CAST(len(list_filter(list_transform(range(1, greatest(2, length(word))), lambda p: (ascii(substr(word, CAST(p AS BIGINT), 1)) * 31 + ascii(substr(word, CAST(p + 1 AS BIGINT), 1))) % 64), lambda x: x = i)) AS DOUBLE)) AS n FROM keywords WHERE rank <= 30),
        c AS (SELECT topic, word, rank, weight / max(weight) OVER (PARTITION BY topic) AS share, list_transform(n, lambda x: x / sqrt(list_dot_product(n, n))) AS v FROM counted), vs AS (SELECT topic, list(v ORDER BY rank) AS vs, count(*) AS n FROM c GROUP BY 1),
        walk AS (SELECT topic, 0 AS i, CAST([] AS BIGINT[]) AS chosen FROM vs UNION ALL SELECT w.topic, w.i + 1, list_append(w.chosen, arg_max(c.rank, {{'s': round(0.5 * c.share - 0.5 * coalesce(list_max(list_transform(w.chosen, lambda j: list_dot_product(c.v, vs.vs[j]))), 0), 9), 'r': -c.rank}}))
            FROM walk w JOIN c USING (topic) JOIN vs USING (topic) WHERE w.i < least(10, vs.n) AND NOT list_contains(w.chosen, c.rank) GROUP BY w.topic, w.i, w.chosen)
        SELECT w.topic, c.word, CAST(w.i AS BIGINT) AS rank FROM walk w JOIN c ON c.topic = w.topic AND c.rank = w.chosen[w.i] WHERE w.i > 0""",
    "t5_topic_summary": f"WITH {KEYWORDS} SELECT topic, count(*) AS n, round(count(*) / (SELECT count(*) FROM documents), 6) AS share, (SELECT string_agg(word, ', ' ORDER BY rank) FROM keywords k WHERE k.topic = d.lang AND rank <= 5) AS keywords FROM (SELECT lang AS topic, lang FROM documents WHERE doc_id % 10 <> 0) d GROUP BY topic, lang ORDER BY 2 DESC LIMIT 15",
    "m1_expand_context": sql(f", {WALK} SELECT seed, depth::BIGINT AS depth, query_item, item_id, round(score, 6) AS score, accepted FROM hops", "vectors").replace("\n, near", ",\nnear"),
    "m5_termination_status": sql(f", {WALK} SELECT vec_id AS seed, CASE WHEN coalesce((SELECT max(depth) FROM hops WHERE accepted AND seed = vec_id), 0) < 2 THEN 'INCOMPLETE_NO_RELEVANT_CHUNKS' ELSE 'INCOMPLETE_MAX_DEPTH' END AS status FROM vectors WHERE vec_id % 20 = 0", "vectors").replace("\n, near", ",\nnear"),
    "m6_context_rows": sql(f", {WALK} SELECT seed, count(*) - 1 AS hop_count, string_agg(lpad(CAST(item_id AS VARCHAR), 20, '0'), ',' ORDER BY item_id) AS items FROM visited GROUP BY 1", "vectors").replace("\n, near", ",\nnear"),
}
