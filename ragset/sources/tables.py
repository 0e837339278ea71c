"""The working tables, derived from the corpus tables by fixed rules; each with the same rule in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ragset.functions.text import hashed_words
from ragset.operators.chunking import char_windows

TYPES = ["text", "table", "figure", "standalone image", "table with images", "index"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents")
    return d.select("doc_id", F.col("source").alias("dataset"), F.concat(F.lit("doc_"), F.lpad(F.col("doc_id").cast("string"), 20, "0")).alias("file_name"), "text")


def chunks(spark: SparkSession, sf_dir: str, window: int = 1000, overlap: int = 100) -> DataFrame:
    w = char_windows(docs(spark, sf_dir), window, overlap)
    kind = F.element_at(F.array(*map(F.lit, TYPES)), (F.pmod(F.col("doc_id") + F.col("w"), F.lit(6)) + 1).cast("int"))
    mark = F.concat(F.lit("![Image](ref_artifacts/image_"), F.col("doc_id").cast("string"), F.lit("_"), F.col("w").cast("string"), F.lit(".png)"))
    w = w.withColumn("chunk_type", kind).withColumn("artifact", F.when(F.col("chunk_type").isin("figure", "standalone image", "table with images"), mark).otherwise("None"))
    status = F.when((F.pmod(F.col("doc_id") + F.col("w"), F.lit(5)) == 0) & (F.col("w") < F.col("n_windows") - 1), "INCOMPLETE").otherwise("COMPLETE")
    return w.select("doc_id", "dataset", "file_name", F.col("w").cast("long").alias("w"), (F.col("w") + 1).cast("string").alias("chunk_id"), "chunk_type", F.col("content"), "artifact", status.alias("status"))


def qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    c = read(spark, sf_dir, "conversations")
    w = Window.partitionBy("conv_id").orderBy("turn")
    n = c.withColumn("next_role", F.lead("role").over(w)).withColumn("answer", F.lead("text").over(w)).where("role = 'user' and next_role = 'assistant'")
    return n.select(
        (F.col("conv_id") * 100 + F.col("turn")).alias("qa_id"), "conv_id", "turn", F.col("text").alias("question"), "answer",
        F.pmod("conv_id", F.lit(11)).cast("string").alias("relevance_score"), F.pmod(F.col("conv_id") + F.col("turn"), F.lit(11)).cast("string").alias("difficulty_score"),
    )


def lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(qa_id, i, file_name, chunk_id, hop_count) of the chunks that an answer rests on."""
    n_docs = read(spark, sf_dir, "documents").count()
    q = qa(spark, sf_dir).withColumn("n", 1 + F.pmod(F.col("conv_id") + F.col("turn"), F.lit(3)))
    q = q.withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    doc = F.pmod(F.col("conv_id") * 7 + F.col("turn") * 13 + F.col("i") * 17, F.lit(n_docs))
    return q.select("qa_id", "i", F.concat(F.lit("doc_"), F.lpad(doc.cast("string"), 20, "0")).alias("file_name"), F.lit("1").alias("chunk_id"), (F.col("n") - 1).alias("hop_count"))


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, question, answer, q, a, refs, relevance_score, difficulty_score): questions with the vectors of both texts and what the answer rests on, its own chunk and those added."""
    refs = lineage(spark, sf_dir).groupBy("qa_id").agg(F.collect_set(F.concat("file_name", F.lit("|"), "chunk_id")).alias("refs"))
    own = F.array(F.concat(F.lit("#"), F.pmod("qa_id", F.lit(5)).cast("string")))
    q = qa(spark, sf_dir).join(refs, "qa_id", "left").withColumn("refs", F.concat(F.coalesce("refs", F.array().cast("array<string>")), own))
    return q.select(F.col("qa_id").alias("id"), "question", "answer", hashed_words(F.col("question")).alias("q"), hashed_words(F.col("answer")).alias("a"), "refs", "relevance_score", "difficulty_score")


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"), "label")


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, reply): selection replies of labelled documents, errors for the others."""
    d = read(spark, sf_dir, "documents").select("doc_id").join(read(spark, sf_dir, "labels"), "doc_id", "left")
    m = "<|#|>"
    text = F.concat(
        F.lit(f"{m}START{m}Status{m}"), F.when(F.col("quality") == 1, "SELECTED").otherwise("REJECTED"), F.lit(f"{m}Relevance{m}"), F.pmod("doc_id", F.lit(11)).cast("string"),
        F.lit(f"{m}Difficulty{m}"), F.pmod("doc_id", F.lit(7)).cast("string"), F.lit(f"{m}Reason{m}r{m}END{m}"),
    )
    return d.select("doc_id", F.when(F.col("quality").isNotNull(), text).otherwise("ERROR: none").alias("reply"), "quality", "toxic")


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(qa_id, i, claim, supported, source) of the sentences of answers."""
    c = qa(spark, sf_dir).select("qa_id", F.posexplode(F.split("answer", r"\. ")).alias("i", "claim"))
    n = F.length("claim")
    source = F.element_at(F.array(*map(F.lit, ["NONE", "TEXT", "IMAGE", "BOTH"])), (F.pmod(n, F.lit(4)) + 1).cast("int"))
    return c.select("qa_id", F.col("i").cast("long").alias("i"), "claim", (F.pmod(n, F.lit(3)) != 0).alias("supported"), source.alias("source"))


#: The same rules in SQL, to put in front of a query. Each needs those before it.
SQL = {
    "docs": "docs AS (SELECT doc_id, source AS dataset, 'doc_' || lpad(CAST(doc_id AS VARCHAR), 20, '0') AS file_name, text FROM documents)",
    "windows": """counted AS (SELECT *, CASE WHEN length(text) = 0 THEN 0 WHEN length(text) <= 1000 THEN 1 ELSE 1 + CAST(ceil((length(text) - 1000) / 900.0) AS BIGINT) END AS n_windows FROM docs),
        windows AS (SELECT doc_id, dataset, file_name, w, n_windows, substr(text, CAST(w * 900 + 1 AS BIGINT), 1000) AS content FROM (SELECT *, unnest(range(CAST(n_windows AS BIGINT))) AS w FROM counted))""",
    "chunks": """typed AS (SELECT *, (['text','table','figure','standalone image','table with images','index'])[CAST((doc_id + w) % 6 + 1 AS INTEGER)] AS chunk_type FROM windows),
        chunks AS (SELECT doc_id, dataset, file_name, w, CAST(w + 1 AS VARCHAR) AS chunk_id, chunk_type, content,
            CASE WHEN chunk_type IN ('figure','standalone image','table with images') THEN '![Image](ref_artifacts/image_' || CAST(doc_id AS VARCHAR) || '_' || CAST(w AS VARCHAR) || '.png)' ELSE 'None' END AS artifact,
            CASE WHEN (doc_id + w) % 5 = 0 AND w < n_windows - 1 THEN 'INCOMPLETE' ELSE 'COMPLETE' END AS status FROM typed)""",
    "qa": """turns AS (SELECT *, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS answer FROM conversations),
        qa AS (SELECT conv_id * 100 + turn AS qa_id, conv_id, turn, text AS question, answer, CAST(conv_id % 11 AS VARCHAR) AS relevance_score, CAST((conv_id + turn) % 11 AS VARCHAR) AS difficulty_score
            FROM turns WHERE role = 'user' AND next_role = 'assistant')""",
    "lineage": """lineage AS (SELECT qa_id, i, 'doc_' || lpad(CAST((conv_id * 7 + turn * 13 + i * 17) % (SELECT count(*) FROM documents) AS VARCHAR), 20, '0') AS file_name, '1' AS chunk_id, n - 1 AS hop_count
        FROM (SELECT *, unnest(range(n)) AS i FROM (SELECT *, 1 + (conv_id + turn) % 3 AS n FROM qa)))""",
    "questions": """counts AS (SELECT *, list_transform(range(64), lambda i: CAST(len(list_filter(bq, lambda x: x = i)) AS DOUBLE)) AS cq, list_transform(range(64), lambda i: CAST(len(list_filter(ba, lambda x: x = i)) AS DOUBLE)) AS ca FROM (SELECT *,
            list_transform(regexp_extract_all(lower(question), '[a-z]+'), lambda w: (length(w) * 31 + ascii(w) * 7 + ascii(right(w, 1)) * 13) % 64) AS bq, list_transform(regexp_extract_all(lower(answer), '[a-z]+'), lambda w: (length(w) * 31 + ascii(w) * 7 + ascii(right(w, 1)) * 13) % 64) AS ba FROM qa)),
        questions AS (SELECT qa_id AS id, question, answer, list_transform(cq, lambda x: x / sqrt(list_dot_product(cq, cq))) AS q, list_transform(ca, lambda x: x / sqrt(list_dot_product(ca, ca))) AS a, r || ['#' || CAST(qa_id % 5 AS VARCHAR)] AS refs, relevance_score, difficulty_score
            FROM counts JOIN (SELECT qa_id, list(DISTINCT file_name || '|' || chunk_id) AS r FROM lineage GROUP BY 1) USING (qa_id))""",
    "vectors": "vectors AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings)",
    "replies": """replies AS (SELECT doc_id, quality, toxic, CASE WHEN quality IS NULL THEN 'ERROR: none' ELSE '<|#|>START<|#|>Status<|#|>' || CASE WHEN quality = 1 THEN 'SELECTED' ELSE 'REJECTED' END || '<|#|>Relevance<|#|>' || CAST(doc_id % 11 AS VARCHAR)
        || '<|#|>Difficulty<|#|>' || CAST(doc_id % 7 AS VARCHAR) || '<|#|>Reason<|#|>r<|#|>END<|#|>' END AS reply FROM documents LEFT JOIN labels USING (doc_id))""",
    "claims": """claims AS (SELECT qa_id, i - 1 AS i, claim, length(claim) % 3 <> 0 AS supported, (['NONE','TEXT','IMAGE','BOTH'])[CAST(length(claim) % 4 + 1 AS INTEGER)] AS source
        FROM (SELECT qa_id, unnest(s) AS claim, generate_subscripts(s, 1) AS i FROM (SELECT qa_id, string_split(answer, '. ') AS s FROM qa)))""",
}
NEEDS = {"questions": ["qa", "lineage"], "windows": ["docs"], "chunks": ["windows"], "lineage": ["qa"], "claims": ["qa"]}


def sql(query: str, *tables: str) -> str:
    """query after the rules of the tables that it names."""
    order: list[str] = []

    def add(t: str) -> None:
        for n in NEEDS.get(t, []):
            add(n)
        if t not in order:
            order.append(t)

    for t in tables:
        add(t)
    return ("WITH " + ",\n".join(SQL[t] for t in order) + "\n" if order else "") + query
