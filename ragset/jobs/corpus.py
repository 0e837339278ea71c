"""Queries over documents, pages and chunks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ragset.functions.text import token_estimate, word_count
from ragset.operators import chunking as C
from ragset.operators import datasets as DS
from ragset.operators import evaluation as V
from ragset.sources.files import format_counts, pick_documents
from ragset.sources.shared import shared_dir
from ragset.sources.tables import chunks, docs, lineage, read, sql
from ragset.streaming.ingest import ingest_windows

W = r"[^ \t\n\r\f\x0b]+"
TOK = rf"CAST(floor(len(regexp_extract_all(content, '{W}')) * CAST(1.3 AS DOUBLE)) AS BIGINT)"
STAT_SQL = f"""count(*) AS chunks, CAST(sum(length(content)) AS BIGINT) AS chars, CAST(sum({TOK}) AS BIGINT) AS tokens,
    count(*) FILTER (WHERE img) AS image_chunks, count(*) FILTER (WHERE NOT img AND chunk_type LIKE '%table%') AS table_chunks, count(*) FILTER (WHERE NOT img AND chunk_type NOT LIKE '%table%') AS text_chunks"""
FILES = "SELECT *, 'store/' || dataset || '/' || file_name || '.' || kind AS path FROM (SELECT file_name, dataset, length(text) AS length, (['pdf', 'HTML', 'htm', 'docx', 'xhtml'])[CAST(doc_id % 5 + 1 AS INTEGER)] AS kind FROM docs)"
FLAGGED = "(SELECT *, (chunk_type LIKE '%image%' OR artifact <> 'None') AS img FROM chunks)"


def c1_char_windows(s, d):
    w = C.char_windows(docs(s, d), 1000, 100)
    return w.select("file_name", F.col("w").cast("long").alias("w"), F.length("content").cast("long").alias("n_chars"), F.md5(F.col("content").cast("binary")).alias("content_md5"))


def c2_parse_chunk_records(s, d):
    """Replies are built from chunks: three of four have five fields."""
    f = ["chunk_id", "chunk_type", "content", "artifact", "status"]
    full = F.concat(*[x for n in f for x in (F.lit(f"<{n}>"), F.col(n), F.lit("<|#|>"))], F.lit("<chunk_end>"))
    short = F.concat(F.lit("<chunk_id>"), F.col("chunk_id"), F.lit("<|#|>broken<chunk_end>"))
    r = chunks(s, d).select("file_name", F.col("w"), F.when(F.col("w") % 4 == 3, short).otherwise(full).alias("reply"))
    p = C.parse_chunk_records(r)
    return p.select("file_name", "w", "chunk_id", F.when(F.col("well_formed"), F.col("chunk_type")).alias("chunk_type"), F.when(F.col("well_formed"), F.col("status")).alias("status"), "well_formed")


def c3_backfill_artifact(s, d):
    c = chunks(s, d).withColumn("content", F.concat(F.lit("see "), F.col("artifact"), F.lit(" and "), F.col("artifact")))
    empty = F.when(F.col("w") % 3 == 0, F.lit("None")).when(F.col("w") % 3 == 1, F.lit("")).otherwise(F.col("artifact"))
    return c.select("file_name", "w", C.backfill_artifact(F.col("content"), empty).alias("artifact"))


def c5_stitch_windows(s, d):
    return C.stitch_windows(chunks(s, d)).select("file_name", "w", "n_windows", F.length("content").cast("long").alias("n_chars"))


def r7_ingest_stream(s, d):
    """All documents through the stream, then its windows by source."""
    base = f"{shared_dir(s)}/ragset-stream-{uuid.uuid4().hex}"
    w = ingest_windows(s, f"{d}/documents.parquet*", f"{base}/out", f"{base}/checkpoint")
    return w.groupBy("dataset").agg(F.count("*").alias("windows"), F.countDistinct("doc_id").alias("documents"))


def c6_block_type(s, d):
    """Whole chunks, made to look like their type: a table's row, an image, a figure's caption, an entry of a table of contents."""
    c = chunks(s, d)
    row = F.when(F.col("chunk_type").contains("table"), F.lit("\n| a | b |\n")).otherwise("")
    image = F.when(F.col("artifact") != "None", F.concat(F.lit("\n"), F.col("artifact"), F.lit("\n"))).otherwise("")
    end = F.when(F.col("chunk_type") == "figure", F.lit("\nFigure 7 - x")).when(F.col("chunk_type") == "index", F.lit("\nOverview ..... 3\n")).otherwise("")
    body = F.concat(F.translate("content", "|", " "), row, image, end)
    return c.withColumn("t", C.block_type(body)).groupBy("chunk_type", F.col("t").alias("found_type")).agg(F.count("*").alias("n"))


def c6_segment_markdown(s, d):
    """Every document as markdown: headings, contents, its whole text, tables with and without images, figures, a heading at the end."""
    kind, n = F.pmod("doc_id", F.lit(6)), F.col("doc_id").cast("string")
    when = lambda k, *parts: F.when(kind == k, F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))).otherwise("")
    text = F.concat(
        F.lit("# Document "), n, F.lit("\n\n"), when(0, "Contents ...... 1\n\nBody ........ 2\n"), when(1, "## Part\n### Section\n\n"), F.coalesce("text", F.lit("")), F.lit("\n"),
        when(2, "\nTable 2 - sums\n\n| a | b |\n|---|---|\n| 1 | 2 |\nNote: all\n"), when(3, "\n| a | ![x](i/", n, ".png) |\n"), when(4, "\n![x](i/", n, ".png)\n\nFigure 3.1 - seen\n\nand more text"), when(5, "\n![](l.png)\n\n## Last"),
    )
    m = C.segment_markdown(docs(s, d).withColumn("text", text))
    return m.select("doc_id", "chunk_id", "chunk_type", F.md5(F.col("content").cast("binary")).alias("content_md5"), "artifact", "status")


def c7_fixed_chunks(s, d):
    c = C.fixed_chunks(docs(s, d), 256)
    return c.select("file_name", F.col("k").cast("long").alias("k"), F.md5(F.col("content").cast("binary")).alias("content_md5"))


def c8_renumber_chunks(s, d):
    return C.renumber_chunks(chunks(s, d)).select("file_name", "w", F.col("number").cast("long").alias("number"), "global_chunk_id")


def c9_chunk_summary(s, d):
    return C.chunk_summary(chunks(s, d))


def p1_token_estimate(s, d):
    return docs(s, d).select("doc_id", token_estimate(F.col("text")).alias("tokens"))


def p2_file_chunk_stats(s, d):
    return C.file_chunk_stats(chunks(s, d), "file_name")


def p3_dataset_rollup(s, d):
    """Chunk statistics of files against their page counts."""
    stats = C.file_chunk_stats(chunks(s, d), "dataset", "file_name")
    pages = docs(s, d).select("file_name", "dataset", C.page_estimate(F.col("text")).alias("pages"))
    return DS.dataset_rollup(stats, pages).withColumns({"chunks_per_file": F.round("chunks_per_file", 6), "tokens_per_page": F.round("tokens_per_page", 6)})


def p4_datasets_total(s, d):
    return C.datasets_total(C.file_chunk_stats(chunks(s, d), "dataset"))


def p5_corpus_stats(s, d):
    return DS.corpus_stats(chunks(s, d)).withColumn("mean_tokens", F.round("mean_tokens", 6))


def p6_page_estimate(s, d):
    p = read(s, d, "pages").select("page_id", C.html_to_text(F.col("html")).alias("t"))
    return p.select("page_id", C.page_estimate(F.col("t")).alias("pages"), word_count(F.col("t")).alias("words"))


def s7_html_to_text(s, d):
    return read(s, d, "pages").select("page_id", F.md5(C.html_to_text(F.col("html")).cast("binary")).alias("text_md5"))


def p10_artifact_counts(s, d):
    """Images and tables by file and overall; references are counted, not folders."""
    return DS.artifact_counts(chunks(s, d))


def p11_match_files(s, d):
    """A page matches the first document whose number its own ends with."""
    p = read(s, d, "pages").select("page_id", F.concat(F.lit("DOC_"), F.lpad(F.col("page_id").cast("string"), 20, "0"), F.lit("_REF")).alias("source"))
    return C.match_files(p, docs(s, d).select("file_name"), "page_id")


def e11_image_refs(s, d):
    c = chunks(s, d).where("artifact <> 'None'")
    refs = C.image_refs(F.col("artifact"), F.col("file_name"))
    return c.select("file_name", "chunk_id", F.element_at(refs, 1).alias("image_path"), F.size(refs).cast("long").alias("n_images"))


def e12_has_image(s, d):
    c = chunks(s, d)
    path = F.when(F.col("w") % 2 == 0, F.col("artifact"))
    return c.groupBy(C.has_image(path, F.col("artifact")).alias("has_image")).agg(F.count("*").alias("n"))


def q9_filter_chunks_by_type(s, d):
    c = chunks(s, d)
    of = lambda t: DS.filter_chunks_by_type(c, t).groupBy(F.lit(t).alias("qa_type"), "chunk_type").agg(F.count("*").alias("n"))
    return of("multihop").unionByName(of("multimodal")).unionByName(of("text"))


def q11_shuffle_seeded(s, d):
    """All chunks in a seeded order."""
    return chunks(s, d).select("file_name", "chunk_id", DS.seeded_order("file_name", "chunk_id").alias("k")).orderBy("k", "file_name", "chunk_id")


def v13_domain_coverage(s, d):
    return V.domain_coverage(chunks(s, d), lineage(s, d)).withColumn("jsd", F.round("jsd", 6))


def v14_coverage_by(s, d):
    """By file, by kind of chunk and by dataset."""
    return V.coverage_by(chunks(s, d), lineage(s, d), "file_name", "chunk_type", "dataset").withColumn("rate", F.round("rate", 6))


def v15_uncovered_chunks(s, d):
    return V.uncovered_chunks(chunks(s, d), lineage(s, d))


def r4_pending(s, d):
    """Files without a finished window."""
    return DS.pending(docs(s, d).select("file_name"), chunks(s, d).where("status = 'INCOMPLETE'").select("file_name").distinct(), "file_name")


def r5_progress_summary(s, d):
    return DS.progress_summary(chunks(s, d), "dataset", "status", "w").withColumnRenamed("dataset", "stage")


def _files(s, d):
    """Documents as files of several formats: their paths and lengths."""
    end = F.element_at(F.array(*map(F.lit, ["pdf", "HTML", "htm", "docx", "xhtml"])), (F.pmod("doc_id", F.lit(5)) + 1).cast("int"))
    return docs(s, d).select(F.concat(F.lit("store/"), "dataset", F.lit("/"), "file_name", F.lit("."), end).alias("path"), F.length("text").cast("long").alias("length"))


def s2_list_documents(s, d):
    """The smallest 50 of the pending files; the limit is the operator's feature."""
    done = chunks(s, d).where("status = 'INCOMPLETE'").select("file_name")
    return pick_documents(_files(s, d), done, 50)


def s2_format_counts(s, d):
    return format_counts(_files(s, d))


SQLS = {
    "c1_char_windows": sql("SELECT file_name, w, length(content) AS n_chars, md5(content) AS content_md5 FROM windows", "windows"),
    "c2_parse_chunk_records": sql("SELECT file_name, w, chunk_id, CASE WHEN w % 4 <> 3 THEN chunk_type END AS chunk_type, CASE WHEN w % 4 <> 3 THEN status END AS status, w % 4 <> 3 AS well_formed FROM chunks", "chunks"),
    "c3_backfill_artifact": sql("SELECT file_name, w, CASE WHEN w % 3 = 2 AND artifact <> 'None' THEN artifact WHEN artifact <> 'None' THEN artifact || ' ' || artifact ELSE 'None' END AS artifact FROM chunks", "chunks"),
    "c6_block_type": sql("SELECT chunk_type, chunk_type AS found_type, count(*) AS n FROM chunks GROUP BY 1, 2", "chunks"),
    # lines as rows: a block opens where a line differs from the last one that is not blank
    "c6_segment_markdown": r"""WITH made AS (SELECT doc_id, string_split('# Document ' || doc_id || chr(10) || chr(10) || CASE doc_id % 6 WHEN 0 THEN 'Contents ...... 1' || chr(10) || chr(10) || 'Body ........ 2' || chr(10) WHEN 1 THEN '## Part' || chr(10) || '### Section' || chr(10) || chr(10) ELSE '' END
            || coalesce(text, '') || chr(10) || CASE doc_id % 6 WHEN 2 THEN chr(10) || 'Table 2 - sums' || chr(10) || chr(10) || '| a | b |' || chr(10) || '|---|---|' || chr(10) || '| 1 | 2 |' || chr(10) || 'Note: all' || chr(10)
            WHEN 3 THEN chr(10) || '| a | ![x](i/' || doc_id || '.png) |' || chr(10) WHEN 4 THEN chr(10) || '![x](i/' || doc_id || '.png)' || chr(10) || chr(10) || 'Figure 3.1 - seen' || chr(10) || chr(10) || 'and more text' WHEN 5 THEN chr(10) || '![](l.png)' || chr(10) || chr(10) || '## Last' ELSE '' END, chr(10)) AS x FROM documents),
        lines AS (SELECT doc_id, unnest(x) AS line, generate_subscripts(x, 1) AS i FROM made),
        kinds AS (SELECT *, CASE WHEN regexp_full_match(line, '[ \t\r\f\x0b]*') THEN NULL WHEN regexp_matches(line, '^ {0,3}#{1,6}[ \t]') THEN 'heading' WHEN regexp_matches(line, '^.{1,80}\.{4,} *[0-9]+ *$') THEN 'index' WHEN regexp_matches(line, '^[ \t]*\|.*\|[ \t]*$') THEN 'row'
            WHEN regexp_matches(line, '^[ \t*_]*(?i:figure|fig\.)[ \t]+[A-Z0-9]') THEN 'figcap' WHEN regexp_matches(line, '^[ \t*_]*(?i:table|tab\.)[ \t]+[A-Z0-9]') THEN 'tabcap' WHEN regexp_matches(line, '!\[[^\]]*\]\([^)]+\)') THEN 'image' ELSE 'text' END AS k FROM lines),
        seen AS (SELECT doc_id, i, k, lag(k) OVER w AS p, i - lag(i) OVER w > 1 AS gap, max(CASE WHEN k <> 'heading' THEN i END) OVER (PARTITION BY doc_id) AS last FROM kinds WHERE k IS NOT NULL WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
        starts AS (SELECT doc_id, i FROM seen WHERE p IS NULL OR (i <= last AND p <> 'heading' AND (k = 'heading' OR (k = 'index') <> (p = 'index') OR (gap AND NOT ((k = 'row' AND p = 'tabcap') OR (k = 'figcap' AND p = 'image') OR (k = 'index' AND p = 'index')))))),
        numbered AS (SELECT l.doc_id, l.i, line, count(s.i) OVER (PARTITION BY l.doc_id ORDER BY l.i) AS b FROM lines l LEFT JOIN starts s ON s.doc_id = l.doc_id AND s.i = l.i),
        blocks AS (SELECT doc_id, b, regexp_replace(string_agg(line, chr(10) ORDER BY i), '(?:\n[ \t\r\f\x0b]*)+$', '') AS content, b = max(b) OVER (PARTITION BY doc_id) AS final FROM numbered WHERE b > 0 GROUP BY doc_id, b),
        typed AS (SELECT *, CASE WHEN regexp_matches(content, '(?m)^.{1,80}\.{4,} *[0-9]+ *$') THEN 'index' WHEN regexp_matches(content, '(?m)^[ \t]*\|.*\|[ \t]*$') THEN CASE WHEN contains(content, '![') THEN 'table with images' ELSE 'table' END
            WHEN contains(content, '![') THEN CASE WHEN regexp_matches(content, '(?m)^Figure ') THEN 'figure' ELSE 'standalone image' END ELSE 'text' END AS chunk_type FROM blocks)
        SELECT doc_id, CAST(b AS VARCHAR) AS chunk_id, chunk_type, md5(CASE WHEN chunk_type = 'index' THEN 'None' ELSE content END) AS content_md5, CASE WHEN contains(chunk_type, 'image') OR chunk_type = 'figure' THEN regexp_extract(content, '!\[[^\]]*\]\([^)]+\)') ELSE 'None' END AS artifact,
            CASE WHEN chunk_type = 'index' OR NOT final OR regexp_matches(content, '[.!?:;…)\]}\"''»”*`|>]$') THEN 'COMPLETE' ELSE 'INCOMPLETE' END AS status FROM typed""",
    "r7_ingest_stream": sql("SELECT dataset, count(*) AS windows, count(DISTINCT doc_id) AS documents FROM windows GROUP BY 1", "windows"),
    "c7_fixed_chunks": sql(f"SELECT file_name, k, md5(array_to_string(list_slice(w, k * 256 + 1, k * 256 + 256), ' ')) AS content_md5 FROM (SELECT *, unnest(range(CAST((len(w) + 255) // 256 AS BIGINT))) AS k FROM (SELECT file_name, regexp_extract_all(text, '{W}') AS w FROM docs))", "docs"),
    "c8_renumber_chunks": sql("SELECT file_name, w, row_number() OVER (PARTITION BY file_name ORDER BY w) AS number, 'chunk_' || CAST(row_number() OVER (ORDER BY file_name, w) AS VARCHAR) AS global_chunk_id FROM chunks", "chunks"),
    "c9_chunk_summary": sql(f"SELECT chunk_type, status, count(*) AS n, round(avg(len(regexp_extract_all(content, '{W}'))), 6) AS mean_words FROM chunks GROUP BY GROUPING SETS ((chunk_type), (status), ())", "chunks"),
    "p1_token_estimate": sql(f"SELECT doc_id, {TOK} AS tokens FROM (SELECT doc_id, text AS content FROM docs)", "docs"),
    "p2_file_chunk_stats": sql(f"SELECT file_name, {STAT_SQL} FROM {FLAGGED} GROUP BY 1", "chunks"),
    "p3_dataset_rollup": sql(f"""SELECT *, round(chunks / files, 6) AS chunks_per_file, round(CASE WHEN pages > 0 THEN tokens / pages ELSE 0 END, 6) AS tokens_per_page FROM (
        SELECT coalesce(a.dataset, b.dataset) AS dataset, count(*) AS files, CAST(coalesce(sum(chunks), 0) AS BIGINT) AS chunks, CAST(coalesce(sum(tokens), 0) AS BIGINT) AS tokens, CAST(coalesce(sum(pages), 0) AS BIGINT) AS pages
        FROM (SELECT dataset, file_name, {STAT_SQL} FROM {FLAGGED} GROUP BY 1, 2) a FULL JOIN (SELECT file_name, dataset, greatest(1, len(regexp_extract_all(text, '{W}')) // 2500, length(text) // 13000) AS pages FROM docs) b USING (file_name) GROUP BY 1)""", "chunks"),
    "p4_datasets_total": sql(f"SELECT coalesce(dataset, 'TOTAL') AS dataset, {STAT_SQL} FROM {FLAGGED} GROUP BY ROLLUP (dataset)", "chunks"),
    "p5_corpus_stats": sql(f"""SELECT count(*) AS total, count(*) FILTER (WHERE chunk_type = 'table') AS tables, count(*) FILTER (WHERE chunk_type = 'standalone image') AS standalone_images, count(*) FILTER (WHERE chunk_type NOT IN ('table', 'standalone image')) AS texts,
        count(*) FILTER (WHERE artifact <> 'None') AS multimodal, CAST(sum({TOK}) AS BIGINT) AS tokens, round(avg({TOK}), 6) AS mean_tokens, count(DISTINCT file_name) AS files FROM chunks""", "chunks"),
    "p6_page_estimate": rf"SELECT page_id, greatest(1, len(regexp_extract_all(t, '{W}')) // 2500, length(t) // 13000) AS pages, len(regexp_extract_all(t, '{W}')) AS words FROM (SELECT page_id, trim(regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '[ \t\n\r\f\x0b]+', ' ', 'g')) AS t FROM pages)",
    "s7_html_to_text": r"SELECT page_id, md5(trim(regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '[ \t\n\r\f\x0b]+', ' ', 'g'))) AS text_md5 FROM pages",
    "p10_artifact_counts": sql("SELECT file_name, count(DISTINCT CASE WHEN artifact <> 'None' THEN artifact || file_name END) AS images, count(DISTINCT CASE WHEN chunk_type LIKE 'table%' THEN file_name || chunk_id END) AS tables FROM chunks GROUP BY ROLLUP (file_name)", "chunks"),
    "p11_match_files": sql("SELECT page_id, min(file_name) AS file_name FROM pages JOIN docs ON contains('doc_' || lpad(CAST(page_id AS VARCHAR), 20, '0') || '_ref', file_name) GROUP BY 1", "docs"),
    "e11_image_refs": sql("SELECT file_name, chunk_id, 'base/' || file_name || '/' || regexp_extract(artifact, '\\(([^)]+)\\)', 1) AS image_path, CAST(1 AS BIGINT) AS n_images FROM chunks WHERE artifact <> 'None'", "chunks"),
    "e12_has_image": sql("SELECT artifact <> 'None' AS has_image, count(*) AS n FROM chunks GROUP BY 1", "chunks"),
    "q9_filter_chunks_by_type": sql("SELECT qa_type, chunk_type, count(*) AS n FROM (SELECT 'multihop' AS qa_type, chunk_type FROM chunks UNION ALL SELECT CASE WHEN artifact <> 'None' THEN 'multimodal' ELSE 'text' END, chunk_type FROM chunks) GROUP BY 1, 2", "chunks"),
    "q11_shuffle_seeded": sql("SELECT file_name, chunk_id, md5('42' || file_name || '|' || chunk_id) AS k FROM chunks ORDER BY 3, 1, 2", "chunks"),
    "v13_domain_coverage": sql("""SELECT chunks, files, covered_chunks, covered_files, jsd, chunks - covered_chunks AS uncovered FROM (SELECT count(*) AS chunks, count(DISTINCT file_name) AS files FROM chunks),
        (SELECT count(*) AS covered_chunks, count(DISTINCT file_name) AS covered_files FROM chunks WHERE (file_name, chunk_id) IN (SELECT file_name, chunk_id FROM lineage)),
        (SELECT round(sum(0.5 * p * ln(p / ((p + q) / 2)) + 0.5 * q * ln(q / ((p + q) / 2))), 6) AS jsd FROM (SELECT coalesce(rn, 0) / sum(rn) OVER () + CAST(1e-10 AS DOUBLE) AS p, cn / sum(cn) OVER () + CAST(1e-10 AS DOUBLE) AS q
            FROM (SELECT file_name, CAST(count(*) AS DOUBLE) AS cn FROM chunks GROUP BY 1) LEFT JOIN (SELECT file_name, CAST(count(*) AS DOUBLE) AS rn FROM lineage GROUP BY 1) USING (file_name)))""", "chunks", "lineage"),
    "v14_coverage_by": sql("SELECT file_name, chunk_type, dataset, count(*) AS n, count(hit) AS covered, round(count(hit) / count(*), 6) AS rate FROM chunks LEFT JOIN (SELECT DISTINCT file_name, chunk_id, 1 AS hit FROM lineage) USING (file_name, chunk_id) GROUP BY GROUPING SETS ((file_name), (chunk_type), (dataset))", "chunks", "lineage"),
    "v15_uncovered_chunks": sql("SELECT file_name, chunk_id FROM chunks WHERE (file_name, chunk_id) NOT IN (SELECT file_name, chunk_id FROM lineage)", "chunks", "lineage"),
    "r4_pending": sql("SELECT file_name FROM docs WHERE file_name NOT IN (SELECT file_name FROM chunks WHERE status = 'INCOMPLETE')", "chunks"),
    "r5_progress_summary": sql("SELECT dataset AS stage, count(*) FILTER (WHERE status = 'COMPLETE') AS completed, count(*) FILTER (WHERE status = 'INCOMPLETE') AS failed, max(w) AS last FROM chunks GROUP BY 1", "chunks"),
    "s2_list_documents": sql(f"SELECT file_name, path, length FROM ({FILES}) WHERE kind <> 'docx' AND file_name NOT IN (SELECT file_name FROM chunks WHERE status = 'INCOMPLETE') ORDER BY length, path LIMIT 50", "chunks"),
    "s2_format_counts": sql(f"SELECT CASE WHEN kind = 'docx' THEN 'other' ELSE lower(kind) END AS format, count(*) AS files, CAST(sum(length) AS BIGINT) AS bytes FROM ({FILES}) GROUP BY 1", "docs"),
}
