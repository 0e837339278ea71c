"""Model replies: generated questions, packs, gates, search strings, claims and verdicts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ragset.functions.text import MARK, clean, is_missing, keyed

#: What a question and an answer say when they speak of a figure; the labels of a verification; words of references.
_SHOWN = "(figure|diagram|schematic|image|chart|graph|picture)"
VISUAL_QUESTION = "(?i)" + "|".join(
    [
        rf"\b(as\s+)?(depicted|shown|illustrated|displayed)\s+(in|by)\s+(the\s+)?{_SHOWN}",
        rf"\b(the\s+)?{_SHOWN}\s+(shows|depicts|illustrates)",
        rf"\bbased\s+on\s+(the\s+)?{_SHOWN}",
        rf"\baccording\s+to\s+(the\s+)?{_SHOWN}",
        rf"\b(in|from)\s+(the\s+)?{_SHOWN}",
    ]
)
VISUAL_ANSWER = "(?i)" + "|".join(
    [
        r"\b(the\s+)?(figure|diagram|image|chart|graph)\s+(shows|indicates|displays)",
        r"\bvisual(ly)?",
        r"\b(top|bottom|left|right|center)\s+(of|portion|section)",
        r"\b(axis|legend|label|arrow|line|curve|bar)",
    ]
)
GOOD, BAD = ["QUESTION_CORRECT", "ANSWER_CORRECT", "REQUIRES_CONTENT"], ["QUESTION_INCORRECT", "ANSWER_INCORRECT", "CAN_ANSWER_WITHOUT_CONTENT"]
REFERENCE = r"(?i)(Figure|Table|Annex|Formula)\s*[A-Z]?\.?[0-9]+(?:\.[0-9]+)?"


def status_of(c: Column) -> Column:
    """The reply's Status field; the whole reply where it has no marked fields or no such field."""
    return F.coalesce(F.when(c.contains(MARK), keyed(c, "Status")), c)


def reply_header(reply: Column) -> Column:
    """(chunk_count, keywords_per_chunk, related_keywords) before a reply's QA_GENERATION mark; nulls where a field is absent."""
    head = F.when(reply.contains(f"{MARK}QA_GENERATION{MARK}"), F.split(reply, r"<\|#\|>QA_GENERATION<\|#\|>")[0])
    part = lambda p: F.regexp_extract(head, p, 1)
    some = lambda x: F.when(x != "", x)
    words = some(part(r"(?is)Keywords per Chunk:\s*<?(.+?)>?\s*(?:Related Keywords:|$)"))
    return F.named_struct(
        F.lit("chunk_count"), some(part(r"(?i)Chunk Count:\s*([0-9]+)")).cast("int"), F.lit("keywords_per_chunk"), parse_keyword_map(words),
        F.lit("related_keywords"), some(clean(part(r"(?is)Related Keywords:\s*<?(.+?)>?\s*(?:<\|#\||$)"))),
    )


def parse_generated_qa(replies: DataFrame, reply: str = "reply") -> DataFrame:
    """A row a question: section parts of marked fields, else inline 'Question: … Answer: …' lines, else the whole reply as a question; each with the reply's header."""
    body = F.regexp_replace(reply, r"(?s)DECOMPOSITION.*$", "")
    sections = F.filter(F.split(body, r"<\|#\|>(?:QA_GENERATION|NEXT)<\|#\|>"), lambda x: x.rlike(r"(?i)question") & ~x.contains("Chunk Count:") & ~x.contains("Keywords per Chunk:"))
    rows = replies.select("*", reply_header(F.col(reply)).alias("header"), F.posexplode(F.when(F.size(sections) > 0, sections).otherwise(F.array(F.col(reply)))).alias("section", "part"))
    q = F.coalesce(keyed(F.col("part"), "Question"), clean(F.col(reply)))
    return rows.select(
        *[c for c in replies.columns if c != reply], "section", q.alias("question"), F.coalesce(keyed(F.col("part"), "Answer"), F.lit("")).alias("answer"),
        F.coalesce(keyed(F.col("part"), "Relevance"), F.lit("0")).alias("relevance"), F.coalesce(keyed(F.col("part"), "Difficulty"), F.lit("0")).alias("difficulty"), "header.chunk_count", "header.keywords_per_chunk", "header.related_keywords",
    )


def parse_keyword_map(c: Column) -> Column:
    """'Chunk 1: [A, B]' becomes chunk_1 -> [A, B]; of a repeated chunk the last list counts."""
    keys = F.transform(F.regexp_extract_all(c, F.lit(r"Chunk ([0-9]+): \[([^\]]*)\]"), F.lit(1)), lambda k: F.concat(F.lit("chunk_"), k))
    values = F.transform(F.regexp_extract_all(c, F.lit(r"Chunk ([0-9]+): \[([^\]]*)\]"), F.lit(2)), lambda v: F.transform(F.split(v, ","), clean))
    last = lambda e, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys) + 1), e["k"])
    return F.map_from_entries(F.filter(F.zip_with(keys, values, lambda k, v: F.named_struct(F.lit("k"), k, F.lit("v"), v)), last))


def parse_packs(replies: DataFrame, reply: str = "reply") -> DataFrame:
    """A row a question and answer pack; packs without either are left out."""
    rows = replies.select("*", F.posexplode(F.split(reply, r"<\|#\|>NEXT<\|#\|>")).alias("pack", "part"))
    out = rows.select(*[c for c in replies.columns if c != reply], "pack", keyed(F.col("part"), "Question").alias("question"), keyed(F.col("part"), "Answer").alias("answer"))
    return out.where("question is not null and answer is not null").withColumn("reorganized", F.lit(True))


def select_gate(replies: DataFrame, reply: str = "reply") -> DataFrame:
    """status SELECTED, REJECTED or ERROR, and the reply's scores and reason."""
    c = F.col(reply)
    status = F.upper(F.coalesce(keyed(c, "Status", last=True), F.lit("")))
    return replies.withColumn("status", F.when(c.startswith("ERROR:"), "ERROR").when(status == "SELECTED", "SELECTED").otherwise("REJECTED")).withColumns(
        {"relevance": F.coalesce(keyed(c, "Relevance", last=True), F.lit("0")), "difficulty": F.coalesce(keyed(c, "Difficulty", last=True), F.lit("0")), "reason": keyed(c, "Reason", last=True)}
    )


def relevant(c: Column) -> Column:
    """Whether the reply's status says RELEVANT and not NOT_RELEVANT; a missing reply does not."""
    up = F.upper(F.coalesce(status_of(c), F.lit("")))
    return up.contains("RELEVANT") & ~up.contains("NOT_RELEVANT")


def relevance_gate(rows: DataFrame, reply: str = "reply", content: str = "content", most: int = 2000) -> tuple[DataFrame, DataFrame]:
    """(relevant rows, the others with the content cut to most characters)."""
    rated = rows.withColumn("relevant", relevant(F.col(reply)))
    return rated.where("relevant").drop("relevant"), rated.where("not relevant").drop("relevant").withColumn(content, F.substring(content, 1, most))


def misleading_visual(question: Column, answer: Column, has_image: Column) -> Column:
    """The question speaks of a figure, but there is no image or the answer has no visual wording."""
    return question.rlike(VISUAL_QUESTION) & (~has_image | ~answer.rlike(VISUAL_ANSWER))


def verified(c: Column, question: Column | None = None, answer: Column | None = None, has_image: Column | None = None) -> Column:
    """All good labels and no bad one in the reply's status; with question and answer, no misleading reference to a figure either."""
    up, ok = F.upper(F.coalesce(status_of(c), F.lit(""))), F.lit(True)
    for word in GOOD:
        ok = ok & up.contains(word)
    for word in BAD:
        ok = ok & ~up.contains(word)
    if question is None or answer is None:
        return ok
    said = (F.coalesce(question, F.lit("")) != "") & (F.coalesce(answer, F.lit("")) != "")
    return ok & ~(said & misleading_visual(question, answer, F.lit(False) if has_image is None else has_image))


def search_strings(reply: Column, explanation: Column, breadth: int = 5) -> Column:
    """Queries split at '|', unquoted, without 'none'; else the words of the explanation's references (figure, table, annex, formula)."""
    said = F.transform(F.split(F.coalesce(reply, F.lit("")), r"\|"), lambda x: F.regexp_replace(clean(x), "^[\"']+|[\"']+$", ""))
    said = F.filter(said, lambda x: (x != "") & (F.lower(x) != "none"))
    found = F.regexp_extract_all(F.coalesce(explanation, F.lit("")), F.lit(REFERENCE), F.lit(1))
    return F.slice(F.when(F.size(said) > 0, said).otherwise(found), 1, breadth)


def claim_verdicts(replies: DataFrame, key: str, reply: str, n: str, label: str = "CLAIM") -> DataFrame:
    """(key, i, supported) for i in 1..n: the label's own verdict (its first), else the reply's i-th line, else false. Case does not matter."""
    g = lambda k: F.regexp_extract_all(F.col(reply), F.lit(rf"(?i){label}_([0-9]+):\s*(SUPPORTED|NOT_SUPPORTED)"), F.lit(k))
    marks = replies.select(key, F.posexplode(F.arrays_zip(g(1).alias("i"), g(2).alias("v"))).alias("p", "x")).groupBy(key, F.col("x.i").cast("int").alias("i")).agg(F.upper(F.min_by("x.v", "p")).alias("v"))
    every = replies.where(F.col(n) > 0).select(key, F.split(clean(F.col(reply)), "\n").alias("lines"), F.explode(F.sequence(F.lit(1), F.col(n).cast("int"))).alias("i"))
    line = F.upper(F.coalesce(F.try_element_at("lines", F.col("i")), F.lit("")))
    verdict = F.coalesce(F.col("v"), line)
    return every.join(marks, [key, "i"], "left").select(key, "i", (verdict.contains("SUPPORTED") & ~verdict.contains("NOT")).alias("supported"))


#: Characters of the keywords that one automaton holds; more are searched by several automata, one after another.
AUTOMATON = 4_000_000


def keyword_spans(texts: DataFrame, key: str, text: str, keywords: DataFrame, most: int = AUTOMATON) -> DataFrame:
    """(key, start, end) of the merged case-blind hits of keywords (keyword); 0-based, end exclusive. Null texts and empty keywords have none.

    An Aho-Corasick automaton of the keywords reads every text once, whatever their number. Keywords of more than `most`
    characters in all are dealt to several automata by a hash, each of which reads the texts.
    """
    low = texts.select(F.monotonically_increasing_id().alias("_row"), key, F.lower(text).alias("t"))
    k = keywords.select(F.lower("keyword").alias("k")).where("k <> ''").distinct()
    parts = max(1, -(-(k.agg(F.sum(F.length("k")).alias("n")).first().n or 0) // most))
    dealt = k.withColumn("part", F.pmod(F.xxhash64("k"), F.lit(parts))) if parts > 1 else k.withColumn("part", F.lit(0))
    found = low.where("t is not null and t <> ''")
    hits = None
    for part in range(parts):
        words = [r.k for r in dealt.where(F.col("part") == part).collect()]  # about `most` characters

        def search(batches: Iterator[pa.RecordBatch], words=words) -> Iterator[pa.RecordBatch]:
            import ahocorasick

            tree = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
            for w in words:
                tree.add_word(w)
            tree.make_automaton()
            for batch in batches:
                at, starts, ends = [], [], []
                for i, t in enumerate(batch.column("t").to_pylist()):
                    for a, b in _merged((end + 1 - n, end + 1) for end, n in tree.iter(t)) if words else ():
                        at.append(i)
                        starts.append(a)
                        ends.append(b)
                yield pa.RecordBatch.from_arrays([batch.column("_row").take(pa.array(at, pa.int64())), batch.column(key).take(pa.array(at, pa.int64())), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], ["_row", key, "start", "end"])

        own = found.mapInArrow(search, f"_row long, `{key}` {dict(texts.dtypes)[key]}, start int, end int")
        hits = own if hits is None else hits.unionByName(own)
    if parts == 1:
        return hits.drop("_row")
    # spans of several automata overlap: merged once more
    w = Window.partitionBy("_row").orderBy("start", "end")
    new = F.coalesce(F.col("start") >= F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    island = F.sum(F.when(new, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return hits.withColumn("island", island).groupBy("_row", key, "island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("island", "_row")


def _merged(hits: Iterator[tuple[int, int]]) -> list[list[int]]:
    """Spans that overlap, as one; those that only touch stay apart."""
    out: list[list[int]] = []
    for a, b in sorted(hits):
        if out and a < out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def type_match(n_chunks: Column, artifact: Column) -> Column:
    """The kinds of question that a row satisfies."""
    return F.array_compact(F.array(F.when(n_chunks > 1, F.lit("multihop")), F.when(~is_missing(artifact), F.lit("multimodal")).otherwise("text")))


