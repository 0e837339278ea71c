"""Windows, chunk records, chunk numbers and corpus statistics."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ragset.functions.text import IMAGE, clean, is_missing, token_estimate, word_count


#: Windows that are cut from one slice of a text.
PER_SLICE = 64


def char_windows(docs: DataFrame, window: int = 20000, overlap: int = 2000) -> DataFrame:
    """A row a window: slices of window characters that overlap; the last ends with the text; an empty or null text has none.

    Windows are cut from slices of the text, so that none is sought from the start of a long text, nor carries it.
    """
    n, step = F.length("text"), window - overlap
    count = F.when(n == 0, 0).when(n <= window, 1).otherwise(1 + F.ceil((n - window) / step)).cast("long")
    cut = docs.withColumn("n_windows", count).where("n_windows > 0")
    every = F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_windows") - 1) / PER_SLICE))
    slices = F.transform(every, lambda b: F.substring(F.col("text"), (b * (PER_SLICE * step) + 1).cast("int"), F.lit((PER_SLICE - 1) * step + window)))
    slices = F.when(F.col("n_windows") <= PER_SLICE, F.array("text")).otherwise(slices)
    rest = [c for c in docs.columns if c != "text"]
    cut = cut.select(*rest, "n_windows", F.posexplode(slices).alias("_b", "_slice"))
    own = F.sequence(F.lit(0).cast("long"), F.least(F.lit(PER_SLICE), F.col("n_windows") - F.col("_b") * PER_SLICE) - 1)
    w = cut.withColumn("_w", F.explode(own))
    return w.select(*rest, "n_windows", (F.col("_b") * PER_SLICE + F.col("_w")).cast("long").alias("w"), F.substring(F.col("_slice"), (F.col("_w") * step + 1).cast("int"), F.lit(window)).alias("content"))


def parse_chunk_records(replies: DataFrame, reply: str = "reply") -> DataFrame:
    """Chunk fields of each block of a reply, with its place and whether it has the five fields."""
    blocks = replies.select("*", F.posexplode(F.split(reply, "<chunk_end>")).alias("block_no", "block")).where(clean(F.col("block")) != "")
    f = F.split("block", r"<\|#\|>")
    names = ["chunk_id", "chunk_type", "content", "artifact", "status"]
    value = [clean(F.regexp_replace(F.try_element_at(f, F.lit(i + 1)), rf"^[ \t\n\r\f\x0b]*<{n}>", "")).alias(n) for i, n in enumerate(names)]
    kept = [c for c in replies.columns if c != reply]
    return blocks.select(*kept, "block_no", *value, (F.size(f) >= 5).alias("well_formed"))


def backfill_artifact(content: Column, artifact: Column) -> Column:
    """The artifact, or all image marks of the content joined by a space where it is missing."""
    marks = F.array_join(F.regexp_extract_all(content, F.lit(IMAGE), F.lit(0)), " ")
    return F.when(is_missing(artifact), F.when(marks != "", marks).otherwise("None")).otherwise(artifact)


#: What lines of markdown look like: a table's row, an entry of a table of contents, a heading, the captions of figures and tables.
ROW, ENTRY, HEADING = r"^[ \t]*\|.*\|[ \t]*$", r"^.{1,80}\.{4,} *[0-9]+ *$", r"^ {0,3}#{1,6}[ \t]"
FIGURE_CAPTION, TABLE_CAPTION = r"^[ \t*_]*(?i:figure|fig\.)[ \t]+[A-Z0-9]", r"^[ \t*_]*(?i:table|tab\.)[ \t]+[A-Z0-9]"
#: How a text ends that is not cut in a sentence.
ENDED = r"[.!?:;…)\]}\"'»”*`|>][ \t\n\r\f\x0b]*$"


def block_type(c: Column) -> Column:
    """A block's type by its text: index entries, tables without and with images, images with and without a figure's caption, else text."""
    table, image = c.rlike(f"(?m){ROW}"), c.rlike(IMAGE)
    return (
        F.when(c.rlike(f"(?m){ENTRY}"), "index").when(table & image, "table with images").when(table, "table").when(image & c.rlike(f"(?m){FIGURE_CAPTION}"), "figure").when(image, "standalone image").otherwise("text")
    )


def segment_markdown(docs: DataFrame, text: str = "text", least: int = 0) -> DataFrame:
    """docs without text, a row a block: chunk_id ('1', …), chunk_type, content (verbatim), artifact and status. Blank and null texts have no block.

    A pass over a document's lines, each judged by its kind and the one before that is not blank: a block ends at a blank
    line or before a heading; but a heading stays with what follows it (a last one with what comes before), a caption with
    its table or image over a blank line, index entries with each other and apart from the rest. With least, a text shorter than
    that many characters stays with the text after it. Of an index, content and artifact are 'None'. The last block is
    INCOMPLETE where it is cut in a sentence or a table's row. Lines are kept in one array a document; nothing is shuffled.
    """
    blank = lambda x: x.rlike(r"^[ \t\r\f\x0b]*$")
    kind = lambda x: (
        F.when(x.rlike(HEADING), "heading").when(x.rlike(ENTRY), "index").when(x.rlike(ROW), "row").when(x.rlike(FIGURE_CAPTION), "figure caption").when(x.rlike(TABLE_CAPTION), "table caption").when(x.rlike(IMAGE), "image").otherwise("text")
    )
    once = lambda value, use: F.transform(F.array(value), use)[0]  # noqa: E731  value is evaluated once

    def judged(lines: Column) -> Column:
        """(at, kind, gap) of the lines that are not blank."""
        every = F.transform(lines, lambda x, i: F.struct(i.alias("at"), F.when(~blank(x), kind(x)).alias("kind"), ((i > 0) & blank(F.get(lines, i - 1))).alias("gap")))
        return F.filter(every, lambda x: x["kind"].isNotNull())

    def begins(x: Column, before: Column) -> Column:
        k, p = x["kind"], before["kind"]
        linked = ((k == "row") & (p == "table caption")) | ((k == "figure caption") & (p == "image")) | ((k == "index") & (p == "index"))
        return before.isNull() | ((p != "heading") & ((k == "heading") | ((k == "index") != (p == "index")) | (x["gap"] & ~linked)))

    def starts(seen: Column) -> Column:
        found = F.filter(F.transform(seen, lambda x, i: F.when(begins(x, F.get(seen, i - 1)), x["at"])), lambda x: x.isNotNull())
        content = F.array_max(F.transform(F.filter(seen, lambda x: x["kind"] != "heading"), lambda x: x["at"]))
        return F.filter(found, lambda s: (s <= content) | (s == found[0]) | content.isNull())

    def blocks(lines: Column) -> Column:
        # headings alone are one block: they have no later start than their first
        cut = lambda s: F.transform(s, lambda a, i: F.array_join(F.slice(lines, a + 1, F.coalesce(F.get(s, i + 1), F.size(lines)) - a), "\n"))
        return F.transform(once(once(judged(lines), starts), cut), lambda b: F.regexp_replace(b, r"(?:\n[ \t\r\f\x0b]*)+$", ""))

    def merged(parts: Column) -> Column:
        """Parts with the short texts before them."""
        plain = lambda x: (block_type(x) == "text") & ~x.rlike(HEADING)
        opens = F.filter(F.transform(parts, lambda x, i: F.when((i == 0) | ~(plain(x) & (block_type(F.get(parts, i - 1)) == "text") & (F.length(F.get(parts, i - 1)) < least)), i)), lambda x: x.isNotNull())
        return once(opens, lambda s: F.transform(s, lambda a, i: F.array_join(F.slice(parts, a + 1, F.coalesce(F.get(s, i + 1), F.size(parts)) - a), "\n\n")))

    rest = [c for c in docs.columns if c != text]
    lines = F.split(F.coalesce(F.col(text), F.lit("")), "\n")
    found = F.when(~F.coalesce(F.col(text), F.lit("")).rlike(r"^[ \t\n\r\f\x0b]*$"), once(lines, lambda x: once(blocks(x), merged) if least else blocks(x)))
    rows = docs.select(*rest, F.size(found).alias("_n"), F.posexplode(found).alias("_i", "content"))
    typed = rows.withColumn("chunk_type", block_type(F.col("content")))
    index = F.col("chunk_type") == "index"
    whole = index | (F.col("_i") < F.col("_n") - 1) | F.col("content").rlike(ENDED)
    return typed.select(
        *rest, (F.col("_i") + 1).cast("string").alias("chunk_id"), "chunk_type", F.when(index, "None").otherwise(F.col("content")).alias("content"),
        F.when(index, "None").otherwise(backfill_artifact(F.col("content"), F.lit("None"))).alias("artifact"), F.when(whole, "COMPLETE").otherwise("INCOMPLETE").alias("status"),
    )


def fixed_chunks(docs: DataFrame, size: int = 2048) -> DataFrame:
    """A row a run of size words."""
    words = F.regexp_extract_all("text", F.lit(r"[^ \t\n\r\f\x0b]+"), F.lit(0))
    d = docs.withColumn("words", words).where(F.size("words") > 0)
    at = F.explode(F.sequence(F.lit(0), F.floor((F.size("words") - 1) / size).cast("int")))
    return d.withColumn("k", at).withColumn("content", F.array_join(F.slice("words", F.col("k") * size + 1, size), " ")).drop("text", "words")


def renumber_chunks(chunks: DataFrame) -> DataFrame:
    """number within the file, and global_chunk_id over files in sorted order: counts and offsets, no global sort of the chunks."""
    own = F.row_number().over(Window.partitionBy("file_name").orderBy("w"))
    per_file = chunks.groupBy("file_name").agg(F.count("*").alias("n"))
    # offsets in two steps, so that no task sorts all files: sums by a name's first letters, then within them
    per_file = per_file.withColumn("head", F.substring("file_name", 1, 8))
    heads = per_file.groupBy("head").agg(F.sum("n").alias("head_n"))
    before = heads.withColumn("head_before", F.sum("head_n").over(Window.orderBy("head")) - F.col("head_n")).drop("head_n")  # one row a head
    inside = F.sum("n").over(Window.partitionBy("head").orderBy("file_name")) - F.col("n")
    offset = per_file.withColumn("inside", inside).join(before, "head").select("file_name", (F.col("inside") + F.col("head_before")).alias("before"))
    return chunks.withColumn("number", own).join(offset, "file_name").withColumn("global_chunk_id", F.concat(F.lit("chunk_"), (F.col("before") + F.col("number")).cast("string"))).drop("before")


def chunk_summary(chunks: DataFrame) -> DataFrame:
    """Counts and mean words by type, by status and in all."""
    c = chunks.select("chunk_type", "status", word_count(F.col("content")).alias("words"))
    g = c.groupingSets([[F.col("chunk_type")], [F.col("status")], []], F.col("chunk_type"), F.col("status"))
    return g.agg(F.count("*").alias("n"), F.round(F.avg("words"), 6).alias("mean_words"))


def file_chunk_stats(chunks: DataFrame, *by: str) -> DataFrame:
    """chunks, chars, tokens and image, table and text chunks by the given columns."""
    image = F.contains("chunk_type", F.lit("image")) | ~is_missing(F.col("artifact"))
    table = ~image & F.contains("chunk_type", F.lit("table"))
    return chunks.groupBy(*by).agg(
        F.count("*").alias("chunks"), F.sum(F.length("content")).cast("long").alias("chars"), F.sum(token_estimate(F.col("content"))).alias("tokens"),
        F.count_if(image).alias("image_chunks"), F.count_if(table).alias("table_chunks"), F.count_if(~image & ~table).alias("text_chunks"),
    )


def datasets_total(stats: DataFrame) -> DataFrame:
    """One line a dataset and one in all."""
    sums = [F.sum(c).cast("long").alias(c) for c in ("chunks", "chars", "tokens", "image_chunks", "table_chunks", "text_chunks")]
    return stats.rollup("dataset").agg(*sums, F.grouping("dataset").alias("g")).select(F.when(F.col("g") == 1, "TOTAL").otherwise(F.col("dataset")).alias("dataset"), *(F.col(c) for c in ("chunks", "chars", "tokens", "image_chunks", "table_chunks", "text_chunks")))


def html_to_text(c: Column) -> Column:
    return clean(F.regexp_replace(F.regexp_replace(c, "<[^>]+>", ""), r"[ \t\n\r\f\x0b]+", " "))


def page_estimate(c: Column) -> Column:
    """The larger of words / 2500 and characters / 13000, at least 1."""
    one = F.lit(1).cast("long")
    return F.greatest(one, F.floor(word_count(c) / 2500), F.floor(F.length(c) / 13000))


def image_refs(artifact: Column, file_name: Column, base: str = "base") -> Column:
    """The paths of all image marks, under base and the file's folder."""
    return F.transform(F.regexp_extract_all(artifact, F.lit(IMAGE), F.lit(1)), lambda p: F.concat(F.lit(base + "/"), file_name, F.lit("/"), p))


def has_image(path: Column, content: Column) -> Column:
    return ~is_missing(path) | content.rlike(IMAGE)


def find_overlap(content: str, head: str, most: int = 200) -> int:
    """Where, in head, the longest tail of content ends (most characters at most, then 50 less, again and again); 0 if none is there.

    Without an exact hit, runs of white space count as one space.
    """
    for text, size in ((content, lambda s: s), (content, lambda s: " ".join(s.split()))):
        flat, there = size(text), size(head)
        for n in range(min(most, len(flat)), 50, -50):
            at = there.find(flat[-n:])
            if at >= 0:
                end = at + n
                if there is head or there == head:
                    return end
                seen = 0  # the same place with the white space that head has
                for i, c in enumerate(head.lstrip()):
                    if seen == end:
                        return i + len(head) - len(head.lstrip())
                    seen += not c.isspace() or (i > 0 and not head.lstrip()[i - 1].isspace())
                return len(head)
    return 0


def stitch_windows(chunks: DataFrame, overlap: int = 100) -> DataFrame:
    """(file_name, w, n_windows, content): each INCOMPLETE chunk carried into its file's next one, without their overlap.

    A file is cut where a chunk is complete, so that only chained chunks meet in a task.
    """
    by = Window.partitionBy("file_name").orderBy("w")
    first = F.coalesce(F.lag("status").over(by) != "INCOMPLETE", F.lit(True))
    runs = chunks.withColumn("run", F.sum(first.cast("int")).over(by)).select("file_name", "run", "w", "content", "status")
    alone = runs.groupBy("file_name", "run").agg(F.count("*").alias("n_windows"), F.min("w").alias("first_w"), F.min("content").alias("only"))

    def join(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("w")
        text = ""
        for i, part in enumerate(group["content"]):
            end = find_overlap(text, part, 2 * overlap) if i else 0
            text = part if not i else text + part[end:] if end else text + "\n\n" + part
        return pd.DataFrame({"file_name": [group["file_name"].iloc[0]], "w": [group["w"].iloc[0]], "n_windows": [len(group)], "content": [text]})

    chained = runs.join(alone.where("n_windows > 1").select("file_name", "run"), ["file_name", "run"])
    single = alone.where("n_windows = 1").select("file_name", F.col("first_w").alias("w"), "n_windows", F.col("only").alias("content"))
    return single.unionByName(chained.groupBy("file_name", "run").applyInPandas(join, "file_name string, w long, n_windows long, content string"))


def match_files(sources: DataFrame, names: DataFrame, key: str, source: str = "source", name: str = "file_name", q: int = 8) -> DataFrame:
    """(key, name): for each source file the first name, by order, that holds the source's lowered name or is held by it.

    A text that holds another holds each of its spans of q characters. So the held side goes by one span alone, the one that
    the fewest holding texts have, and meets only the texts with that span; a hit is verified. Texts shorter than q go by
    themselves as a whole. Empty and null names match nothing.
    """
    a = sources.select(F.col(key).alias("_a"), F.lower(source).alias("t")).where("t <> ''")
    b = names.select(F.col(name).alias("_b"), F.lower(name).alias("t")).where("t <> ''").distinct()
    held = _holding(b, "_b", a, "_a", q).unionByName(_holding(a, "_a", b, "_b", q))
    return held.groupBy(F.col("_a").alias(key)).agg(F.min("_b").alias(name))


def _holding(parts: DataFrame, part: str, texts: DataFrame, text: str, q: int) -> DataFrame:
    """(part, text) of the parts (part, t) that lie in texts (text, t)."""
    short = [r.n for r in parts.select(F.length("t").alias("n")).where(F.col("n") < q).distinct().collect()]  # less than q of them
    spans = lambda c, n: F.transform(F.sequence(F.lit(1), F.length(c) - n + 1), lambda i: F.substring(c, i, F.lit(n)))
    some = [F.when(F.length("t") >= n, spans(F.col("t"), n)) for n in (*short, q)]
    every = F.array_distinct(F.flatten(F.array_compact(F.array(*some))))
    index = texts.select(text, F.col("t").alias("whole"), F.explode(every).alias("span"))
    often = index.groupBy("span").agg(F.count("*").alias("n"))
    own = F.when(F.length("t") >= q, F.array_distinct(spans(F.col("t"), q))).otherwise(F.array("t"))
    keyed = parts.select(part, "t", F.explode(own).alias("span")).join(often, "span")  # a span that no text has ends its part
    full = keyed.groupBy(part, "t").agg(F.count("*").alias("seen"), F.min_by("span", F.struct("n", "span")).alias("span"))
    rarest = full.where(F.col("seen") == F.when(F.length("t") >= q, F.size(F.array_distinct(spans(F.col("t"), q)))).otherwise(1))
    return rarest.join(index, "span").where(F.contains("whole", F.col("t"))).select(part, text)
