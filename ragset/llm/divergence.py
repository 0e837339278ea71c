"""Source divergence audit: how far the sources of a language stand from each other, term by term, in exact integers.

Counts go through Spark: each task adds up the terms of its texts by group (language and source), and shuffles bring the
sums together. What is kept, terms that enough documents of a language hold, is cut into blocks of terms and blocks of
groups. A tile holds one block of terms against one or two blocks of groups as dense int64 matrices, of a size that
does not depend on the data; broadcasting one block of groups against the other gives the tile's part of all pair
distances and each group's heap of outstanding terms. Partial pair distances are summed, heaps are merged by rank.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ragset.llm.common import staged

#: Terms and groups of a tile at most, about; groups that meet a tile at once; entries that a task's counters hold before they are sent on.
TERMS, GROUPS, AT_ONCE, HELD = 2048, 128, 4, 400_000
#: Parts of SCALE, of which neither overflows int64 with counts below 2^47.
SCALE = (31_250, 32_000)
#: A-Z in lower case; what is neither a letter of ASCII nor above it becomes a space.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """The terms `[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+` of a text, A-Z in lower case, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_LETTERS).split()


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents with it). Each occurring group also has a row of the term ''."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        held = 0

        def sent() -> Iterator[pa.RecordBatch]:
            for (lang, source), (times, within) in n.items():
                terms = [b"", *times]
                cols = [pa.array([t.decode("utf-8", "replace") for t in terms]), pa.array([0, *times.values()], pa.int64()), pa.array([within[t] for t in terms], pa.int64())]
                whole = pa.RecordBatch.from_arrays([pa.array([lang] * len(terms)), pa.array([source] * len(terms)), *cols], ["lang", "source", "term", "n", "docs"])
                for a in range(0, len(terms), 50_000):
                    yield whole.slice(a, 50_000)
            n.clear()

        for batch in batches:
            for lang, source, text in zip(batch.column("lang"), batch.column("source"), batch.column("text"), strict=True):
                key = (lang.as_py() or "", source.as_py() or "")
                times, within = n.setdefault(key, (Counter(), Counter()))
                held -= len(times)
                words = terms_of(text.as_py())
                times.update(words)
                within.update(set(words))
                held += len(times)
                if held > HELD:
                    yield from sent()
                    held = 0
        yield from sent()

    rows = docs.select("lang", "source", "text").mapInArrow(count, "lang string, source string, term string, n long, docs long")
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """1 + floor(10^9 * count / whole), exact below 2^47."""
    q, r = np.divmod(count * SCALE[0], whole)
    return 1 + q * SCALE[1] + r * SCALE[1] // whole


def tile(groups: list[int], cells: list[tuple[int, int, int]], terms: list[bytes], sums: list[int], whole: list[int], lang_whole: int, smooth: int, split: int | None, most: int):
    """(pairs, tops) of a tile. cells: (row of groups, column of terms, count); sums: the language's counts; split: the row where
    the second block of groups begins, None where the tile has one block, which is then met with itself and yields heaps as well.
    pairs: (group, group, distance) both ways; tops: (group, term, excess), most a group, ties to the smaller term."""
    count = np.zeros((len(groups), len(terms)), np.int64)
    for g, t, c in cells:
        count[g, t] = c
    p = share(count + smooth, np.array(whole, np.int64)[:, None])
    pairs = []
    left, right = (p, p) if split is None else (p[:split], p[split:])
    names = groups if split is None else groups[split:]
    for i in range(0, len(left), AT_ONCE):
        far = np.abs(left[i : i + AT_ONCE, None, :] - right[None]).sum(axis=2).tolist()
        for one, row in zip(groups[i:], far):
            for other, d in zip(names, row):
                if other != one:
                    pairs += [(one, other, d)] if split is None else [(one, other, d), (other, one, d)]
    tops = []
    if split is None and len(terms):
        q = share(np.array(sums, np.int64) + smooth, np.int64(lang_whole))
        more = np.where(count > 0, p - q, 0)
        for g, row in zip(groups, more):
            at = np.flatnonzero(row > 0)
            tops += [(g, t, -v) for v, t in heapq.nsmallest(most, zip((-row[at]).tolist(), (terms[i] for i in at)))]
    return pairs, tops


def source_divergence(docs: DataFrame, least_docs: int = 30, smooth: int = 5, most: int = 50) -> DataFrame:
    """lang, source, part, item, value, rank: part `pair`, the distance to each other source of the language, all ranks;
    part `term`, the kept terms that a source uses more than its language does, ranks up to most.

    docs needs text, lang and source; a null one reads as ''; other columns are ignored. A language keeps the terms of
    at least least_docs of its documents. Repeated rows count again. A group without terms stands in all pairs. Ties go
    to the smaller item in UTF-8. A source alone in its language has no pairs; an empty table gives no rows.
    """
    of_term, of_lang, of_group = Window.partitionBy("lang", "term"), Window.partitionBy("lang"), Window.partitionBy("lang", "source")
    counts = term_counts(docs).withColumns({"in_docs": F.sum("docs").over(of_term), "lang_n": F.sum("n").over(of_term)})
    counts = staged(counts.where((F.col("in_docs") >= least_docs) | (F.col("term") == "")).select("lang", "source", "term", "n", "lang_n"), "terms")
    kept = counts.where("term <> ''")
    # one row a group and one a language from here; groups without kept terms stay
    per_lang = kept.groupBy("lang", "term").agg(F.first("lang_n").alias("n")).groupBy("lang").agg(F.count("*").alias("v"), F.sum("n").alias("lang_sum"))
    groups = counts.groupBy("lang", "source").agg(F.sum("n").alias("group_sum")).join(per_lang, "lang", "left").na.fill(0, ["v", "lang_sum"])
    groups = groups.withColumn("nth", F.row_number().over(of_lang.orderBy("source")).cast("int") - 1)
    groups = groups.withColumn("many", F.count("*").over(of_lang))
    groups = staged(groups, "groups")
    blocks = F.greatest(F.lit(1), F.ceil(F.col("v") / TERMS)).cast("int")
    block_pairs = F.transform(F.sequence(F.lit(0), F.floor((F.col("many") - 1) / GROUPS).cast("int")), lambda x: F.struct(F.least(x, F.floor(F.col("nth") / GROUPS).cast("int")).alias("a"), F.greatest(x, F.floor(F.col("nth") / GROUPS).cast("int")).alias("b")))
    whole = F.struct((F.col("group_sum") + smooth * F.col("v")).alias("group"), (F.col("lang_sum") + smooth * F.col("v")).alias("lang"))
    held = groups.select("lang", "source", "nth", blocks.alias("blocks"), block_pairs.alias("met"), whole.alias("whole"))
    every = held.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("lang", "block", "met", "nth", F.lit("").alias("term"), F.lit(0).cast("long").alias("n"), F.col("whole.group").alias("x"), F.col("whole.lang").alias("y"))
    cells = kept.join(held, ["lang", "source"]).select("lang", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block"), "met", "nth", "term", "n", F.col("lang_n").alias("x"), F.lit(0).cast("long").alias("y"))
    tiles = every.unionByName(cells).withColumn("met", F.explode("met")).select("lang", "block", "met.a", "met.b", "nth", "term", "n", "x", "y")

    def work(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        a, b = key[2].as_py(), key[3].as_py()
        cols = [rows.column(c).to_pylist() for c in ("nth", "term", "n", "x", "y")]
        heads = sorted((g, x, y) for g, t, _, x, y in zip(*cols) if t == "")
        own = [g for g, _, _ in heads]
        row = {g: i for i, g in enumerate(own)}
        sums = {t.encode(): x for t, x in zip(cols[1], cols[3]) if t}
        terms = sorted(sums)
        col = {t: i for i, t in enumerate(terms)}
        found = [(row[g], col[t.encode()], n) for g, t, n in zip(*cols[:3]) if t]
        split = None if a == b else next(i for i, g in enumerate(own) if g // GROUPS == b)
        # without kept terms (v = 0) a whole may be 0; nothing is divided by it then
        pairs, tops = tile(own, found, terms, [sums[t] for t in terms], [max(1, x) for _, x, _ in heads], max(1, heads[0][2]), smooth, split, most)
        lang = [key[0].as_py()] * (len(pairs) + len(tops))
        left = [i for i, _, _ in pairs] + [g for g, _, _ in tops]
        right = pa.array([j for _, j, _ in pairs] + [None] * len(tops), pa.int32())
        item = pa.array([None] * len(pairs) + [t.decode() for _, t, _ in tops], pa.string())
        value = pa.array([int(d) for _, _, d in pairs] + [int(v) for _, _, v in tops], pa.int64())
        return pa.table([pa.array(lang, pa.string()), pa.array(left, pa.int32()), right, item, value], ["lang", "nth", "other", "item", "value"])

    made = staged(tiles.groupBy("lang", "block", "a", "b").applyInArrow(work, "lang string, nth int, other int, item string, value long"), "tiles")
    named = groups.select("lang", "nth", "source")
    others = groups.select("lang", F.col("nth").alias("other"), F.col("source").alias("item"))
    pairs = made.where("other is not null").groupBy("lang", "nth", "other").agg(F.sum("value").alias("value")).join(others, ["lang", "other"]).join(named, ["lang", "nth"]).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    tops = made.where("other is null").join(named, ["lang", "nth"]).select("lang", "source", F.lit("term").alias("part"), "item", "value")
    order = [F.col("value").desc(), "item"]
    return pairs.withColumn("rank", F.row_number().over(of_group.orderBy(*order))).unionByName(tops.withColumn("rank", F.row_number().over(of_group.orderBy(*order))).where(F.col("rank") <= most))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    unnest(list_concat([''], regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+'))) AS term FROM documents),
c AS (SELECT lang, source, term, count(*) AS n FROM d GROUP BY ALL),
kept AS (SELECT lang, term FROM d WHERE term <> '' GROUP BY ALL HAVING count(DISTINCT id) >= 30),
g AS (SELECT DISTINCT lang, source FROM d),
cell AS (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n FROM g JOIN kept USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
p AS (SELECT *, 1 + CAST(1000000000 * CAST(n + 5 AS HUGEINT) // (sum(n) OVER (PARTITION BY lang, source) + 5 * count(*) OVER (PARTITION BY lang, source)) AS BIGINT) AS p FROM cell),
l AS (SELECT lang, term, sum(n) AS n FROM cell GROUP BY ALL),
q AS (SELECT lang, term, 1 + CAST(1000000000 * CAST(n + 5 AS HUGEINT) // (sum(n) OVER (PARTITION BY lang) + 5 * count(*) OVER (PARTITION BY lang)) AS BIGINT) AS q FROM l),
far AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(far.value, 0) AS BIGINT) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN far ON far.lang = a.lang AND far.source = a.source AND far.item = b.source),
tops AS (SELECT p.lang, p.source, 'term' AS part, p.term AS item, p.p - q.q AS value FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE p.n > 0 AND p.p > q.q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM tops))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""
