"""Periodic runs of words: a suffix automaton with merged, ordered sets of end positions.

A run is a stretch of words with smallest period q that is long enough and that no neighbouring word extends. In a
suffix automaton the states are the classes of substrings with equal end positions; along the suffix links the sets of
end positions merge, the smaller into the larger. Two end positions become neighbours for the first time at the state
of their longest common suffix: a distance d not exceeding that state's length is a square, or a higher power if d fits
into the length more often, with period d. It begins where the longest common suffix begins, so that only its end has
to be sought. Each run is seeded at the neighbours with its last word and the word q before.

A word can lie in a run only among words whose four-word shingles occur twice or more in the text. Only those stretches
go into automata; whether a word takes part is exact, since hashes that collide only add words.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ragset.llm.common import WORD
from ragset.llm.tokens import slices

#: Words of a shingle that a run holds twice: the shortest run, of 6 words, has 3 of its shingles.
SHINGLE, ROWS = 4, 64
RUNS = "array<struct<start: long, length: long, period: long>>"


def automaton(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """(length, link, end) of the states; end is the state's own end position, -1 for the root and for split states."""
    length, link, end, follow = [0], [-1], [-1], [{}]
    last = 0
    for i, w in enumerate(words):
        new = len(length)
        length.append(i + 1)
        end.append(i)
        follow.append({})
        p = last
        while p >= 0 and w not in follow[p]:
            follow[p][w] = new
            p = link[p]
        if p < 0:
            link.append(0)
        else:
            q = follow[p][w]
            if length[p] + 1 == length[q]:
                link.append(q)
            else:
                half = len(length)
                link.append(half)
                length.append(length[p] + 1)
                link.append(link[q])
                end.append(-1)
                follow.append(follow[q].copy())
                while p >= 0 and follow[p].get(w) == q:
                    follow[p][w] = half
                    p = link[p]
                link[q] = half
        last = new
    return length, link, end


def runs_of(words: list[int], least: int, power: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of at least least words and power periods (2 or more), by start, then period."""
    length, link, end = automaton(words)
    sets: list[list[int] | None] = [[e] if e >= 0 else None for e in end]
    more: list[list[list[int]] | None] = [None] * len(length)
    found: dict[tuple[int, int], int] = {}
    for v in sorted(range(1, len(length)), key=length.__getitem__, reverse=True):
        own = sets[v]
        if more[v]:
            parts = more[v] if own is None else [*more[v], own]
            large = max(parts, key=len)
            added = [e for x in parts if x is not large for e in x]
            for e in added:
                insort(large, e)
            n = length[v]
            for e in added:
                at = bisect_left(large, e)
                for a, b in ((at - 1, at), (at, at + 1)):
                    if 0 <= a and b < len(large) and (large[b] - large[a]) * (power - 1) <= n:
                        start, q = large[a] - n + 1, large[b] - large[a]
                        if start == 0 or words[start - 1] != words[start + q - 1]:  # else they were neighbours before, at a longer state
                            found.setdefault((start, q), large[b])
            own = large
            more[v] = None
        up = link[v]
        sets[v] = None
        if up > 0:
            if more[up] is None:
                more[up] = []
            more[up].append(own)
    out = []
    for (start, q), stop in found.items():
        stop += 1
        while stop < len(words) and words[stop] == words[stop - q]:
            stop += 1
        if stop - start >= max(least, power * q):
            out.append((start, stop - start, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def stretches(hashes: np.ndarray) -> list[tuple[int, int]]:
    """(from, to) of the stretches of words of which every shingle occurs twice or more."""
    if len(hashes) < SHINGLE + 1:
        return []
    h = hashes[: len(hashes) - SHINGLE + 1].copy()
    for k in range(1, SHINGLE):
        h = h * np.uint64(0x9E3779B97F4A7C15) + hashes[k : len(hashes) - SHINGLE + 1 + k]
        h ^= h >> np.uint64(29)
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    often = np.zeros(len(h) + 2, bool)
    often[order[1:][same] + 1] = often[order[:-1][same] + 1] = True
    begin, stop = np.flatnonzero(often[1:] & ~often[:-1]), np.flatnonzero(often[:-1] & ~often[1:])
    return list(zip(begin.tolist(), (stop + SHINGLE - 1).tolist()))


def text_runs(words: list[bytes], least: int = 6, power: int = 4) -> list[tuple[int, int, int]]:
    """The runs of a text of words. The pruning holds for runs of 6 words and 4 periods or more; others search whole texts."""
    spans = [(0, len(words))]
    if least >= 6 and power >= 4:
        ids: dict[bytes, int] = {}
        spans = stretches(_spread(np.array([ids.setdefault(w, len(ids)) for w in words], np.uint64))) if len(words) >= least else []
    out = []
    for a, b in spans:
        if b - a >= least:
            ids = {}
            out += [(a + s, n, q) for s, n, q in runs_of([ids.setdefault(w, len(ids)) for w in words[a:b]], least, power)]
    return out


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words, joined by one space, without those that a run holds after its first period."""
    if not runs:
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    for start, n, q in runs:
        edge[start + q] += 1
        edge[start + n] -= 1
    gone = np.cumsum(edge[:-1]) > 0
    return b" ".join(w for w, g in zip(words, gone.tolist()) if not g)


def periodic_runs(docs: DataFrame, least: int = 6, power: int = 4, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns keep, runs (start, length and period by start, then period) and collapsed, the text without the repeats.

    docs needs doc_id and text; a null text is empty and has no runs. Every row is judged by itself, repeated rows and
    rows without a doc_id as well. Words end at ASCII white space. Memory follows the longest text; an empty table gives
    no rows.
    """
    kept = [docs.schema[c] for c in keep]
    schema = "doc_id long" + "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in kept) + f", runs {RUNS}, collapsed string"
    run = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.num_rows, ROWS):
                part = batch.slice(a, b - a)
                found, rest = [], []
                for text in part.column("text"):
                    words = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
                    runs = text_runs(words, least, power)
                    found.append([dict(zip(("start", "length", "period"), r)) for r in runs])
                    rest.append(collapsed(words, runs).decode("utf-8", "replace"))
                cols = [part.column(c) for c in ("doc_id", *keep)] + [pa.array(found, run), pa.array(rest, pa.string())]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", *keep, "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *keep).mapInArrow(work, schema)


def planted(docs: DataFrame) -> DataFrame:
    """docs with the texts of a tenth of the documents made periodic from some word on; a null doc_id counts as ''."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"({WORD})"), F.lit(1))

    def repeated(w: Column) -> Column:
        n, g = F.size(w), F.floor(h / 10)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        return F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(w, F.when(i < a, i).otherwise(a + (i - a) % p))), " ")

    # the words are bound once, by the outer transform
    again = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, repeated(w)).otherwise(F.lit("")))[0]
    return docs.select("doc_id", F.when(h % 10 == 0, again).otherwise(F.col("text")).alias("text"))


def run_digests(docs: DataFrame) -> DataFrame:
    """The query's columns, from the runs of planted texts."""
    found = periodic_runs(planted(docs))
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("shorter"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    out = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
    n = -F.col("best.shorter")
    return out.select("doc_id", "n_runs", F.col("best.start").alias("start"), n.alias("length"), F.col("best.period").alias("period"), F.expr("-1000 * best.shorter div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


_CRC = "xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), ''), ''), lambda c: ascii(c)::BIGINT)), lambda crc, c: " + "list_reduce(list_concat([xor(crc, c)], range(8)), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))" + "), 4294967295::BIGINT)"
SQL = rf"""
WITH h AS (SELECT row_number() OVER () AS id, doc_id, CASE WHEN doc_id IS NULL THEN 0 ELSE {_CRC} END AS h, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
a AS (SELECT *, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM h),
p AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM a),
words AS (SELECT id, n, i, w[1 + CASE WHEN a IS NULL OR i < a THEN i ELSE a + (i - a) % p END] AS word FROM (SELECT *, unnest(range(n)) AS i FROM p)),
same AS (SELECT x.id, x.i, y.i - x.i AS q, x.i - row_number() OVER (PARTITION BY x.id, y.i - x.i ORDER BY x.i) AS island FROM words x JOIN words y ON x.id = y.id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
every AS (SELECT id, q, min(i) AS start, count(*) + q AS length FROM same GROUP BY id, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT id, start, length, min(q) AS period FROM every GROUP BY ALL),
per AS (SELECT id, count(*) AS n_runs, min({{'a': -length, 'b': start, 'c': period}}) AS best, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM runs GROUP BY id),
gone AS (SELECT DISTINCT id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT words.id, string_agg(word, ' ' ORDER BY words.i) AS collapsed FROM words ANTI JOIN gone ON words.id = gone.id AND words.i = gone.i GROUP BY words.id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.b AS start, -best.a AS length, best.c AS period, -1000 * best.a // best.c AS exponent_milli,
    sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM h LEFT JOIN per USING (id) LEFT JOIN kept USING (id)
"""
