"""Approximate nearest neighbours by inner product: multi-index hashing over learned rotated binary codes.

Codes are the signs of rotated vectors; the rotations are learned on a bounded sample. A code is cut into substrings
and each block of the index holds a table a substring. A code within Hamming radius r of the query's agrees with it in
some substring up to r / substrings bits (pigeonhole), so that probing every table's keys up to that distance finds
every such code; the vectors found are ranked by exact inner products. The radius is set on the sample, for the share
of true neighbours to be reached. Where a block has fewer than k codes in the radius, it grows until k are found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ragset.llm.common import staged

BITS, PARTS = 128, 8


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding array<double>, without vectors that are null, zero or hold null or non-finite components.

    Of vectors of several dimensions the most frequent one takes part, the larger on ties; null vec_ids take no part.
    """
    e = F.col("embedding").cast("array<double>")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    ok = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), e.alias("embedding")).where("vec_id is not null and embedding is not null and size(embedding) > 0")
    ok = ok.where(finite & F.exists("embedding", lambda x: x != 0))
    size = ok.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return ok.where(F.size("embedding") == (size["d"] if size else 0))


def learn_rotations(sample: np.ndarray, bits: int = BITS, rounds: int = 25, seed: int = 6) -> np.ndarray:
    """Columns of rotations that bring the sample's components close to their signs, one rotation after another."""
    rng, out = np.random.default_rng(seed), []
    d = sample.shape[1]
    while sum(r.shape[1] for r in out) < bits:
        r = np.linalg.qr(rng.normal(size=(d, d)))[0]
        for _ in range(rounds):
            u, _, v = np.linalg.svd(sample.T @ np.where(sample @ r >= 0, 1.0, -1.0))
            r = u @ v
        out.append(r)
    return np.concatenate(out, axis=1)[:, :bits]


def codes_of(x: np.ndarray, rotations: np.ndarray) -> np.ndarray:
    return np.packbits(x @ rotations >= 0, axis=1)


def lifted(x: np.ndarray, longest: float) -> np.ndarray:
    """One component more, so that all are of the longest length: then angles order as inner products do."""
    return np.concatenate([x, np.sqrt(np.maximum(longest**2 - (x * x).sum(1, keepdims=True), 0))], axis=1)


def as_queries(x: np.ndarray) -> np.ndarray:
    return np.concatenate([x, np.zeros((len(x), 1))], axis=1)


def radius_for(sample: np.ndarray, longest: float, rotations: np.ndarray, k: int, reach: float) -> int:
    """The Hamming distance that holds the share reach of the sample's own true neighbours."""
    if len(sample) < 2:
        return BITS
    q = sample[:256]
    code = codes_of(lifted(sample, longest), rotations)
    qcode = codes_of(as_queries(q), rotations)
    scores = q @ sample.T
    scores[np.arange(len(q)), np.arange(len(q))] = -np.inf
    near = np.argsort(-scores, axis=1)[:, : min(k, len(sample) - 1)]
    far = np.bitwise_count(code[near] ^ qcode[:, None, :]).sum(axis=2)
    return int(np.ceil(np.quantile(far, reach)))


class Tables:
    """A block's codes and, for each substring, its keys with their postings."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.tables = []
        for sub in np.ascontiguousarray(codes).view(np.uint16).T:
            order = np.argsort(sub, kind="stable")
            keys, counts = np.unique(sub, return_counts=True)
            self.tables.append((order, keys, counts))

    def within(self, code: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, distances) of all codes up to radius from code."""
        hit = np.zeros(len(self.codes), bool)
        for (order, keys, counts), own in zip(self.tables, code.view(np.uint16)):
            hit[order[np.repeat(np.bitwise_count(keys ^ own) <= radius // PARTS, counts)]] = True
        rows = np.flatnonzero(hit)
        far = np.bitwise_count(self.codes[rows] ^ code).sum(axis=1)
        return rows[far <= radius], far[far <= radius]


def search_block(q_ids: np.ndarray, q: np.ndarray, q_codes: np.ndarray, ids: np.ndarray, x: np.ndarray, codes: np.ndarray, radius: int, k: int):
    """(query_id, vec_id, score) of each query's best k in the block, ties to the smaller vec_id."""
    tables, out = Tables(codes), []
    for qi, vec, code in zip(q_ids, q, q_codes):
        rows, _ = tables.within(code, radius)
        rows = rows[ids[rows] != qi]
        if len(rows) < k:
            far = np.bitwise_count(codes ^ code).sum(axis=1)
            other = np.flatnonzero(ids != qi)
            if len(other) > k:
                other = other[far[other] <= np.partition(far[other], k - 1)[k - 1]]
            rows = other
        score = (x[rows] * vec).sum(axis=1)
        best = np.lexsort((ids[rows], -score))[:k]
        out.append((np.full(len(best), qi), ids[rows][best], score[best]))
    return [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, sample: int = 8192, reach: float = 0.985, block_rows: int = 4096, query_rows: int = 32768) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose vec_id is divisible by every, its k nearest other rows.

    sample bounds the vectors on which rotations and radius are learned (by a hash of vec_id); every usable vector is
    indexed. Rows of one vec_id are each candidates but not their own query's. Blocks have about block_rows vectors,
    each met by blocks of about query_rows queries. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x))
    ok = usable(vectors)
    n, longest = ok.agg(F.count("*"), F.max(norm)).first()
    rows = ok.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect() if n else []
    if not rows:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    learned = np.array([r["embedding"] for r in rows])
    rotations = learn_rotations(lifted(learned, longest))
    radius = radius_for(learned, longest, rotations, k, reach)
    sent = spark.sparkContext.broadcast(rotations)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.array(batch.column("embedding").flatten()).reshape(batch.num_rows, -1)
                code, q_code = codes_of(lifted(x, longest), sent.value), codes_of(as_queries(x), sent.value)
                both = [pa.array([c.tobytes() for c in cs], pa.binary()) for cs in (code, q_code)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *both], ["vec_id", "embedding", "code", "q_code"])

    index = staged(ok.mapInArrow(encode, "vec_id long, embedding array<double>, code binary, q_code binary"), "codes")
    queries = index.where(F.pmod("vec_id", F.lit(every)) == 0).drop("code")
    n_queries = queries.count()
    blocks, q_blocks = -(-n // block_rows), max(1, -(-n_queries // query_rows))
    spread = lambda seed, m: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(m)).cast("int")
    each = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    left = queries.withColumn("qb", spread(1, q_blocks)).withColumn("b", each(blocks))
    right = index.drop("q_code").withColumn("b", spread(2, blocks)).withColumn("qb", each(q_blocks))

    def matrix(t: pa.Table, name: str) -> np.ndarray:
        return np.array(t.column(name).combine_chunks().flatten()).reshape(t.num_rows, -1)

    def code_matrix(t: pa.Table, name: str) -> np.ndarray:
        return np.frombuffer(b"".join(t.column(name).to_pylist()), np.uint8).reshape(t.num_rows, -1)

    def meet(q: pa.Table, x: pa.Table) -> pa.Table:
        if not q.num_rows or not x.num_rows:
            got = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        else:
            got = search_block(np.array(q.column("vec_id")), matrix(q, "embedding"), code_matrix(q, "q_code"), np.array(x.column("vec_id")), matrix(x, "embedding"), code_matrix(x, "code"), radius, k)
        return pa.table({"query_id": pa.array(got[0], pa.int64()), "vec_id": pa.array(got[1], pa.int64()), "score": pa.array(got[2], pa.float64())})

    found = left.groupBy("b", "qb").cogroup(right.groupBy("b", "qb")).applyInArrow(meet, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")).cast("int")
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
