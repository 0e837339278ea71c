"""Harmonic packing of documents into sequences of a fixed capacity.

A length class holds pieces of one size s, of which floor(capacity / s) fill a sequence: the reciprocal-capacity
classes. A document is cut into pieces whose sizes are classes; every worker numbers its pieces of each class by
itself, and the counts of (worker, class) alone fix every piece's sequence. Only the last, partly filled sequence of
each class is packed anew; those pieces number less than the sum of capacity / s over the classes, however large the
corpus is.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ragset.llm.common import attempt, staged, tidy
from ragset.llm.tokens import encoder, public_path, slices

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, worker int, size int, nth long"


def class_sizes(capacity: int) -> list[int]:
    """Largest first: floor(capacity / k), and below some size all sizes, of which a sequence wastes less than one piece."""
    small = max(1, int(capacity**0.5 * 1.4142))
    return sorted({capacity // k for k in range(1, capacity // small + 1)} | set(range(1, small + 1)), reverse=True)


def cut(n: int, capacity: int, sizes: list[int]) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n ids: the largest class that fits, again and again."""
    out, start, i = [(s, capacity) for s in range(0, n - capacity + 1, capacity)], n // capacity * capacity, 0
    while start < n:
        while sizes[i] > n - start:
            i += 1
        out.append((start, sizes[i]))
        start += sizes[i]
    return out


def pack_documents(docs: DataFrame, tokenizer: str | None = None, end_id: int = 1, capacity: int = 2048, keep_ids: bool = False) -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and with keep_ids the ids (little-endian uint32).

    docs needs doc_id and text; other columns are ignored. A null or empty text is the end id alone. Repeated rows,
    and rows with a null doc_id, are packed as rows of their own. An empty table gives no rows.
    """
    path, sizes = tokenizer or public_path("byte_bpe_50k.json"), class_sizes(capacity)
    end = int(end_id).to_bytes(4, "little")
    schema = PIECES + (", ids binary" if keep_ids else "")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker, count, enc = attempt()[0], dict.fromkeys(sizes, 0), encoder(path)
        for batch in batches:
            for a, b in slices(batch.num_rows, 256):
                cols: list[list] = [[] for _ in range(9)]
                part = batch.slice(a, b - a)
                for doc, ids in zip(part.column("doc_id").to_pylist(), enc.encode(part.column("text").to_pylist()), strict=True):
                    ids += end
                    n = len(ids) // 4
                    for start, length in cut(n, capacity, sizes):
                        own = ids[4 * start : 4 * (start + length)]
                        for c, v in zip(cols, (doc, start, length, zlib.crc32(own), n, worker, length, count[length], own if keep_ids else None)):
                            c.append(v)
                        count[length] += 1
                kinds = [pa.int64()] * 5 + [pa.int32(), pa.int32(), pa.int64(), pa.binary()]
                names = [f.split()[0] for f in schema.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)][: len(names)], names)

    laid = staged(docs.select("doc_id", "text").mapInArrow(tidy(pieces), schema), "pieces", "zstd")
    return assign_sequences(laid, capacity)


def assign_sequences(laid: DataFrame, capacity: int) -> DataFrame:
    """The sequence and offset of pieces that carry (worker, size, nth), nth counting from 0 in each worker and size."""
    each = laid.groupBy("worker", "size").agg(F.count("*").alias("n"))
    before = each.withColumn("before", F.sum("n").over(Window.partitionBy("size").orderBy("worker")) - F.col("n"))
    # one row a class from here: its pieces, its full sequences, the sequences of larger classes
    per = F.floor(F.lit(capacity) / F.col("size"))
    totals = each.groupBy("size").agg(F.sum("n").alias("total")).withColumn("full", F.floor(F.col("total") / per))
    full = {r["size"]: (r["full"], r["total"]) for r in totals.collect()}
    first, base = 0, {}
    for s in sorted(full, reverse=True):
        base[s], first = first, first + full[s][0]
    classes = laid.sparkSession.createDataFrame([(s, base[s], full[s][0]) for s in full] or [(0, 0, 0)], "size int, base long, full long")
    where = before.join(F.broadcast(classes), "size").select("worker", "size", "before", "base", "full")
    per_size = F.floor(F.lit(capacity) / F.col("size")).cast("long")
    placed = (
        laid.join(where, ["worker", "size"])
        .withColumn("at", F.col("before") + F.col("nth"))
        .withColumn("bin", F.floor(F.col("at") / per_size))
    )
    whole = placed.where("bin < full").withColumn("sequence_id", F.col("base") + F.col("bin")).withColumn("offset", F.col("at") % per_size * F.col("size"))
    rest = placed.where("bin >= full")  # less than capacity / size pieces a class
    ends = laid.sparkSession.createDataFrame(fill_rest({s: t - f * (capacity // s) for s, (f, t) in full.items()}, capacity, first) or [(0, -1, 0, 0)], "size int, rest_at long, sequence_id long, offset long")
    last = rest.withColumn("rest_at", F.col("at") - F.col("full") * per_size).join(F.broadcast(ends), ["size", "rest_at"])
    keep = [c for c in laid.columns if c not in ("worker", "size", "nth")]
    return whole.select(*keep, "sequence_id", "offset").unionByName(last.select(*keep, "sequence_id", "offset"))


def fill_rest(left: dict[int, int], capacity: int, first: int) -> list[tuple[int, int, int, int]]:
    """First-fit decreasing of what the classes' last sequences hold: (size, nth, sequence_id, offset)."""
    used: list[int] = []
    out, start = [], 0
    for s in sorted(left, reverse=True):
        start = 0
        for i in range(left[s]):
            while start < len(used) and used[start] + s > capacity:
                start += 1
            if start == len(used):
                used.append(0)
            out.append((s, i, first + start, used[start]))
            used[start] += s
    return out
