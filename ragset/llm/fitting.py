"""Sums over partitions and isotonic calibration, for the two classifiers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ragset.llm.common import attempt, staged

SLOTS, BINS = 64, 2048


def partition_sum(df: DataFrame, vector: Callable[[pa.RecordBatch], np.ndarray], width: int) -> np.ndarray:
    """The sum of vector(batch) over all rows: summed in each partition, then in SLOTS tasks, then here."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            if batch.num_rows:
                total += vector(batch)
        yield pa.RecordBatch.from_pydict({"slot": pa.array([attempt()[0] % SLOTS], pa.int32()), "v": pa.array([total.tobytes()], pa.binary())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            for v in batch.column("v").to_pylist():
                total += np.frombuffer(v)
        yield pa.RecordBatch.from_pydict({"v": pa.array([total.tobytes()], pa.binary())})

    parts = df.mapInArrow(own, "slot int, v binary").repartition(SLOTS, "slot").mapInArrow(add, "v binary").collect()
    return np.sum([np.frombuffer(r["v"]) for r in parts], axis=0) if parts else np.zeros(width)


def isotonic(scored: DataFrame, low: float, high: float) -> tuple[list[float], list[float]]:
    """Pool-adjacent-violators over (raw, label, weight) rows, added up in BINS bins of raw: knots x and rising y for np.interp."""
    at = F.floor((F.least(F.greatest(F.col("raw"), F.lit(low)), F.lit(high)) - low) / (high - low) * (BINS - 1)).cast("int")
    rows = scored.groupBy(at.alias("bin")).agg(F.sum(F.col("label") * F.col("weight")).alias("pos"), F.sum("weight").alias("n")).orderBy("bin").collect()
    blocks: list[list[float]] = []  # positives, rows, first bin, last bin
    for r in rows:
        blocks.append([r["pos"], r["n"], r["bin"], r["bin"]])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            p, n, _, last = blocks.pop()
            blocks[-1] = [blocks[-1][0] + p, blocks[-1][1] + n, blocks[-1][2], last]
    step = (high - low) / (BINS - 1)
    x, y = [], []
    for p, n, first, last in blocks:
        for b in {first, last + 1} if first != last else {first}:
            x.append(low + b * step)
            y.append(p / n)
    order = np.argsort(x, kind="stable")
    return [x[i] for i in order], [y[i] for i in order]


def calibrated(raw: np.ndarray, knots: tuple[list[float], list[float]], default: float) -> np.ndarray:
    """The interpolated share of label 1 at raw; default where nothing was learned."""
    return np.interp(raw, *knots) if knots[0] else np.full(len(raw), default)


def labelled_sample(labels: DataFrame, label: str, learn, most: dict[int, int]) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, label, weight, order) of labelled rows of the learning fold, and the fold's rows a label.

    Of each label about most[label] rows are taken, all if there are fewer: those whose hash of doc_id is low. weight is
    the number of rows that one stands for; order numbers a label's rows, roughly, by their hash. The rows are as many
    at any size of the labels; labels that are null or neither 0 nor 1, and null doc_ids, are left out.
    """
    known = labels.where(learn).select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).where("label in (0, 1) and doc_id is not null")
    n = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    part = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / (1 << 30)
    pick = lambda f: F.coalesce(*(F.when(F.col("label") == k, F.lit(float(f(k)))) for k in most))
    rate = pick(lambda k: min(1.0, most[k] / max(1, n.get(k, 0))))
    taken = known.where(part < rate).select("doc_id", "label", (1 / rate).alias("weight"), (part * pick(lambda k: n.get(k, 0))).alias("order"))
    return staged(taken, "labels"), n
