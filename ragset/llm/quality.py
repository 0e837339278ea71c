"""Quality: random Fourier features of document statistics, ridge regression, isotonic calibration."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ragset.llm.common import fold, staged, tidy
from ragset.llm.fitting import calibrated, isotonic, labelled_sample, partition_sum

STATS = 24
_SETS = [
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t\r\x0b\x0c", b"\n", b"!", b"?", b"|", b".,;:", b"#$%&*@^~+=",
    b"<>{}[]()\\/", b"\"'`-_", bytes(range(128, 256)),
]
_KINDS = np.zeros((256, len(_SETS)))
for _i, _s in enumerate(_SETS):
    _KINDS[list(_s), _i] = 1
_END = re.compile(rb"[^\w\x80-\xff.,;:!?]\s|!\s")


def statistics(text: bytes) -> np.ndarray:
    """The numbers of a text that the classifier sees; all of it is read. An empty text has zeros."""
    out = np.zeros(STATS)
    n = len(text)
    if not n:
        return out
    hist = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    out[:13] = hist @ _KINDS / n
    words = text.split()
    w = max(1, len(words))
    p = hist[hist > 0] / n
    counts = Counter(words)
    lines = text.split(b"\n")
    out[13] = np.log1p(n) / 10
    out[14] = np.log1p(len(words)) / 8
    out[15] = (n - hist[list(b" \n\t\r\x0b\x0c")].sum()) / w / 10
    out[16] = -(p * np.log2(p)).sum() / 8
    out[17] = len(counts) / w
    out[18] = max(counts.values(), default=0) / w
    out[19] = sum(map(bytes.__eq__, words[1:], words)) / w
    out[20] = len(_END.findall(text)) / w
    out[21] = len(set(lines)) / len(lines)
    out[22] = np.log1p(n / len(lines)) / 10
    out[23] = sum(map(bytes.isupper, counts)) / max(1, len(counts))
    return out


def _statistics(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [statistics(t.as_py() or b"") for t in batch.column("text")]


def with_statistics(docs: DataFrame) -> DataFrame:
    """docs, which has a text, with its statistics, stats array<double>, in place of the text; a null text counts as empty."""
    others = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), pa.array(_statistics(batch), pa.list_(pa.float64()))], [*others, "stats"])

    return docs.withColumn("text", F.col("text").cast("binary")).mapInArrow(tidy(run), ", ".join(f"{n} {t}" for n, t in docs.dtypes if n != "text") + ", stats array<double>").select(*others, "stats")


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.array(batch.column("stats").flatten()).reshape(-1, STATS)


def score_quality(docs: DataFrame, labels: DataFrame, learn, features: int = 192, width: float = 4.0, ridge: float = 1e-3, seed: int = 8, default: float = 1.0, sample: int = 50_000, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns keep and score in 0..1 of every row of docs, learned from the labelled rows for which the column learn holds.

    The labelled rows to learn from are bounded: about sample a label, picked by a hash of their doc_id and weighted by
    the rows that they stand for; fewer count all, repeated rows each. A row without text is scored as empty. Where the
    fold has no label the score is default. Other columns play no part. An empty table gives no rows.
    """
    known, _ = labelled_sample(labels, "quality", learn, {0: sample, 1: sample})
    sampled = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(known), "doc_id").select("label", "weight", "text")
    train = staged(with_statistics(sampled), "train")
    weight = lambda b: np.array(b.column("weight"))
    moments = partition_sum(train, lambda b: np.concatenate([[weight(b).sum()], weight(b) @ (m := _matrix(b)), weight(b) @ (m * m)]), 1 + 2 * STATS)
    n = max(1.0, moments[0])
    mean = moments[1 : 1 + STATS] / n
    scale = np.sqrt(np.maximum(moments[1 + STATS :] / n - mean**2, 1e-8)) + 1e-3
    rng = np.random.default_rng(seed)
    w, shift = rng.normal(size=(STATS, features)) / width, rng.uniform(0, 2 * np.pi, features)

    def phi(stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - mean) / scale, -6, 6)
        return np.concatenate([np.sqrt(2 / features) * np.cos(z @ w + shift), np.ones((len(z), 1))], axis=1)

    size = features + 1

    def normal(batch: pa.RecordBatch) -> np.ndarray:
        f, y = phi(_matrix(batch)), np.array(batch.column("label"), float)
        return np.concatenate([((f * weight(batch)[:, None]).T @ f).ravel(), f.T @ (weight(batch) * y)])

    sums = partition_sum(train, normal, size * size + size)
    gram, rhs = sums[: size * size].reshape(size, size), sums[size * size :]
    penalty = np.eye(size) * (ridge * n + 1e-6)
    penalty[-1, -1] = 1e-6
    beta = np.linalg.solve(gram + penalty, rhs)

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("weight"), pa.array(phi(_matrix(batch)) @ beta)], ["label", "weight", "raw"])

    knots = isotonic(train.mapInArrow(raw, "label int, weight double, raw double"), -0.5, 1.5) if moments[0] else ([], [])

    # statistics and score in one worker: two Python workers a task would hold twice the memory, and keep it for later stages
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            others = [c for c in batch.schema.names if c != "text" or "text" in keep]
            score = calibrated(phi(np.array(_statistics(batch)).reshape(-1, STATS)) @ beta, knots, default)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), pa.array(score)], [*others, "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *(F.col(c).alias(f"kept_{c}") for c in keep if c != "text"), F.col("text").cast("binary").alias("text"))
    schema = ", ".join(f"{n} {t}" for n, t in rows.dtypes if n != "text" or "text" in keep) + ", score double"
    return rows.mapInArrow(tidy(run), schema).select("doc_id", *(F.col("text").cast("string") if c == "text" else F.col(f"kept_{c}").alias(c) for c in keep), "score")


def quality_query(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    learn = fold("doc_id", 4) != 2
    out = score_quality(docs, labels, learn, keep=keep)
    return out.select("doc_id", *keep, (~learn).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
