"""Toxicity: a support vector machine over a subsequence string kernel of sentences, with Nyström landmarks.

Two words are compared by their common subsequences of three letters (word ends count as letters), each occurrence
weighted by DECAY to the number of letters that it skips, SPAN letters at most; the scaled kernel is raised to POWER.
So an insult with letters left out, doubled or put in between stays close to itself, and chance likenesses vanish. Two
sentences are compared by the sum over their pairs of words. Landmarks are one-word sentences of the training texts;
a sentence's Nyström features are its kernels with the landmarks. Training sentences carry their document's label:
of a toxic document, at first all its sentences weigh on the machine together, then those that the machine finds toxic
(one at least), as in multiple-instance learning. A document scores as its worst sentence; calibration by an isotonic
fit turns that into a share.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ragset.llm.common import fold, staged, tidy
from ragset.llm.fitting import calibrated, isotonic, labelled_sample
from ragset.llm.tokens import slices

SPAN, DECAY, POWER, SYMBOLS = 5, 0.5, 3, 64
#: Words of a sentence at most; longer ones are cut. Words whose values a worker remembers. Rows handled together.
LONGEST_SENTENCE, MAX_WORDS, ROWS = 32, 250_000, 256
#: Values of the kernel with a landmark below NEGLIGIBLE count as none, and when scoring so do words worth less than LEAST
#: or, where no word is worth much, a tenth of the most that a landmark is worth.
NEGLIGIBLE, LEAST = 0.01, 0.3
#: Texts whose words would stay below this decision even all in one sentence count by their worst word.
FLOOR = -1.0
#: Sentences of a clean document that are taken as mistakes at most.
WORST = 4
_GAPS = [(a, b, DECAY ** (b - 2)) for b in range(2, SPAN) for a in range(1, b)]
#: Digits and signs that stand for letters; other signs are dropped.
_ALIKE, _SIGNS = bytes.maketrans(b"013457@$", b"oieastas"), bytes(b for b in range(33, 127) if not chr(b).isalnum() and b not in b"@$")
_DROP, _ENDS = re.compile(r"[\W_]+"), re.compile(r"[.!?]\s|\n")
LONGEST_WORD = 48


def tokens_of(text: str) -> list[str]:
    """Lower-case words, look-alikes read as letters, ASCII signs dropped."""
    return text.lower().encode().translate(_ALIKE, _SIGNS).decode().split()


def joined_letters(tokens: list[str]) -> list[str]:
    """Runs of three or more single letters, joined."""
    out: list[str] = []
    if b"\1\1\1" in bytes(map((255).__and__, map(len, tokens))):
        run = ""
        for t in [*tokens, ""]:
            if len(t) == 1:
                run += t
            else:
                if len(run) > 2:
                    out.append(run)
                run = ""
    return out


def units(token: str) -> list[str]:
    """The letters of a token; overlapping windows of an overlong one."""
    w = token if token.isalnum() else _DROP.sub("", token)
    if len(w) <= LONGEST_WORD:
        return [w] if w else []
    return sorted({w[i : i + LONGEST_WORD] for i in range(0, len(w), LONGEST_WORD // 2)})


def sentences(text: str | None) -> Iterator[set[str]]:
    """The distinct tokens of each sentence, letters that stand alone in a run joined as well."""
    for part in _ENDS.split(text or ""):
        tokens = tokens_of(part)
        for at in range(0, len(tokens), LONGEST_SENTENCE):
            own = tokens[at : at + LONGEST_SENTENCE]
            yield {*own, *joined_letters(own)}


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All words' symbols in a row, each word with its end marks; where each begins."""
    joined = "\x00".join(words)
    cp = np.frombuffer(("\x00" + joined + "\x00").encode("utf-32-le"), np.uint32)
    code = np.where((cp >= 97) & (cp <= 122), cp - 95, np.where(cp == 0, 1, 28 + cp % 36)).astype(np.int64)
    ends = np.flatnonzero(cp == 0)
    # a word's closing mark doubles as the next one's opening mark; spread them out
    length = np.diff(ends) + 1
    start = np.concatenate([[0], np.cumsum(length)[:-1]])
    index = np.arange(length.sum()) - np.repeat(start, length) + np.repeat(ends[:-1], length)
    return code[index], start


def occurrences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word number, triple, weight) of every occurrence of a subsequence."""
    code, start = _letters(words)
    length = np.diff(np.append(start, len(code)))
    word = np.repeat(np.arange(len(words)), length)
    rows, keys, vals = [], [], []
    for a, b, weight in _GAPS:
        if len(code) <= b:
            continue
        at = np.flatnonzero(word[:-b] == word[b:])
        rows.append(word[at])
        keys.append((code[at] * SYMBOLS + code[at + a]) * SYMBOLS + code[at + b])
        vals.append(np.full(len(at), weight))
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (rows, keys, vals))


def triples(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word number, triple, weight), the occurrences summed a triple; a word's weights have the norm one."""
    row, key, val = occurrences(words)
    both, at = np.unique(row * SYMBOLS**3 + key, return_inverse=True)
    val = np.bincount(at, val, len(both))
    row, key = both // SYMBOLS**3, both % SYMBOLS**3
    norm = np.sqrt(np.bincount(row, np.square(val), len(words)))
    return row, key, val / np.maximum(norm, 1e-9)[row]


class Landmarks:
    """The triples of some words, by triple: which words hold it and with what weight."""

    def __init__(self, words: list[str]):
        self.words = words
        row, key, val = triples(words)
        order = np.argsort(key, kind="stable")
        self.row, self.val = row[order], val[order]
        self.first = np.searchsorted(key[order], np.arange(SYMBOLS**3 + 1)).astype(np.int32)

    def kernel(self, words: list[str]) -> np.ndarray:
        """The kernel of each word with each landmark."""
        out = np.zeros((len(words), len(self.words)), np.float32)
        for a, b in slices(len(words), 1000):
            row, key, val = triples(words[a:b])
            count = self.first[key + 1] - self.first[key]
            at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - self.first[key], count)
            cell = np.repeat(row, count) * len(self.words) + self.row[at]
            same = np.bincount(cell, np.repeat(val, count) * self.val[at], (b - a) * len(self.words)).reshape(b - a, -1)
            np.power(same, POWER, out=same)
            same[same < NEGLIGIBLE] = 0
            out[a:b] = same
        return out

    def tokens(self, tokens: list[str]) -> np.ndarray:
        """The kernel of each token with each landmark, the sum of its units'."""
        parts = [units(t) for t in tokens]
        known = sorted(set().union(*parts))
        of = {w: i for i, w in enumerate(known)}
        rows = self.kernel(known)
        out = np.zeros((len(tokens), len(self.words)), np.float32)
        for i, p in enumerate(parts):
            for w in p:
                out[i] += rows[of[w]]
        return out


class Machine:
    """Landmarks with weights and a bias. Words are worth sum(weight * kernel)."""

    def __init__(self, marks: Landmarks, weight: np.ndarray, bias: float):
        self.marks, self.weight, self.bias = marks, weight.astype(np.float32), float(bias)
        self.least = min(LEAST, 0.1 * max(1e-6, float((marks.kernel(marks.words) @ self.weight).max(initial=0.0))))
        # no word is worth more than most^2 * slope, summed over its triples: a kernel with a landmark is at most `most`
        good = self.weight[marks.row] > 0
        key = np.repeat(np.arange(SYMBOLS**3), np.diff(marks.first))[good]
        self.most, self.slope = np.zeros(SYMBOLS**3, np.float32), np.zeros(SYMBOLS**3, np.float32)
        np.maximum.at(self.most, key, marks.val[good])
        np.add.at(self.slope, key, marks.val[good] * self.weight[marks.row][good])

    def worth(self, words: list[str]) -> dict[str, float]:
        """The words worth self.least or more."""
        out = {}
        for a, b in slices(len(words), 1000):
            part = words[a:b]
            row, key, val = occurrences(part)
            norm = np.maximum(1e-9, np.sqrt(np.bincount(row, np.square(val), len(part))))
            bound = np.minimum(1, np.bincount(row, val * self.most[key], len(part)) / norm) ** (POWER - 1) * np.bincount(row, val * self.slope[key], len(part)) / norm
            near = [part[i] for i in np.flatnonzero(bound >= self.least * 0.999)]
            if near:
                out.update((w, v) for w, v in zip(near, (self.marks.kernel(near) @ self.weight).tolist()) if v >= self.least)
        return out


def word_counts(train: DataFrame) -> DataFrame:
    """(word, toxic, clean): the numbers of training documents of each label that hold the word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())

        def flush():
            words = list(seen[0].keys() | seen[1].keys())
            out = pa.RecordBatch.from_pydict({"word": pa.array(words, pa.string()), "toxic": pa.array([seen[1][w] for w in words], pa.int64()), "clean": pa.array([seen[0][w] for w in words], pa.int64())})
            seen[0].clear()
            seen[1].clear()
            return out

        for batch in batches:
            for text, label in zip(batch.column("text"), batch.column("label").to_pylist()):
                tokens = tokens_of(text.as_py() or "")
                seen[label].update({w for t in {*tokens, *joined_letters(tokens)} for w in units(t)})
                if len(seen[0]) + len(seen[1]) > MAX_WORDS:
                    yield flush()
        yield flush()

    return train.mapInArrow(count, "word string, toxic long, clean long").groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def spread(pool: Iterable[str], chosen: list[str], most: int, near: float) -> list[str]:
    """chosen with the first words of pool that are not near one that is there already, up to most in all."""
    fresh = [w for w in pool if w not in set(chosen)]
    words = [*chosen, *fresh]
    gram = Landmarks(words).kernel(words) if words else np.zeros((0, 0))
    taken = list(range(len(chosen)))
    for i in range(len(chosen), len(words)):
        if len(taken) >= most:
            break
        if not taken or gram[i, taken].max() < near:
            taken.append(i)
    return [words[i] for i in taken]


def choose_landmarks(counts: DataFrame, toxic_docs: int, clean_docs: int, most: int) -> list[str]:
    """Words spread over those whose label shares differ most: two thirds leaning to toxic texts, the rest to clean ones."""
    odds = F.log((F.col("toxic") + 0.5) / (toxic_docs + 1.0)) - F.log((F.col("clean") + 0.5) / (clean_docs + 1.0))
    rated = staged(counts.where("toxic + clean > 1").withColumn("to_toxic", F.col("toxic") * odds).withColumn("to_clean", -F.col("clean") * odds), "words")
    top = lambda by: [r["word"] for r in rated.where(F.col(by) > 0).orderBy(F.desc(by), "word").select("word").limit(6 * most).collect()]
    return spread(top("to_clean"), spread(top("to_toxic"), [], most * 2 // 3, 0.75), most, 0.3)


def sentence_features(train: DataFrame, marks: Landmarks, model: Machine | None = None, bar: float = 0.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document number, label, Nyström features and a one) of training sentences: all, or those that a model takes for more toxic than bar."""
    sent = train.sparkSession.sparkContext.broadcast((marks, model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, model = sent.value
        score = Scorer(model) if model else None
        for batch in batches:
            for a, b in slices(batch.num_rows, 64):
                part = batch.slice(a, b - a)
                texts = part.column("text").to_pylist()
                docs = [score.toxic_sentences(t, bar) for t in texts] if score else [list(sentences(t)) for t in texts]
                tokens = sorted({t for d in docs for s in d for t in s})
                at = {t: i for i, t in enumerate(tokens)}
                value = marks.tokens(tokens)
                rows = []
                for n, label, doc in zip(part.column("n").to_pylist(), part.column("label").to_pylist(), docs):
                    for s in doc:
                        z = value[[at[t] for t in s]].sum(axis=0) if s else np.zeros(value.shape[1], np.float32)
                        full = np.flatnonzero(z)
                        rows.append((n, label, full.astype("<u2").tobytes(), z[full].astype("<f4").tobytes()))
                cols = list(zip(*rows)) or [()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int64(), pa.int32(), pa.binary(), pa.binary()])], ["n", "label", "at", "z"])

    rows = train.mapInArrow(run, "n long, label int, at binary, z binary").toArrow()
    x = np.zeros((rows.num_rows, len(marks.words) + 1), np.float32)
    x[:, -1] = 1
    for i, (at, z) in enumerate(zip(rows.column("at"), rows.column("z"))):
        x[i, np.frombuffer(at.as_buffer(), "<u2")] = np.frombuffer(z.as_buffer(), "<f4")
    return rows.column("n").to_numpy(), rows.column("label").to_numpy(), x


def machine(x: np.ndarray, y: np.ndarray, weights: np.ndarray, gram: np.ndarray, cost: float, beta: np.ndarray | None = None, most: int = 8) -> np.ndarray:
    """Weights a landmark and bias of the squared-hinge machine with the landmarks' kernel as its norm, by Newton steps."""
    reg = np.zeros((x.shape[1], x.shape[1]))
    reg[:-1, :-1] = (gram + 1e-3 * np.eye(len(gram))) / cost
    reg[-1, -1] = 1e-9
    beta = np.zeros(x.shape[1]) if beta is None else beta
    for _ in range(most):
        left, right = reg.copy(), np.zeros(len(reg))
        for a, b in slices(len(x), 4096):
            part, own = x[a:b], y[a:b]
            w = weights[a:b] * (own * (part @ beta) < 1)
            left += (part * w[:, None].astype(np.float32)).T @ part
            right += part.T @ (w * own)
        new = np.linalg.solve(left, right)
        if np.abs(new - beta).max() < 1e-3:
            return new
        beta = new
    return beta


def fit(train: DataFrame, n_toxic: int, n_clean: int, few: int, landmarks: int, rounds: int = 3) -> Machine | None:
    """The machine learned from rows (n, label, text, order); clean ones up to the order few teach in full, all where they err."""
    chosen = choose_landmarks(word_counts(train), n_toxic, n_clean, landmarks)
    if not chosen:
        return None
    marks = Landmarks(chosen)
    gram = marks.kernel(chosen).astype(float)
    doc, label, x = sentence_features(train.where((F.col("label") == 1) | (F.col("order") < few)), marks)
    toxic = label == 1
    at, first = np.flatnonzero(toxic), {}
    at = at[np.argsort(doc[at], kind="stable")]
    first = np.flatnonzero(np.append(True, doc[at][1:] != doc[at][:-1])) if len(at) else at
    y = np.where(toxic, 1.0, -1.0)
    size = np.diff(np.append(first, len(at)))
    weights = np.ones(len(y))
    weights[at] = np.repeat(1.0 / np.maximum(size, 1), size)
    beta = None
    for turn in range(rounds):
        share = max(1.0, weights[~toxic & (y < 0)].sum()) / max(1e-9, weights[y > 0].sum())
        beta = machine(x, y, np.where(y > 0, weights * share, weights), gram, 3.0, beta)
        if turn == rounds - 1:
            break
        # of each toxic document the sentences found toxic, or the worst one
        g = x[at] @ beta
        best = np.maximum.reduceat(g, first) if len(at) else g
        taken = g >= np.minimum(np.repeat(best, size), 0.5)
        weights[at] = np.where(taken, 1.0, 0.0)
        if turn == rounds - 2:
            # sentences of all clean documents that the machine takes for toxic or nearly so
            _, _, more = sentence_features(train.where((F.col("label") == 0) & (F.col("order") >= few)), marks, Machine(marks, beta[:-1], beta[-1]), -0.4)
            x, y, weights, toxic = np.concatenate([x, more]), np.append(y, -np.ones(len(more))), np.append(weights, np.ones(len(more))), np.append(toxic, np.zeros(len(more), bool))
    # landmarks of next to no weight change no decision
    heavy = np.flatnonzero(np.abs(beta[:-1]) >= 0.05 * np.abs(beta[:-1]).max())
    return Machine(Landmarks([chosen[i] for i in heavy]), beta[:-1][heavy], beta[-1])


class Scorer:
    """The worst decision over a text's sentences, one without words among them; each token's worth is found once in a worker."""

    def __init__(self, model: Machine):
        self.model, self.known = model, set()
        self.value: dict[str, float] = {}  # of the tokens worth something

    def _learn(self, new: set[str]) -> None:
        self.known |= new
        parts = {t: units(t) for t in new}
        worth = self.model.worth(sorted(set().union(*parts.values())))
        if worth:
            self.value.update((t, v) for t, p in parts.items() if (v := sum(worth.get(w, 0.0) for w in p)))

    def toxic_sentences(self, text: str | None, bar: float) -> list[set[str]]:
        found = list(sentences(text))
        self._learn(set().union(*found) - self.known)
        rated = [(sum(self.value.get(t, 0.0) for t in s) + self.model.bias, i) for i, s in enumerate(found)]
        return [found[i] for g, i in sorted(rated, reverse=True)[:WORST] if g > bar]

    def __call__(self, texts: list[str | None]) -> list[float]:
        rows = []
        for t in texts:
            tokens = tokens_of(t or "")
            rows.append({*tokens, *joined_letters(tokens)})
        new = set().union(*rows) - self.known
        self._learn(new)
        value, out = self.value, []
        for text, row in zip(texts, rows):
            own = [value[t] for t in value.keys() & row]
            most = max(own, default=0.0)
            if len(own) > 1 and sum(own) + self.model.bias > FLOOR:
                most = max(sum(value.get(t, 0.0) for t in s) for s in sentences(text))
            out.append(most + self.model.bias)
        if len(self.known) > MAX_WORDS:  # the early, frequent tokens stay
            self.known -= new
            for t in new:
                value.pop(t, None)
        return out


def score_toxicity(docs: DataFrame, labels: DataFrame, learn, landmarks: int = 256, sample: int = 1200, default: float = 0.0, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns keep and score in 0..1 of every row of docs, learned from the labelled rows for which the column learn holds.

    The labelled rows to learn from are bounded: about sample of label 1 and 4 * sample of label 0, picked by a hash of
    their doc_id. An empty or null text has no words and scores as its sentence without words. Where the fold has no
    label 1 the score is default. Other columns play no part. An empty table gives no rows.
    """
    kept = [F.col(c).alias(f"kept_{c}") for c in keep if c != "text"]
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *kept, "text")
    known, n = labelled_sample(labels, "toxic", learn, {1: sample, 0: 4 * sample})
    back = ["doc_id", *(F.col(c if c == "text" else f"kept_{c}").alias(c) for c in keep)]
    none = texts.select(*back, F.lit(float(default)).alias("score"))
    if not n.get(1):
        return none
    train = staged(texts.select("doc_id", "text").join(F.broadcast(known), "doc_id").select(F.monotonically_increasing_id().alias("n"), "label", "weight", "order", "text"), "toxic-train")
    got = {r["label"]: r["n"] for r in train.groupBy("label").agg(F.count("*").alias("n")).collect()}
    model = fit(train, got.get(1, 0), got.get(0, 0), sample, landmarks) if got.get(1) else None
    if model is None:
        return none
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def scorer(name: str, knots=None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            score = Scorer(sent.value)
            for batch in batches:
                for a, b in slices(batch.num_rows, ROWS):
                    part = batch.slice(a, b - a)
                    others = [c for c in part.schema.names if c != "text" or (knots and "text" in keep)]
                    raw = np.array(score(part.column("text").to_pylist()), float)
                    yield pa.RecordBatch.from_arrays([*(part.column(c) for c in others), pa.array(raw if knots is None else calibrated(raw, knots, default))], [*others, name])

        return run

    knots = isotonic(train.select("label", "weight", "text").mapInArrow(tidy(scorer("raw")), "label int, weight double, raw double"), -3.0, 3.0)
    schema = ", ".join(f"{n} {t}" for n, t in texts.dtypes if n != "text" or "text" in keep) + ", score double"
    return texts.mapInArrow(tidy(scorer("score", knots)), schema).select(*back, "score")


def toxicity_query(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    learn = fold("doc_id", 3) != 1
    out = score_toxicity(docs, labels, learn, keep=keep)
    return out.select("doc_id", *keep, (~learn).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
