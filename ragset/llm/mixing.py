"""Scoring of texts by logistic context mixing.

A text is its words, A-Z in lower case, then an end. A word of the coding vocabulary is the bits of its path in a
Huffman tree; any other word is an escape and its bytes' paths in a second tree. Each bit is predicted from four
contexts, each hashed with the tree node to a slot of its own table; a slot's counts over all training texts give its
prediction. Predictions are added in the logistic domain with weights; a gate, the confidence of the two longest
contexts, picks the weight set; weights start the same for each text and follow its bits online: after every block of a few words
(8 at first, 128 later), the bits' errors move the weights that the next block is scored with.
Every text of the training part is counted; tables and coding vocabulary have fixed sizes, which are parameters, and
the word counts of the base score have none.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ragset.llm.common import attempt, staged
from ragset.llm.tokens import slices

CONTEXTS, COMMON, GATES, CUT = 4, 16, 32, 1 << 14
#: Words seen less often are spelled, so that the spelling is learned from such words too.
SPELL_BELOW = 3
#: Weights that a text starts with, a row for each context, by the gate's confidence of the longest context.
START = np.array([[0.10, 0.60, 0.30, 0.10], [0.10, 0.60, 0.30, 0.20], [0.10, 0.50, 0.30, 0.35], [0.10, 0.40, 0.25, 0.50]], np.float32)
MAX_WORDS, ROWS, ONE = 400_000, 1024, np.int32(1)
#: Symbols that are held to be counted together, and those whose bits are counted at once.
HELD, CHUNK = 4_000_000, 4096


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(the words of texts, text by text and each text's end as an empty word; how many each text has, with the end)."""
    open_ended = pc.binary_join_element_wise(pc.ascii_lower(texts.fill_null("")), "", " ")
    # white space at the end leaves an empty last word, which is the end
    words = pc.ascii_split_whitespace(pc.ascii_ltrim_whitespace(open_ended))
    return words.flatten().cast(pa.binary()), np.diff(np.asarray(words.offsets)).astype(np.int64)


def listed(words: pa.Array) -> list[bytes]:
    return words.to_numpy(zero_copy_only=False).tolist()


def huffman(counts: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(length of each symbol's path, all paths' nodes, all paths' bits); nodes are numbered from 0."""
    heap = [(c, i, None, None) for i, c in enumerate(counts)]
    heapq.heapify(heap)
    n = len(counts)
    kids = []
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        kids.append((a[1], b[1]))
        heapq.heappush(heap, (a[0] + b[0], n + len(kids) - 1, None, None))
    paths: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    stack = [(n + len(kids) - 1, [])] if kids else []
    while stack:
        at, path = stack.pop()
        if at < n:
            paths[at] = path
        else:
            stack += [(kid, [*path, (at - n, bit)]) for bit, kid in enumerate(kids[at - n])]
    return np.array([len(p) for p in paths]), np.array([x for p in paths for x, _ in p], np.uint32), np.array([b for p in paths for _, b in p], np.uint8)


@dataclass
class Code:
    """Symbols 0..len(words)-1 are words (the end is the word b""), then the escape, then the 256 bytes; byte 0 ends a spelling."""

    words: list[bytes]
    counts: list[int]
    rest: int
    byte_counts: list[int]
    table_bits: int
    lengths: np.ndarray = field(init=False)

    def __post_init__(self):
        w = huffman([*self.counts, max(1, self.rest)])
        b = huffman(self.byte_counts)
        self.lengths = np.concatenate([w[0], b[0]])
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.mixed = np.concatenate([w[1], b[1] + np.uint32(len(self.words) + 1)]) * np.uint32(0x2C1B3C6D)
        self.bits = np.concatenate([w[2], b[2]])
        self.known = pa.array(self.words, pa.binary())

    def numbers(self, words: pa.Array) -> np.ndarray:
        """The numbers of words, and of those without a number the escape's."""
        return pc.index_in(words, value_set=self.known).fill_null(len(self.words)).to_numpy().astype(np.int64)

    @cached_property
    def packed(self) -> np.ndarray:
        """mixed above 16 free bits above bits, so that a path's parts lie together."""
        return self.mixed.astype(np.uint64) << np.uint64(32) | self.bits

    def joint(self, table: np.ndarray) -> np.ndarray:
        """packed with the predictions of the first context's table, which is the same for all words, in between."""
        slots = self.slots(np.zeros(len(self.mixed), np.uint32), self.mixed)
        return self.packed | table.take(slots).view(np.uint16).astype(np.uint64) << np.uint64(16)

    def slots(self, context: np.ndarray, mixed: np.ndarray) -> np.ndarray:
        """The slots of nodes (mixed) in hashed contexts."""
        h = context ^ mixed
        h *= np.uint32(0x9E3779B1)
        h >>= np.uint32(32 - self.table_bits)
        return h

    def paths(self, sym: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(length of each symbol's path, where the paths' bits lie in mixed and bits)."""
        length = self.lengths.take(sym)
        ends = np.cumsum(length)
        path = np.arange(int(ends[-1]) if len(ends) else 0)
        path += np.repeat(self.starts.take(sym) - ends + length, length)
        return length, path


@dataclass
class Bits:
    """The symbols of a batch of texts, and by them its bits: first those of words, then those of spelled bytes, each by block and text.

    words are the numbers of all words, text by text with each text's end, sizes how many each text has; rare are the
    words without a number. who, sym and ctx are the symbols' texts, numbers and hashed contexts (a column each), the
    first n_words of them words, cuts their blocks. The rest is bit by bit, made when asked for: text, whether spelled,
    slot of each context, bit; blocks are the blocks' bits.
    """

    code: Code
    words: np.ndarray
    sizes: np.ndarray
    rare: list[bytes]
    who: np.ndarray
    sym: np.ndarray
    ctx: np.ndarray
    n_words: int
    cuts: list[tuple[int, int]]

    @cached_property
    def _paths(self) -> tuple[np.ndarray, np.ndarray]:
        return self.code.paths(self.sym)

    @cached_property
    def text(self) -> np.ndarray:
        return np.repeat(self.who, self._paths[0])

    @cached_property
    def spelled(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.sym)) >= self.n_words, self._paths[0])

    @cached_property
    def slots(self) -> list[np.ndarray]:
        length, path = self._paths
        return [self.code.slots(np.repeat(c, length), self.code.mixed.take(path)) for c in self.ctx.T]

    @cached_property
    def bits(self) -> np.ndarray:
        return self.code.bits.take(self._paths[1])

    @cached_property
    def blocks(self) -> list[tuple[int, int]]:
        ends = np.concatenate([[0], np.cumsum(self._paths[0])]).tolist()
        return [(ends[lo], ends[hi]) for lo, hi in self.cuts]


def _hash(a: np.ndarray, b) -> np.ndarray:
    h = (a.astype(np.uint32) + np.uint32(0x9E3779B9)) * np.uint32(0x85EBCA6B) ^ np.asarray(b, np.uint32) * np.uint32(0xC2B2AE35)
    return h ^ (h >> np.uint32(15))


def bits_of(code: Code, texts: list[list[bytes]]) -> Bits:
    """The bits of texts given as words; a text's end is added here."""
    words = pa.array([w for t in texts for w in (*t, b"")], pa.binary())
    return next(batches_of(code, words, np.array([len(t) + 1 for t in texts]), len(words)), None) or coded_bits(code, np.zeros(0, np.int64), np.zeros(0, np.int64), [])


def batches_of(code: Code, words: pa.Array, counts: np.ndarray, most: int) -> Iterator[Bits]:
    """The bits of texts (words, counts: see words_of) in batches of about most words."""
    numbers = code.numbers(words)
    rare_at = np.flatnonzero(numbers == len(code.words))
    rare, ends = listed(words.take(pa.array(rare_at))), np.cumsum(counts)
    at = 0
    while at < len(counts):
        begin = int(ends[at] - counts[at])
        to = min(len(counts), int(np.searchsorted(ends, begin + most)) + 1)
        a, b = np.searchsorted(rare_at, (begin, ends[to - 1]))
        yield coded_bits(code, numbers[begin : ends[to - 1]], counts[at:to], rare[a:b])
        at = to


def coded_bits(code: Code, w: np.ndarray, counts: np.ndarray, rare: list[bytes]) -> Bits:
    """The bits of texts given as the numbers w of their words and ends, counts of them a text; rare are the words without a number."""
    escape, spelt = len(code.words), np.flatnonzero(w == len(code.words))
    begin = np.concatenate([[0], np.cumsum(counts)[:-1]])
    text = np.repeat(np.arange(len(counts)), counts)
    nth = np.arange(len(w)) - begin[text]
    # contexts of words: the last common word, the word before, the two before
    before = np.where(nth > 0, np.concatenate([[0], w[:-1] + 1]), 0)
    before2 = np.where(nth > 1, np.concatenate([[0, 0], w[:-2] + 1])[: len(w)], 0)
    seen = np.maximum.accumulate(np.where(w < COMMON, np.arange(len(w)), -1))
    last = np.concatenate([[-1], seen[:-1]])
    common = np.where(last >= begin[text], w[np.maximum(last, 0)] + 1, 0)
    sizes = np.arange(int(counts.max()) if len(counts) else 0)
    block = np.where(sizes < 120, np.log2(sizes / 8 + 1), 4 + (sizes - 120) // 128).astype(np.int64)[nth]
    # symbols: each word, and after an escape its bytes
    spell = np.frombuffer(b"\0".join(rare) + b"\0" if rare else b"", np.uint8).astype(np.int64)
    of_word = np.repeat(spelt, np.array([len(x) + 1 for x in rare], np.int64)) if rare else spelt
    b1 = np.concatenate([[0], spell[:-1]]) if len(spell) else spell
    b2 = np.where(b1 == 0, 0, np.concatenate([[0], b1[:-1]]) if len(spell) else spell)
    b3 = np.where(b2 == 0, 0, np.concatenate([[0], b2[:-1]]) if len(spell) else spell)
    b4 = np.where(b3 == 0, 0, np.concatenate([[0], b3[:-1]]) if len(spell) else spell)
    b5 = np.where(b4 == 0, 0, np.concatenate([[0], b4[:-1]]) if len(spell) else spell)
    two = b1 * 257 + b2
    four = (two * 257 + b3) * 257 + b4
    lang = common[of_word]
    # words and spelled bytes have weights of their own, so that their blocks may lie apart
    key = np.concatenate([block, block[of_word] + (int(block.max()) + 1 if len(block) else 0)])
    order = np.argsort(key.astype(np.uint16) if len(key) and key.max() < 1 << 16 else key, kind="stable")  # short integers are sorted by digits
    key, ctx = key[order], np.zeros((len(key), CONTEXTS), np.uint32)
    for k, (of_w, of_b) in enumerate([(None, two * 521 + lang), (common, two * 257 + b3), (before, four), (before * 262147 + before2, four * 257 + b5)]):
        if of_w is not None:
            ctx[: len(w), k] = _hash(of_w & 0xFFFFFFFF, k + 1)
        ctx[len(w) :, k] = _hash(of_b & 0xFFFFFFFF, k + 11)
    bounds = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(key)] if len(key) else []
    return Bits(code, w, counts, rare, np.concatenate([text, text[of_word]])[order], np.concatenate([w, spell + escape + 1])[order], ctx.take(order, axis=0), len(w), list(zip(bounds, bounds[1:])))


def quantised(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """A slot's prediction in the logistic domain (in 1/256) and its confidence, 0 to 3, in the lowest two bits."""
    n = n0 + n1
    st = np.clip(np.log((n1 + 0.4) / (n0 + 0.4)), -7.5, 7.5)
    return (np.round(st * 1024).astype(np.int16) & ~3) | np.digitize(n, [1, 4, 24]).astype(np.int16)


def score_bits(b: Bits, tables: list[np.ndarray], n_texts: int, joint: np.ndarray | None = None) -> np.ndarray:
    """Natural log probability of each text. joint: code.joint() of the first table, where it is there already."""
    code, scale = b.code, np.float32(1 / 1024)
    joint = code.joint(tables[0]) if joint is None else joint
    weights = [np.tile(np.repeat(START[:, k] * scale, 4), n_texts * 2) for k in range(CONTEXTS)]
    out = np.zeros(n_texts)
    for lo, hi in b.cuts:
        spelled, who = lo >= b.n_words, b.who[lo:hi]
        length, path = code.paths(b.sym[lo:hi])
        if not len(path):
            continue
        part = joint.take(path)
        mixed, ctx = part.view(np.uint32)[1::2], np.repeat(b.ctx[lo:hi], length, axis=0)
        raw = [] if spelled else [part.view(np.int16)[1::4]]
        for k in range(len(raw), CONTEXTS):
            raw.append(tables[k].take(code.slots(ctx[:, k], mixed).astype(np.intp)))  # numpy is slow with other index types
        low, n = int(who[0]) * GATES, (int(who[-1]) - int(who[0]) + 1) * GATES  # a block's symbols lie text by text
        gate = np.repeat(who * GATES + (GATES // 2 * spelled - low), length)
        gate += (raw[3] & 3) << 2 | raw[2] & 3
        st = [r.astype(np.float32) for r in raw]
        own = [w[low : low + n] for w in weights]
        p = own[0].take(gate)
        p *= st[0]
        for w, s in zip(own[1:], st[1:]):
            more = w.take(gate)
            more *= s
            p += more
        np.clip(p, -9, 9, out=p)
        np.negative(p, out=p)
        np.exp(p, out=p)
        p += 1
        np.reciprocal(p, out=p)
        err = part.view(np.uint8)[::8] - p
        np.abs(err, out=p)
        np.subtract(1, p, out=p)
        np.log(p, out=p)
        first = np.flatnonzero(np.append(True, who[1:] != who[:-1]))
        out[who[first]] += np.add.reduceat(p, (np.cumsum(length) - length)[first], dtype=np.float64)
        rate = scale * scale / (60.0 + 0.5 * np.bincount(gate, minlength=n))
        for w, s in zip(own, st):
            s *= err
            w += np.bincount(gate, s, n) * rate
    return out


def add_bits(total: np.ndarray, b: Bits) -> None:
    """Counts the bits in total, a row for each context."""
    add_symbols(total, b.code, [(b.sym.astype(np.uint32), b.ctx)])


def add_symbols(total: np.ndarray, code: Code, parts: list[tuple[np.ndarray, np.ndarray]]) -> None:
    """Counts the bits of symbols, given by parts with their contexts, in total; only the counts that they touch are visited.

    A symbol's bits in a context hang on nothing else, so that they are made once for all its places in the parts.
    """
    sym = np.concatenate([s for s, _ in parts]).astype(np.uint64)
    for k in range(CONTEXTS):
        key = np.concatenate([c[:, k] for _, c in parts]).astype(np.uint64)
        key <<= np.uint64(32)
        key |= sym
        key.sort()
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, int)
        key, times = key[first], np.diff(first, append=len(key)).astype(np.int32)
        for once in (True, False):
            pick = np.flatnonzero((times == 1) == once)
            for lo, hi in slices(len(pick), CHUNK):
                _add_paths(code, total[k], key[pick[lo:hi]], None if once else times[pick[lo:hi]])


def _add_paths(code: Code, counts: np.ndarray, keys: np.ndarray, times: np.ndarray | None) -> None:
    """Counts the bits of keys (a hashed context above a symbol), each times often, or once."""
    length, path = code.paths((keys & np.uint64(0xFFFFFFFF)).astype(np.int64))
    part = code.packed.take(path)
    at = code.slots(np.repeat((keys >> np.uint64(32)).astype(np.uint32), length), part.view(np.uint32)[1::2]).astype(np.intp)
    at *= 2
    at += part.view(np.uint8)[::8]
    np.add.at(counts, at, ONE if times is None else np.repeat(times, length))


def vocabulary(docs: DataFrame) -> DataFrame:
    """(token, c) over all words and ends of docs; the end is the empty token."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(list(seen.keys()), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["token", "c"])
            seen.clear()
            return out

        for batch in batches:
            for lo, hi in slices(batch.num_rows, ROWS):
                found = words_of(batch.column("text").slice(lo, hi - lo))[0].value_counts()
                for word, c in zip(listed(found.field(0)), found.field(1).to_pylist()):
                    seen[word] += c
                if len(seen) > MAX_WORDS:
                    yield flush()
        yield flush()

    return docs.select("text").mapInArrow(count, "token binary, c long").groupBy("token").agg(F.sum("c").alias("c"))


def context_tables(docs: DataFrame, code: Code) -> list[np.ndarray]:
    """The tables of predictions: bits counted in each task, summed by stretches of slots."""
    slots = 1 << code.table_bits
    sent = docs.sparkSession.sparkContext.broadcast(code)

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, total, held = sent.value, np.zeros((CONTEXTS, 2 * slots), np.int32), []
        for batch in batches:
            for lo, hi in slices(batch.num_rows, ROWS):
                for b in batches_of(code, *words_of(batch.column("text").slice(lo, hi - lo)), 60_000):
                    held.append((b.sym.astype(np.uint32), b.ctx))
                    if sum(len(s) for s, _ in held) > HELD:
                        add_symbols(total, code, held)
                        held.clear()
        if held:
            add_symbols(total, code, held)
        for k in range(CONTEXTS):
            rows = []
            for at in range(0, 2 * slots, CUT):
                part = total[k, at : at + CUT]
                full = np.flatnonzero(part)
                if len(full):
                    big = part[full] > 254
                    rows.append((k * (2 * slots // CUT) + at // CUT, full.astype("<u2").tobytes(), np.where(big, 255, part[full]).astype(np.uint8).tobytes(), part[full][big].astype("<i4").tobytes()))
            cols = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int32()] + [pa.binary()] * 3)], ["cut", "at", "n", "big"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for cut, at, n, big in zip(*(batch.column(c).to_pylist() for c in ("cut", "at", "n", "big"))):
                v = np.frombuffer(n, np.uint8).astype(np.int64)
                v[v == 255] = np.frombuffer(big, "<i4")
                sums.setdefault(cut, np.zeros(CUT, np.int64))[np.frombuffer(at, "<u2")] += v
        out = [quantised(s[::2], s[1::2]).tobytes() for s in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(out, pa.binary())], ["cut", "v"])

    tables = np.zeros((CONTEXTS, slots), np.int16)
    flat = tables.reshape(-1)
    counted = docs.select("text").mapInArrow(own, "cut int, at binary, n binary, big binary").repartition(64, "cut")
    for r in counted.mapInArrow(add, "cut int, v binary").collect():  # as many rows as the tables have stretches
        flat[r["cut"] * CUT // 2 : (r["cut"] + 1) * CUT // 2] = np.frombuffer(r["v"], np.int16)
    return list(tables)


def _hash64(tokens: Iterable[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(t) for t in tokens], np.uint64).view(np.int64)


def frequent(vocab: DataFrame, most: int) -> dict[bytes, int]:
    """The counts of the words seen most often, most of them at most: those from a count on, all words of a like count or none."""
    step = F.floor(F.log2("c") * 64)
    bins = vocab.where(F.col("c") >= SPELL_BELOW).groupBy(step.alias("b")).count().orderBy(F.desc("b")).collect()  # 64 a doubling
    total, least = 0, None
    for r in bins:
        total += r["count"]
        if total > most:
            break
        least = r["b"]
    if least is None:
        return {}
    found = {bytes(r["token"]): r["c"] for r in vocab.where((F.col("c") >= SPELL_BELOW) & (step >= least)).collect()}
    return dict(sorted(found.items(), key=lambda x: (-x[1], x[0])))


def score_texts(docs: DataFrame, train: Column, coded: int = 1 << 17, table_bits: int = 20) -> DataFrame:
    """For every row of docs: doc_id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    train is a condition on doc_id that picks the texts to learn from; all of those count. A null text is empty: its
    end is its only token. Without training texts the tables predict nothing and each bit costs one bit. Rows of one
    doc_id, or with none, are scored as rows of their own. Other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    vocab = staged(vocabulary(texts.where(train)), "vocabulary")
    total, distinct = vocab.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    top = frequent(vocab, coded)
    ends = vocab.where(F.length("token") == 0).select("c").first()
    top[b""] = ends[0] if ends else 0  # the end is coded however seldom it is
    least = min((c for w, c in top.items() if w), default=None)  # from a count on all words are coded
    rest = vocab.where((F.length("token") > 0) & (F.lit(True) if least is None else F.col("c") < least))

    def spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(256)
        for batch in batches:
            token, c = batch.column("token"), batch.column("c").to_numpy()
            letters = np.frombuffer(b"".join(listed(token)), np.uint8)
            n += np.bincount(letters, np.repeat(c, pc.binary_length(token).to_numpy()), 256)
            n[0] += c.sum()
        yield pa.RecordBatch.from_pydict({"byte": pa.array(range(256), pa.int32()), "n": pa.array(n)})

    sent_top = spark.sparkContext.broadcast(top)
    by_byte = {r["byte"]: r["n"] for r in rest.mapInArrow(spelled, "byte int, n double").groupBy("byte").agg(F.sum("n").alias("n")).collect()}
    code = Code(list(top), [c + 1 for c in top.values()], int(by_byte.get(0, 0)) + 1, [int(by_byte.get(i, 0)) + 1 for i in range(256)], table_bits)
    sent_code = spark.sparkContext.broadcast(code)
    sent = spark.sparkContext.broadcast(context_tables(texts.where(train), code))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker, nth = attempt()[0], 0
        code, counts, n_coded = sent_code.value, sent_top.value, len(sent_top.value)
        known = np.array([counts[w] for w in code.words], float)
        base = np.log10((known + 1) / (total + distinct + 1))
        joint = code.joint(sent.value[0])
        for batch in batches:
            for lo, hi in slices(batch.num_rows, ROWS):
                own = batch.slice(lo, hi - lo)
                own = own.take(pc.array_sort_indices(pc.binary_length(own.column("text"))))  # texts of like length end in like blocks
                words, counts = words_of(own.column("text"))
                n_bytes = np.add.reduceat(pc.binary_length(words).to_numpy().astype(np.int64), np.cumsum(counts) - counts) + np.maximum(0, counts - 2)
                rows: list[tuple] = []
                for bits in batches_of(code, words, counts, 30_000):
                    score = score_bits(bits, sent.value, len(bits.sizes), joint) / np.log(10)
                    first = np.cumsum(bits.sizes) - bits.sizes
                    coded = bits.words < n_coded
                    at = np.where(coded, bits.words, 0)
                    sums = np.add.reduceat(np.where(coded, base[at], 0.0), first)
                    also = np.add.reduceat((coded & (known[at] > 0)).astype(np.int64), first)
                    n_rare, taken = np.add.reduceat((~coded).astype(np.int64), first).tolist(), 0
                    for n, s, x, k, r in zip(bits.sizes.tolist(), score.tolist(), sums.tolist(), also.tolist(), n_rare):
                        rare = Counter(bits.rare[taken : taken + r])
                        taken += r
                        rows.append((worker << 40 | nth, n, k, x, s, int(n_bytes[len(rows)]), _hash64(rare), list(rare.values())))
                        nth += 1
                cols = list(zip(*rows)) or [()] * 8
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays([own.column("doc_id"), *(pa.array(c, k) for c, k in zip(cols, kinds))], ["doc_id", "row", "n_tokens", "n_known", "base", "score", "n_bytes", "rare", "tf"])

    schema = "doc_id long, row long, n_tokens long, n_known long, base double, score double, n_bytes long, rare array<long>, tf array<int>"
    scored = staged(texts.mapInArrow(run, schema), "scored")
    # words outside the coding vocabulary are too rare to be hot keys; their counts come by a join on a 64-bit hash

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_hash64(listed(batch.column("token")))), batch.column("c")], ["h", "c"])

    other = rest.mapInArrow(hashed, "h long, c long")
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "tf")).alias("r")).select("row", F.col("r.rare").alias("h"), F.col("r.tf").alias("tf"))
    each = rare.join(other, "h", "left").groupBy("row").agg(
        F.sum(F.col("tf") * F.log10((F.coalesce("c", F.lit(0)) + 1.0) / (total + distinct + 1.0))).alias("more"), F.sum(F.when(F.col("c") > 0, F.col("tf")).otherwise(0)).alias("also")
    )
    return scored.join(each, "row", "left").select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("also", F.lit(0))).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"), "score", (-F.col("score") * float(np.log2(10)) / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"),
    )
