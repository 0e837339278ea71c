"""Operators on small odd tables, against brute force, round trips and held-out accuracy."""

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ragset.llm import chat, fitting, media, mixing, nearest, ngram_join, packing, pieces, quality, records, tokens, toxicity
from ragset.llm.common import fold, new_dir
from ragset.llm.graph import components
from ragset.llm.shingles import shingle_sets

RNG = random.Random(5)
WORDS = ["the", "of", "and", "river", "stone", "walks", "quietly", "over", "Blue", "fields", "été", "naïve", "ten", "12", "new", "light"]


def prose(n, words=WORDS):
    return " ".join(RNG.choice(words) for _ in range(n))


BASE = prose(60)
ODD = [
    (0, None), (1, ""), (2, " \n\t"), (3, "One two"), (4, BASE), (5, BASE), (6, BASE.upper()), (7, BASE + " extra tail"), (8, prose(40)), (9, "x" * 70000), (10, prose(9000)),
    (11, "a  b\n\nc. d, e   f "), (12, "日本語 テキスト 😀 \x00 end"), (13, "İstanbul ΣΑΣ, it's <|endoftext|> ok."), (None, "no id"), (4, BASE),
]
SCHEMA = "doc_id long, text string, n long, component string, offset long, score double"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, 7, "clash", 1, 0.5) for i, t in ODD], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def key(i):
    return -1 if i is None else i


def library(name):
    """The library by itself, apart from the code under test."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.public_path(name))


def test_packing(spark, odd, none):
    enc = library("byte_bpe_50k.json")
    ids = {key(i): [*enc.encode(t or "", add_special_tokens=False).ids, 1] for i, t in ODD}
    rows = packing.pack_documents(odd, keep_ids=True).collect()
    for i, n in Counter(key(i) for i, _ in ODD).items():
        got = sorted((r.start, r.length) for r in rows if key(r.doc_id) == i)
        assert got == sorted(p for p in packing.cut(len(ids[i]), 2048, packing.class_sizes(2048)) for _ in range(n))
        for r in rows:
            if key(r.doc_id) == i:
                own = np.array(ids[i][r.start : r.start + r.length], "<u4").tobytes()
                assert bytes(r.ids) == own and zlib.crc32(own) == r.ids_crc32 and r.doc_tokens == len(ids[i])
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(bins) == list(range(len(bins)))
    for b in bins.values():
        at = 0
        for o, n in sorted(b):
            assert o == at
            at += n
        assert at <= 2048
    assert packing.pack_documents(none).count() == 0


def test_cutting_and_filling():
    sizes = packing.class_sizes(2048)
    for n in (1, 2, 63, 64, 65, 66, 300, 2047, 2048, 2049, 5000):
        at = 0
        for start, length in packing.cut(n, 2048, sizes):
            assert start == at and length in sizes
            at += length
        assert at == n
    rest = {s: 2048 // s - 1 for s in sizes}
    placed = packing.fill_rest(rest, 2048, 10)
    assert len(placed) == sum(rest.values()) and len({p[:2] for p in placed}) == len(placed)


def test_records(spark, odd, none):
    assert records.crc32c_many([b"123456789", b"", b"\x00" * 32, b"a" * 5000])[:3] == [0xE3069283, 0, 0x8A9136AA]
    enc = library("word_bpe_49k.json")
    at, want = 0, []
    for i, t in sorted(ODD, key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or "")):
        ids = [*enc.encode(t or "", add_special_tokens=False).ids, 1]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    got = records.token_records(odd).collect()
    assert sorted((tuple(r) for r in got), key=lambda r: r[1]) == want
    assert records.token_records(none).count() == 0
    whole = records.frame([b"abcdef"])
    assert records.unframe(whole) == [b"abcdef"]
    with pytest.raises(ValueError):
        records.unframe([whole[0][:13] + b"X" + whole[0][14:]])


def test_encoder_equals_the_library():
    signs = ["a", "B", "é", "Ж", "İ", "ǅ", "Σ", "²", "_", ",", ".", "'", "'s", "7", "!", "(", "\u0307", "\x1c", "\x85", "\xa0", "\u3000", "\u200b", "😀", "日", " ", " ", " ", "\n", "\t", "\r", "\x00", "<|", "|>"]
    mixed = ["".join(RNG.choice(signs) for _ in range(RNG.randrange(1, 14))) for _ in range(3000)]
    cases = ["foo_, bar", " _, ", "x _. y", "a__, b", "a\x1c, b", "İ, x", "I²_. ok", "x <|endoftext|> y", "X <|ENDOFTEXT|>", "<|startoftext|>", "a, b. c,, d.. e ,f\n.g", " lead", "tail ", "ÀÉ ÎÕ"]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        plain, enc = library(name), tokens.TextEncoder(tokens.public_path(name))
        texts = [t for _, t in ODD] + [prose(300), *cases, *mixed]
        want = [np.array(plain.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
        for _ in range(2):
            assert [(t, w) for t, w, g in zip(texts, want, enc.encode(texts)) if w != g] == []


def test_media(spark, odd, none):
    import hashlib

    got = media.media_columns(odd).collect()
    assert sorted(key(r.doc_id) for r in got) == sorted(key(i) for i, _ in ODD)
    texts = {}
    for i, t in ODD:
        texts.setdefault(key(i), (t or "").encode())
    for r in got:
        p = texts[key(r.doc_id)]
        p += b"\xff" * (-len(p) % 576 or (0 if p else 576))
        assert (r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]))
        assert r.width * r.height == len(p) and r.feature == media.feature(p)
    assert len({(r.shard, r.offset) for r in got if r.doc_id in (4, 5)}) == 1
    assert media.media_columns(none).count() == 0


def test_shards_are_tar_files(spark, odd):
    import tarfile

    out = new_dir(spark, "tar")
    rows = media.write_shards(odd, out).collect()
    shard = rows[0].shard
    with tarfile.open(out.removeprefix("file:").replace("//", "/") + "/" + shard) as t:
        names = t.getnames()
        assert {r.digest + ".png" for r in rows if r.shard == shard} == set(names)
        assert media.decode_png(t.extractfile(names[0]).read())


def brute_components(texts, words, percent):
    sets = {i: (lambda w: frozenset(tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))) if w else frozenset())((t or "").encode().lower().split()) for i, t in texts}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_ngram_join(spark, odd, none):
    copies = [(100, BASE)]
    for i in range(101, 160):  # a chain of near copies, a hot passage, and short texts
        w = copies[-1][1].split()
        w[RNG.randrange(len(w))] = f"w{i}"
        copies.append((i, " ".join(w)))
    copies += [(200 + i, prose(20) + " " + BASE) for i in range(20)] + [(300 + i, " ".join(["same"] * i)) for i in range(8)]
    table = [(i, t) for i, t in dict(ODD).items() if i is not None] + copies
    df = spark.createDataFrame([(i, t, 1) for i, t in table] + [(None, BASE, 1), (4, BASE, 1)], "doc_id long, text string, n long")
    for words, percent in ((4, 85), (5, 80), (2, 60)):
        want = brute_components(table, words, percent)
        got = ngram_join.ngram_join(df, words, percent).collect()
        assert len(got) == len(table) + 2
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
        assert [r.component_id for r in got if r.doc_id is None] == [None]
    assert ngram_join.ngram_join(none).count() == 0
    assert [len(h) for h in shingle_sets([None, "", "a b", "a b c d e", "A B c d E"], 4)] == [0, 0, 1, 2, 2]


def test_ngram_join_within_a_group(spark, monkeypatch):
    # sets of one prefix that no other group holds: the hub differs from two that link, with and without rounds of stars
    order = lambda words, t: sorted(shingle_sets([t], words).__next__().tolist())
    table, k = [], 0
    while len(table) < 24:
        k += 1
        h = [f"u{k}x{j}" for j in range(16)]
        texts = [" ".join(w) for w in (h, [*h[:14], "p", "q"], [*h[:14], "p", "r"])]
        firsts = {tuple(order(4, t)[:2]) for t in texts}
        if len(firsts) == 1:
            table += [(3 * k + j, t) for j, t in enumerate(texts)]
    df = spark.createDataFrame(table, "doc_id long, text string")
    monkeypatch.setattr(ngram_join, "frequency_sketch", lambda docs, words: np.zeros(ngram_join.SLOTS, np.uint8))
    want = brute_components(table, 4, 85)
    assert len({c for _, c in want.values()}) == 16
    for stars, tile in ((3, 1024), (0, 1)):
        monkeypatch.setattr(ngram_join, "TILE", tile, raising=False)
        got = ngram_join.ngram_join(df, 4, 85, stars).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_copies_alone_put_no_shingle_into_the_join(spark, monkeypatch):
    met = []
    monkeypatch.setattr(ngram_join, "prefix_tokens", lambda *a, real=ngram_join.prefix_tokens: met.append(real(*a)) or met[-1])
    alone = [(i, BASE) for i in range(40)] + [(100 + i, " ".join(f"w{i}x{j}" for j in range(30))) for i in range(10)]
    near = [(200, "n " * 3 + prose(50)), (201, prose(50))]
    near += [(202, near[0][1] + " end"), (203, near[0][1] + " end")]
    for table, some in ((alone, False), (alone + near, True)):
        got = ngram_join.ngram_join(spark.createDataFrame(table, "doc_id long, text string").repartition(4)).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(table, 4, 85)
        assert (met[-1].count() > 0) == some


def test_runs_of_few_words():
    for words in (4, 5):
        for n in range(6):
            for texts in ([prose(n)], [None] * 2 + [" ".join("abcde"[:n])] + [""]):
                assert [len(s) for s in shingle_sets(texts, words)] == [min(1, len((t or "").split())) + max(0, len((t or "").split()) - words) for t in texts]


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(50, 60), (61, 50), (60, 60)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, 50: 50, 60: 50, 61: 50}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_nearest(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 16))
    x[7] = x[9]
    rows = [(i, v.tolist(), "s") for i, v in enumerate(x)] + [(1000, None, ""), (1020, [0.0] * 16, ""), (1040, [float("nan")] * 16, ""), (1060, [1.0, None] * 8, ""), (1080, [1.0], ""), (None, [1.0] * 16, "")]
    got = nearest.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string"), block_rows=100).collect()
    hit = total = 0
    for q in range(0, 600, 20):
        score = x @ x[q]
        score[q] = -np.inf
        best = np.lexsort((np.arange(600), -score))[:20]
        own = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [r[0] for r in own] == list(range(1, 21))
        assert own == [(i + 1, v, s) for i, (s, v) in enumerate(sorted(((s, v) for _, v, s in own), key=lambda p: (-p[0], p[1])))]
        assert all(math.isclose(s, score[v], rel_tol=1e-12) for _, v, s in own)
        hit += len({v for _, v, _ in own} & set(best.tolist()))
        total += 20
    assert {r.query_id for r in got} == set(range(0, 600, 20)) and hit / total >= 0.9
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5])], "vec_id long, embedding array<float>")
    assert [(r.rank, r.vec_id) for r in nearest.nearest(few).orderBy("rank").collect()] == [(1, 1), (2, 2)]
    assert nearest.nearest(few.limit(0)).count() == 0


def test_probing_finds_every_code_in_the_radius():
    codes = np.random.default_rng(2).integers(0, 256, (300, 16), dtype=np.uint8)
    t = nearest.Tables(codes)
    for r in (0, 40, 55, 70):
        rows, far = t.within(codes[3], r)
        want = np.flatnonzero(np.bitwise_count(codes ^ codes[3]).sum(axis=1) <= r)
        assert rows.tolist() == want.tolist() and (far <= r).all()


def test_pieces(spark, odd, none):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=tokens.public_path("piece_bpe_32k.model"))
    t = pieces.Transducer(tokens.public_path("piece_bpe_32k.model"))
    texts = [x for _, x in ODD] + [prose(200), "x" * 300, "ab" * 5000, "日本" * 20000, "aaaa" * 9, "Hello  world\n x ﬁ ½ ①\tq ", "   ", "1,000. a,b 'tis"]
    for text, (ids, _) in zip(texts, t.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == sp.encode(text or "")
        assert t.decode(np.frombuffer(ids, "<u4")) == (text or "")
    huge = t.encode(["x" * 1_000_000])[0][0]
    assert t.decode(np.frombuffer(huge, "<u4")) == "x" * 1_000_000 and max(map(len, t.known)) <= pieces.SHARED
    ids = sorted(t.id_of.values())
    for i, k in [(RNG.choice(ids), RNG.choice(ids)) for _ in range(300)] + [(t.id_of[p[:-1]], t.id_of[p[-1]]) for p in list(t.id_of)[:900] if p[:-1] in t.id_of and p[-1] in t.id_of]:
        parts = list(t.pieces[i] + t.pieces[k])
        while (best := min(((t.weight[t.id_of[a + b]], n) for n, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in t.id_of), default=None)) is not None:
            parts[best[1] : best[1] + 2] = ["".join(parts[best[1] : best[1] + 2])]
        assert t.follows(i, k) == (parts == [t.pieces[i], t.pieces[k]])
    got = pieces.piece_digests(odd).collect()
    assert sorted((key(r.doc_id), r.decoded_crc32) for r in got) == sorted((key(i), zlib.crc32((x or "").encode())) for i, x in ODD)
    assert pieces.piece_digests(none).count() == 0


def test_context_mixing(spark, odd, none):
    docs = [(i, prose(RNG.randrange(0, 60)) + (" same closing passage of words here" if i % 2 else "")) for i in range(80)]
    df = odd.select("doc_id", "text").union(spark.createDataFrame(docs, "doc_id long, text string").where("doc_id > 20"))
    table = ODD + [d for d in docs if d[0] > 20]
    train = fold("doc_id", 7) != 2
    got = mixing.score_texts(df, train, coded=40).collect()
    learn = [(t or "").encode().lower().split() for i, t in table if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2]
    counts = Counter(w for t in learn for w in (*t, b""))
    n, v = sum(counts.values()), len(counts)
    want = sorted((key(i), len(t) + 1, sum(counts[w] > 0 for w in t) + 1, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in (*t, b"")), 6)) for i, t in ((i, (t or "").encode().lower().split()) for i, t in table))
    assert sorted((key(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == want
    assert all(r.train_tokens == n and r.score < 0 for r in got)
    assert mixing.score_texts(none, train).count() == 0


def test_bits_make_a_distribution():
    code = mixing.Code([b"", b"a", b"bb"], [9, 5, 3], 4, [2 if i < 100 else 1 for i in range(256)], 10)
    tables = [mixing.quantised(np.random.default_rng(k).integers(0, 9, 1024), np.random.default_rng(k + 9).integers(0, 9, 1024)) for k in range(4)]
    total = np.exp(mixing.score_bits(mixing.bits_of(code, [[], [b"a"], [b"bb"]]), tables, 3)).sum()
    assert 0 < total < 1
    # first words: a, bb, the end and all one-byte words leave room for longer ones only
    one = [[bytes([b])] for b in range(33, 256) if bytes([b]) not in (b"a",)]
    got = mixing.score_bits(mixing.bits_of(code, [[b"a"], [b"bb"], *one]), tables, len(one) + 2)
    assert np.exp(got).sum() < 1


def test_mixing_bit_by_bit():
    words = [b"", b"the", b"of", b"river"]
    code = mixing.Code(words, [9, 7, 5, 3], 4, [1 + i % 3 for i in range(256)], 8)
    tables = [mixing.quantised(np.random.default_rng(k).integers(0, 30, 256), np.random.default_rng(k + 9).integers(0, 30, 256)) for k in range(4)]
    texts = [[RNG.choice([b"the", b"of", b"river", b"x", b"zz"]) for _ in range(n)] for n in (0, 3, 40, 300)]
    got = mixing.score_bits(b := mixing.bits_of(code, texts), tables, len(texts))
    weights, want = {}, [0.0] * len(texts)
    for lo, hi in b.blocks:
        moves = {}
        for i in range(lo, hi):
            raw = [int(tables[k][b.slots[k][i]]) for k in range(4)]
            gate = (int(b.text[i]), bool(b.spelled[i]), raw[3] & 3, raw[2] & 3)
            w = weights.setdefault(gate, [float(x) for x in mixing.START[gate[2]]])
            p = 1 / (1 + math.exp(-max(-9, min(9, sum(x * r / 1024 for x, r in zip(w, raw))))))
            want[gate[0]] += math.log(p if b.bits[i] else 1 - p)
            moves.setdefault(gate, []).append([(int(b.bits[i]) - p) * r / 1024 for r in raw])
        for gate, m in moves.items():
            weights[gate] = [x + sum(s) / (60 + 0.5 * len(m)) for x, s in zip(weights[gate], zip(*m))]
    assert len(b.blocks) > 5 and np.allclose(got, want, rtol=1e-4)


def labelled(spark, make):
    rows = [(i, *make(i)) for i in range(400)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(None, "x"), (5000, None), (5001, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y, y) for i, _, y in rows] + [(5000, None, None)], "doc_id long, quality int, toxic int")
    return docs, labels, {i: y for i, _, y in rows}


def accuracy(got, truth):
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    return sum(r.predicted == truth[r.doc_id] for r in held) / len(held)


def test_isotonic_against_every_step(spark):
    rows = [(RNG.random() * 2 - 0.5, RNG.randrange(2), RNG.choice([1.0, 3.0])) for _ in range(60)]
    x, y = fitting.isotonic(spark.createDataFrame(rows, "raw double, label int, weight double"), -0.5, 1.5)
    rows.sort()
    step = 2.0 / (fitting.BINS - 1)
    sums = {}
    for r, label, w in rows:
        b = math.floor((r + 0.5) / 2.0 * (fitting.BINS - 1))
        p, n = sums.get(b, (0.0, 0.0))
        sums[b] = (p + w * label, n + w)
    bins = sorted(sums)
    for i, b in enumerate(bins):  # the fit at a bin: the largest over starts of the least mean over ends
        mean = lambda a, c: sum(sums[k][0] for k in bins[a : c + 1]) / sum(sums[k][1] for k in bins[a : c + 1])
        want = max(min(mean(a, c) for c in range(i, len(bins))) for a in range(i + 1))
        assert math.isclose(np.interp(-0.5 + b * step, x, y), want, abs_tol=1e-9)


def test_quality_takes_one_python_worker_a_task(spark):
    docs = spark.createDataFrame([(i, prose(9), "en") for i in range(20)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int")
    for keep in ((), ("lang", "text")):
        out = quality.score_quality(docs, labels, F.lit(True), features=8, keep=keep)
        assert out._jdf.queryExecution().sparkPlan().toString().count("MapInArrow") == 1
        assert out.count() == 20 and out.columns == ["doc_id", *keep, "score"]


def test_quality_against_one_matrix(spark):
    rows = [(i, prose(RNG.randrange(3, 40)) + ("!!!" if i % 3 == 0 else ""), i % 3 > 0) for i in range(120)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(y)) for i, _, y in rows], "doc_id long, quality int")
    got = {r.doc_id: r.score for r in quality.score_quality(docs, labels, F.lit(True), features=16).collect()}
    m = np.array([quality.statistics(t.encode()) for _, t, _ in rows])
    y = np.array([float(v) for *_, v in rows])
    scale = np.sqrt(np.maximum((m * m).mean(0) - m.mean(0) ** 2, 1e-8)) + 1e-3
    rng = np.random.default_rng(8)
    w, shift = rng.normal(size=(quality.STATS, 16)) / 4.0, rng.uniform(0, 2 * np.pi, 16)
    f = np.c_[np.sqrt(2 / 16) * np.cos(np.clip((m - m.mean(0)) / scale, -6, 6) @ w + shift), np.ones(len(m))]
    penalty = np.eye(17) * (1e-3 * len(m) + 1e-6)
    penalty[-1, -1] = 1e-6
    raw = f @ np.linalg.solve(f.T @ f + penalty, f.T @ y)
    order = np.argsort(raw)
    scores = np.array([got[i] for i in range(120)])[order]
    assert (np.diff(scores) >= -1e-9).all()  # the same order as the plain solution's
    assert abs(scores.mean() - y.mean()) < 0.05


def test_subsequences_against_an_enumeration():
    for word in ("idiot", "a", "aa", "abcab", "été", "x" * 9):
        s, want = [1, *(ord(c) - 95 if "a" <= c <= "z" else 28 + ord(c) % 36 for c in word), 1], Counter()
        for i, j, k in itertools.combinations(range(len(s)), 3):
            if k - i < toxicity.SPAN:
                want[(s[i] * 64 + s[j]) * 64 + s[k]] += toxicity.DECAY ** (k - i - 2)
        row, key, val = toxicity.triples([word, "other"])
        norm = math.sqrt(sum(v * v for v in want.values()))
        assert {k: round(v, 9) for r, k, v in zip(row, key, val) if r == 0} == {k: round(v / norm, 9) for k, v in want.items()}


def test_worth_of_words_leaves_none_out():
    words = sorted({"".join(RNG.choice("abcdeio") for _ in range(RNG.randrange(1, 12))) for _ in range(800)})
    marks = toxicity.Landmarks(words[:40])
    weight = np.random.default_rng(3).normal(size=40) * 2
    got = toxicity.Machine(marks, weight, -1.0).worth(words)
    plain = marks.kernel(words) @ weight
    assert set(got) == {w for w, v in zip(words, plain) if v >= toxicity.Machine(marks, weight, -1.0).least} and len(got) > 5
    assert all(abs(plain[words.index(w)] - v) < 1e-4 for w, v in got.items())


def test_quality(spark, none):
    docs, labels, truth = labelled(spark, lambda i: (prose(50), 1) if i % 3 else (" ".join(w.upper() + "!!" for w in prose(50).split()), 0))
    got = quality.quality_query(docs, labels).collect()
    assert len(got) == 403 and accuracy(got, truth) > 0.95
    assert quality.quality_query(none, labels).count() == 0
    assert {r.score for r in quality.quality_query(docs, labels.limit(0)).collect()} == {1.0}


def test_toxicity(spark, none):
    bad = ["blockhead", "nitwit", "blo.ckhead", "nit-wit", "blocckhead", "n i t w i t"]
    docs, labels, truth = labelled(spark, lambda i: (prose(30) + " " + bad[i // 4 % 2] + " " + prose(5), 1) if i % 4 == 0 else (prose(35), 0))
    got = toxicity.toxicity_query(docs, labels).collect()
    assert len(got) == 403 and accuracy(got, truth) > 0.95
    hidden = spark.createDataFrame([(9000 + k, prose(10) + " " + b + " " + prose(3)) for k, b in enumerate(bad)], "doc_id long, text string")
    both = toxicity.toxicity_query(docs.union(hidden), labels).where("doc_id >= 9000").collect()
    assert sum(r.predicted for r in both) >= 5
    assert toxicity.toxicity_query(none, labels).count() == 0
    assert {r.score for r in toxicity.toxicity_query(docs, labels.limit(0)).collect()} == {0.0}


def test_viterbi_against_every_path():
    rng = np.random.default_rng(4)
    for n in (1, 2, 4, 5):
        start, trans, emit = (np.log(rng.dirichlet(np.ones(k), r)) for k, r in ((6, 1), (6, 6), (60, 6)))
        obs = rng.integers(0, 60, n)
        best = max(itertools.product(range(6), repeat=n), key=lambda p: start[0][p[0]] + emit[p[0], obs[0]] + sum(trans[a, b] + emit[b, o] for a, b, o in zip(p, p[1:], obs[1:])))
        assert chat.viterbi(obs, start[0], trans, emit).tolist() == list(best)


def test_lines_are_numbered(spark):
    rows = [(1, t // 2, "user", "\n".join([f"x{t}"] * (t % 3 + 1))) for t in range(300)] + [(2, -1, "user", "same")] * 200 + [(3, 0, None, None)]
    got = chat.transcript_lines(chat.numbered(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()
    for c in (1, 2, 3):
        own = sorted((r.at, r.line) for r in got if r.conv_id == c)
        assert [a for a, _ in own] == list(range(sum(len((t or "").split("\n")) + 1 for k, _, _, t in rows if k == c)))
        assert [line for _, line in own].count("") == sum(k == c for k, *_ in rows) + (c == 3)


def test_chat(spark):
    turns = []
    for c in range(60):
        if c % 7 == 0:
            turns.append((c, -1, "system", prose(12)))
        for t in range(6):
            turns.append((c, t, "assistant" if t % 2 else "user", prose(90) + "\n" + prose(40) if t % 2 else prose(6) + "?"))
    long = [(90, t, "assistant" if t % 2 else "user", "\n".join(prose(5) for _ in range(300)) if t == 3 else prose(9)) for t in range(400)]
    odd = [(None, 0, "user", "x"), (7000, None, "user", "hello there"), (7001, 0, "user", None), (7002, 0, "narrator", "says")]
    same = [(7003, 1, "user", "alpha one\nalpha two\nalpha three"), (7003, 1, "user", "beta one\nbeta two\nbeta three")]
    df = spark.createDataFrame(turns + odd + same + long, "conv_id long, turn long, role string, text string")
    lines = chat.with_observations(chat.transcript_lines(chat.numbered(df.where("conv_id is not null").withColumn("turn", F.coalesce("turn", F.lit(-1))))))
    assert lines.groupBy("conv_id", "stretch").count().agg(F.max("count")).first()[0] <= chat.STRETCH + 2 * chat.MARGIN
    found = chat.decode(lines, chat.learn(lines)).collect()
    whole = lambda c: "\n".join(r.text.rstrip("\n") for r in sorted((r for r in found if r.conv_id == c), key=lambda r: (r.turn_no, r.part)))
    assert whole(7003) in ("\n".join(t for *_, t in same), "\n".join(t for *_, t in reversed(same)))
    assert [line for line in whole(90).split("\n") if line][3:303] == long[3][3].split("\n")
    got = chat.format_chats(df).collect()
    right = held = 0
    for c in range(60):
        if zlib.crc32(str(c).encode()) % 5 == 0:
            want = [r for cc, _, r, _ in turns if cc == c]
            own = [r.role for r in sorted((r for r in got if r.conv_id == c), key=lambda r: (r.turn_no, r.part))]
            held, right = held + 1, right + (own == want)
    assert held and right / held >= 0.7
    assert {7000, 7001, 7002} <= {r.conv_id for r in got} and len({(r.conv_id, r.turn_no, r.part) for r in got}) == len(got)
    assert chat.format_chats(df.limit(0)).count() == 0
