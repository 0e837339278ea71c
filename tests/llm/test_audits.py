"""Source divergence, periodic runs and personal data on small odd tables, against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from ragset.llm import divergence, periods, private

RNG = random.Random(11)
WORDS = ["the", "of", "and", "River", "stone", "été", "naïve", "日本", "walks", "Ünder", "x1y", "it's"]


def prose(n, words=WORDS):
    return " ".join(RNG.choice(words) for _ in range(n))


# -- divergence ---------------------------------------------------------------------------------------------------


def audit(rows, least_docs, smooth, most):
    """The contract, in plain Python integers."""
    texts = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for text, lang, source in rows]
    out = set()
    for lang in {t[0] for t in texts}:
        own = [t for t in texts if t[0] == lang]
        kept = {w for w, n in Counter(w for t in own for w in set(t[2])).items() if n >= least_docs}
        groups = defaultdict(Counter)
        for _, source, words in own:
            groups[source].update(w for w in words if w in kept)
        whole = sum(groups.values(), Counter())
        share = lambda c: {w: 1 + 10**9 * (c[w] + smooth) // (sum(c.values()) + smooth * len(kept)) for w in kept}
        q, p = share(whole), {s: share(c) for s, c in groups.items()}
        for s in groups:
            far = sorted(((-sum(abs(p[s][w] - p[o][w]) for w in kept), o.encode(), o) for o in groups if o != s))
            more = sorted((q[w] - p[s][w], w.encode(), w) for w in kept if groups[s][w] and p[s][w] > q[w])[:most]
            for part, found in (("pair", far), ("term", more)):
                out |= {(lang, s, part, item, -v, i) for i, (v, _, item) in enumerate(found, 1)}
    return out


def divergence_rows():
    rows = [(prose(RNG.randrange(30), WORDS[: 4 + i % 9]), ("en", "de", None)[i % 3], ("a", "b", None, "Zé")[i % 4]) for i in range(90)]
    return rows + [(None, "en", "empty"), ("", "fr", "alone"), ("  ", "it", "x"), ("12 !?", "it", "y"), ("the " * 500, "en", "a"), ("x" * 5000, "en", "b"), (prose(40), "en", "b")] * 2


@pytest.mark.parametrize("groups, terms", [(128, 2048), (2, 3)])
def test_divergence(spark, monkeypatch, groups, terms):
    """Small tiles as well: groups and terms in several blocks."""
    monkeypatch.setattr(divergence, "GROUPS", groups)
    monkeypatch.setattr(divergence, "TERMS", terms)
    rows = divergence_rows()
    df = spark.createDataFrame([(t, lang, s, 1, "clash") for t, lang, s in rows], "text string, lang string, source string, n long, term string").repartition(3)
    got = [tuple(r) for r in divergence.source_divergence(df, least_docs=3, most=4).collect()]
    assert len(got) == len(set(got)) and set(got) == audit(rows, 3, 5, 4)
    assert divergence.source_divergence(df.limit(0)).count() == 0


def test_counters_are_sent_on(spark, monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 5)
    rows = divergence_rows()
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(2)
    assert {tuple(r) for r in divergence.source_divergence(df, least_docs=3).collect()} == audit(rows, 3, 5, 50)


def test_shares_are_exact():
    whole = 2**47 - 1
    counts = [0, 1, 2**31, 2**46 + 12345, whole]
    assert divergence.share(np.array(counts), np.int64(whole)).tolist() == [1 + 10**9 * c // whole for c in counts]


# -- runs ---------------------------------------------------------------------------------------------------------


def all_runs(words, least, power):
    """(start, length, smallest period) of all runs, by comparing each word with that q later, for each q."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(least, power * q):
                found.setdefault((start, i + q - start), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def repetitive(n):
    words, out = RNG.sample(range(9), RNG.randrange(1, 6)), []
    while len(out) < n:
        out += [RNG.choice(words) for _ in range(RNG.randrange(4))]
        block = [RNG.choice(words) for _ in range(RNG.randrange(1, 7))]
        out += (block * 7)[: RNG.randrange(1, 6 * len(block) + 1)]
        if RNG.random() < 0.2:
            out += out[-RNG.randrange(1, len(out) + 1) :] * RNG.randrange(1, 5)
    return out[: 3 * n]


def test_runs_against_all_periods():
    for i in range(600):
        words = repetitive(RNG.randrange(1, 90))
        for least, power in ((6, 4), (2, 2), (6, 3)) if i % 3 else ((6, 4),):
            want = all_runs(words, least, power)
            assert periods.text_runs([b"%d" % w for w in words], least, power) == want


def contract(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = all_runs(words, 6, 4)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    hashed = lambda s: hashlib.sha256(s.encode()).hexdigest()
    milli = 1000 * best[1] // best[2] if best else None
    return (doc_id, len(runs), *(best or (None,) * 3), milli, hashed("".join(f"{s},{n},{q}\n" for s, n, q in runs)), hashed(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_run_digests(spark):
    docs = [(i, prose(RNG.randrange(120))) for i in range(150)]
    docs += [(-5, "no no  no\nno no no no"), (200, None), (201, ""), (202, " \t"), (203, "z" * 60000), (204, prose(4000)), (205, "a b " * 900), (206, "été\x0bété " * 40 + prose(20)), (None, "a b " * 9), (None, None), (5, "x y z " * 20), (5, "x y z " * 20)]
    df = spark.createDataFrame([(i, t, 3, "clash") for i, t in docs], "doc_id long, text string, start long, runs string").repartition(3)
    got = [tuple(r) for r in periods.run_digests(df).collect()]
    assert sorted(map(repr, got)) == sorted(repr(contract(*d)) for d in docs)
    assert any(r[1] for r in got) and periods.run_digests(df.limit(0)).count() == 0


def test_collapsed_text_is_real(spark):
    df = spark.createDataFrame([(1, "a b c " + "tick tock " * 6 + "end")], "doc_id long, text string")
    row = periods.periodic_runs(df).first()
    assert row["collapsed"] == "a b c tick tock end" and [tuple(r) for r in row["runs"]] == [(3, 12, 2)]


# -- personal data ------------------------------------------------------------------------------------------------

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(number):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(number))) % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            n = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m[0].split(".")), "card": 16 <= len(n) <= 19 and luhn(n), "phone": 8 <= len(n) <= 15}[kind]:
                out.append((kind, m.start(), m.end()))
    return out


def card():
    body = "4" + "".join(RNG.choice("0123456789") for _ in range(14))
    return next(body + c for c in "0123456789" if luhn(body + c))


def personal(n):
    kinds = [
        lambda: f"ann.{RNG.randrange(99):02}@mail{RNG.randrange(9)}.example.com", lambda: ".".join(str(RNG.randrange(1, 300)) for _ in range(4)), card, lambda: " ".join(re.findall("....", card())),
        lambda: f"+1 ({RNG.randrange(200, 999)}) 555-{RNG.randrange(9999):04}", lambda: str(RNG.randrange(10**15, 10**16)), lambda: RNG.choice(["@", "a@b", "+", "1.2.3", "12-34", "+7()", "é@ü.de", "😀"]),
    ]
    return RNG.choice(["", " ", ", ", "é"]).join(RNG.choice([*kinds, lambda: prose(2)])() for _ in range(n))


@pytest.fixture(scope="module")
def letters(spark):
    docs = [(i, personal(RNG.randrange(9))) for i in range(250)]
    docs += [(300, None), (301, ""), (302, "1" * 50000), (303, "a" * 50000 + "@"), (304, "a@b.c_d@e.f " * 300), (305, "+1 (269) 555-3296 " * 150), (306, "a." * 20000), (307, "1.1." * 5000), (None, "x 1.2.3.4 y"), (4, "me@a.b"), (4, "me@a.b")]
    docs += [(400, "call +1 (269) 555-3296 4524132264652876 today"), (401, "plain words, nothing else"), (402, "on 2024-01-15, 3.5% of 1999 2000 2001"), (403, "ask bob.smith [at] mail.example [dot] com now"), (404, "meet at noon. The dot is red")]
    return docs, spark.createDataFrame([(i, t, "clash", 1) for i, t in docs], "doc_id long, text string, kind string, id long").repartition(3)


def test_base_spans(letters):
    docs, df = letters
    got = sorted(repr((r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"])) for r in private.private_query(df).collect())
    want = []
    for i, text in docs:
        spans = base_spans(text)
        line = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        want.append(repr((i, *(sum(k == x[0] for x in spans) for k in PATTERNS), hashlib.sha256(line.encode()).hexdigest())))
    assert got == sorted(want)
    assert private.private_query(df.limit(0)).count() == 0


def test_added_spans(letters):
    """What stands beside other digits, or is written out, is found; plain text is left alone; base spans stay, untouched by others."""
    docs, df = letters
    texts = {i: t for i, t in docs}
    rows = {r["doc_id"]: r["spans"] for r in private.private_query(df).collect()}
    assert rows[400] == "card:23:39,phone:5:22" and rows[401] == rows[402] == rows[404] == "" and rows[403].startswith("email:4:")
    order = list(PATTERNS)
    once = {i for i, n in Counter(i for i, _ in docs).items() if n == 1}
    for i, line in ((i, line) for i, line in rows.items() if i in once):
        spans = [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in line.split(",") if s)]
        base = base_spans(texts[i])
        assert set(base) <= set(spans) and spans == sorted(spans, key=lambda s: (order.index(s[0]), s[1]))
        assert not any(a < f and e < b for k, a, b in set(spans) - set(base) for _, e, f in base)


def test_a_table_without_candidates(spark):
    df = spark.createDataFrame([(1, "nothing here"), (2, None)], "doc_id long, text string")
    assert {(r["doc_id"], r["spans"], r["base_sha256"]) for r in private.private_query(df).collect()} == {(i, "", hashlib.sha256(b"").hexdigest()) for i in (1, 2)}


def test_reliabilities_are_found():
    """Votes drawn from known labelers give their shares of right votes back, and expectations agree with a loop over rows."""
    rng = np.random.default_rng(3)
    truth = rng.random(20000) < 0.3
    right = np.array([[0.95, 0.9], [0.9, 0.7], [0.6, 0.8]])  # on personal data, on the rest
    votes = np.stack([np.where(rng.random(20000) < 0.2, 0, np.where(truth, np.where(rng.random(20000) < a, 1, -1), np.where(rng.random(20000) < b, -1, 1))) for a, b in right], axis=1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    share, on_true, on_false, p = private.reliabilities(patterns, counts.astype(float), rounds=300)
    assert abs(share - 0.3) < 0.04 and np.abs(on_true - right[:, 0]).max() < 0.05 and np.abs(on_false - right[:, 1]).max() < 0.05
    for v, got in zip(patterns, p):
        odds = np.prod([{1: a, -1: 1 - a, 0: 1}[x] for x, a in zip(v, on_true)]) * share / (np.prod([{1: 1 - b, -1: b, 0: 1}[x] for x, b in zip(v, on_false)]) * (1 - share))
        assert abs(got - odds / (1 + odds)) < 1e-3


def test_classifier_minimises_its_loss():
    rng = np.random.default_rng(4)
    x, p, n = np.hstack([np.ones((40, 1)), rng.integers(0, 2, (40, 5))]), rng.random(40), rng.integers(1, 50, 40).astype(float)
    w = private.logistic(x, p, n)
    s = lambda w: 1 / (1 + np.exp(-x @ w))
    loss = lambda w: -(n * (p * np.log(s(w)) + (1 - p) * np.log(1 - s(w)))).sum() + (w @ w) / 2
    assert all(loss(w) <= loss(w + d) for d in rng.normal(0, 0.05, (200, 6)))


# -- rows of one id, small folds ----------------------------------------------------------------------------------


def test_rows_of_one_id_are_one_document(spark):
    from ragset.llm.ngram_join import ngram_join

    a, b, c = (" ".join(f"{k}{i}" for i in range(12)) for k in "abc")
    rows = [(3, a), (7, a), (7, b), (9, b), (7, ""), (20, c), (20, None), (21, c), (30, "x y"), (30, ""), (40, None), (40, ""), (None, a), (None, b)]
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in ngram_join(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect())
    want = [(3, 9, 3), (7, 9, 3), (7, 9, 3), (9, 9, 3), (7, 0, 3), (20, 9, 20), (20, 0, 20), (21, 9, 20), (30, 1, 30), (30, 0, 30), (40, 0, 40), (40, 0, 40)]
    assert got == sorted([(False, *w) for w in want] + [(True, 0, 9, None)] * 2)


def test_the_end_counts_in_small_folds(spark):
    """One and two training texts: their ends are known tokens, seldom as they are."""
    import math

    from pyspark.sql import functions as F

    from ragset.llm.mixing import score_texts

    for learn in (["beta gamma"], ["beta gamma", None], []):
        rows = [(i, t) for i, t in enumerate(learn)] + [(10, "beta gamma"), (11, "")]
        counts = Counter(w for t in learn for w in [*(t or "").split(), ""])
        n, v = sum(counts.values()), len(counts)
        got = {r.doc_id: r for r in score_texts(spark.createDataFrame(rows, "doc_id long, text string"), F.col("doc_id") < 10).collect()}
        for i, text in rows:
            tokens = [*(text or "").split(), ""]
            assert got[i].n_tokens == len(tokens) and got[i].n_known == sum(counts[w] > 0 for w in tokens) and got[i].train_tokens == n
            assert abs(got[i].base_score - sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens)) < 1e-9
