"""Personal data in texts: labelers vote, expectation-maximisation weighs them, a classifier of spans decides. All native.

Base spans are the matches of four strict patterns that pass their check. Candidates are these and what looser patterns
find beside them: numbers in other groupings, addresses written out. Five labelers vote for, against or not at all on
each candidate: the strict pattern, arithmetic on its characters, gazetteers (top-level domains, card issuers, calling
codes, reserved networks), the cue words before it, and the characters at its edges. No vote is trusted: for each kind,
expectation-maximisation estimates how often each labeler is right about personal data and about the rest, and what
every pattern of votes is worth. A logistic classifier is then trained on these probabilities and on features of the
spans; candidates beyond the base that it gives at least `least` become spans too.

Texts are read by built-in expressions alone. What reaches the driver is one row for each kind and pattern of votes and
features, at most 4 * 3^5 * 2^4 rows however large the table; the models are a few numbers a kind.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ragset.llm.common import staged

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("shape", "sums", "gazetteer", "context", "edges")
FEATURES = ("strict", "spaced", "grouped", "lettered")
BLOCK = 64

#: The strict patterns. Possessive repeats and the look behind keep them linear in the text; the matches are the same.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_AT, _DOT = r"\x20?[\[({<]\x20?(?:at|AT|@)\x20?[\])}>]\x20?", r"(?:\.|\x20?[\[({<]\x20?(?:dot|DOT|\.)\x20?[\])}>]\x20?)"
#: Looser patterns: addresses written out, IPv6 and bracketed dots, cards and phones by their usual groups of digits, so that
#: other digits beside them don't count, cards of 13 digits or with dots, phones without a plus sign.
LOOSE = {
    "email": rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:(?:@|{_AT})[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)++|\x20(?:at|AT)\x20[A-Za-z0-9-]++(?:\x20(?:dot|DOT)\x20[A-Za-z0-9-]++)++)",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:(?:\.|\[\.\]|\x20?[\[(](?:dot|\.)[\])]\x20?)[0-9]{1,3}){3}(?![0-9])|(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[\x20.-]?[0-9]{4}){3}(?:[\x20.-]?[0-9]{1,3})?|[0-9]{4}[\x20.-][0-9]{6}[\x20.-][0-9]{4,5})(?![0-9])",
    "phone": r"(?<![0-9])(?:(?:\+|00)[0-9]{1,3}[\x20.-]?)?(?:\([0-9]{2,5}\)|[0-9]{2,5})[\x20./-]?[0-9]{3,4}[\x20.-][0-9]{3,5}(?![0-9])",
}
#: Texts without these have no match of the kind at all.
HINT = {"email": r"@|[\[({<]\x20?(?:at|AT)|\x20(?:dot|DOT)\x20", "ip": r"[0-9A-Fa-f][.:\[(\x20]", "card": r"[0-9]", "phone": r"[0-9]"}

#: Gazetteers and cue words.
DOMAINS = r"(?i)(?:\.|dot\x20?|[\])}>]\x20?)(?:com|org|net|edu|gov|int|mil|info|biz|io|co|ai|app|dev|me|eu|de|at|ch|fr|es|it|nl|be|lu|pt|pl|cz|se|no|dk|fi|ie|uk|us|ca|mx|ar|br|cl|au|nz|jp|cn|in|kr|ru|ua|gr|tr|za)$"
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|3[068]|6011|64|65|62)"
CALLING = r"^(?:\+|00)\D*(?:1|7|20|27|30|31|32|33|34|36|39|4[013456789]|5[1-8]|6[0-6]|8[1246]|9[0-58]|35[0-9]|37[0-9]|38[0-9]|42[0-9]|97[0-9])"
CODED, AREA = r"^(?:\+|00|\()", r"^(?:\([0-9]{2,5}\)|[2-9][0-9]{2}[\x20.-][2-9])"
RESERVED = r"^0*(?:0|127|22[4-9]|2[34][0-9]|25[0-5])\D"
CUES = {
    "email": r"(?i)(?:e-?mail|mail|contact|write|reach|correo|courriel|kontakt)\W*(?:\w+\W+)?$",
    "ip": r"(?i)(?:\bip|host|server|addr|adress|direcci[oó]n|client|peer|from)\W*(?:\w+\W+)?$",
    "card": r"(?i)(?:card|visa|mastercard|amex|credit|debit|karte|carte|tarjeta|pan)\W*(?:\w+\W+)?$",
    "phone": r"(?i)(?:phone|tel|call|fax|mobile|cell|ring|telefon|t[eé]l[eé]phone|tel[eé]fono|handy|nummer)\W*(?:\w+\W+)?$",
}
OTHER_CUES = r"(?i)(?:\bversion|\bv|release|isbn|issn|doi|order|invoice|ticket|section|chapter|page|revision|build|serial|sku|part|pp|vol|art)\W*(?:(?:no|nr|number|id)\W*)?$"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value evaluated once however often use names it."""
    return F.transform(F.array(value), use)[0]


def matches(text: Column, pattern: str) -> Column:
    """The matches of pattern in text in order: start and end in code points, word, and up to 30 characters before and one after."""

    def within(at: Column, block: Column) -> Column:
        step = lambda acc, e: F.struct(
            (acc["at"] + e["gap"] + e["n"]).alias("at"), F.concat(acc["done"], F.array(F.struct((acc["at"] + e["gap"]).alias("start"), (acc["at"] + e["gap"] + e["n"]).alias("end"), e["word"].alias("word"), e["before"].alias("before"), e["after"].alias("after")))).alias("done")
        )
        return F.aggregate(block, F.struct(at.alias("at"), F.expr("CAST(array() AS array<struct<start: long, end: long, word: string, before: string, after: string>>)").alias("done")), step)["done"]

    def walk(each: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(each) - 1) / BLOCK).cast("int")), lambda b: F.slice(each, b * BLOCK + 1, BLOCK))
        step = lambda acc, x: F.struct((acc["at"] + F.aggregate(x, F.lit(0).cast("long"), lambda a, e: a + e["gap"] + e["n"])).alias("at"), F.concat(acc["done"], F.array(within(acc["at"], x))).alias("done"))
        start = F.struct(F.lit(0).cast("long").alias("at"), F.expr("CAST(array() AS array<array<struct<start: long, end: long, word: string, before: string, after: string>>>)").alias("done"))
        return F.flatten(F.aggregate(blocks, start, step)["done"])

    def paired(s: Column) -> Column:
        gaps, words = s["gaps"], s["words"]
        sides = F.zip_with(F.slice(gaps, 1, F.size(words)), F.slice(gaps, 2, F.size(words)), lambda a, b: F.struct(F.length(a).cast("long").alias("gap"), F.right(a, F.lit(30)).alias("before"), F.left(b, F.lit(1)).alias("after")))
        each = F.zip_with(words, sides, lambda w, x: F.struct(w.alias("word"), F.length(w).cast("long").alias("n"), x["gap"].alias("gap"), x["before"].alias("before"), x["after"].alias("after")))
        return F.when(F.size(words) > 0, bound(each, walk)).otherwise(F.expr("CAST(array() AS array<struct<start: long, end: long, word: string, before: string, after: string>>)"))

    return bound(F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("words")), paired)


def digits(word: Column) -> Column:
    return F.regexp_replace(word, r"[^0-9]", "")


def octets_fit(word: Column) -> Column:
    return word.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?:\D+|$)){4}$")


def passes(kind: str, word: Column) -> Column:
    """The check of a strict match."""
    n = F.length(digits(word))
    return {"email": F.lit(True), "ip": octets_fit(word), "card": n.between(16, 19) & F.call_function("luhn_check", digits(word)), "phone": n.between(8, 15)}[kind]


def joined(spans: Column) -> Column:
    """kind:start:end of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scanned(docs: DataFrame) -> DataFrame:
    """id, doc_id, base and loose: the strict matches that pass, and all matches of the looser patterns."""

    def of(kind: str, pattern: str, checked: bool) -> Column:
        found = F.when(F.col("text").rlike(HINT[kind]), matches(F.col("text"), pattern))
        kept = F.filter(found, lambda s: passes(kind, s["word"])) if checked else found
        named = F.transform(kept, lambda s: F.struct(F.lit(kind).alias("kind"), *(s[c].alias(c) for c in ("start", "end", "word", "before", "after"))))
        return F.coalesce(named, F.expr("CAST(array() AS array<struct<kind: string, start: long, end: long, word: string, before: string, after: string>>)"))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    base, loose = ([of(k, p[k], c) for k in KINDS] for p, c in ((BASE, True), (LOOSE, False)))
    return rows.select(F.monotonically_increasing_id().alias("id"), "doc_id", F.concat(*base).alias("base"), F.concat(*loose).alias("loose"))


def candidates(found: DataFrame) -> DataFrame:
    """One row a candidate: the base spans, and the looser ones that touch none of them nor a longer or earlier looser one."""
    each = found.select("id", F.explode(F.concat(F.transform("base", lambda s: F.struct(F.lit(True).alias("base"), s.alias("s"))), F.transform("loose", lambda s: F.struct(F.lit(False).alias("base"), s.alias("s"))))).alias("c")).select("id", "c.base", "c.s.*")
    order = [F.col("start"), F.col("base").desc(), F.col("end").desc(), F.col("kind")]
    before = Window.partitionBy("id").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    behind = Window.partitionBy("id").orderBy(*order).rowsBetween(1, Window.unboundedFollowing)
    of_base = lambda c: F.when(F.col("base"), F.col(c))
    free = F.coalesce(F.max(of_base("end")).over(before) <= F.col("start"), F.lit(True)) & F.coalesce(F.min(of_base("start")).over(behind) >= F.col("end"), F.lit(True))
    each = each.withColumn("free", free).where("base or free").drop("free")
    apart = F.coalesce(F.max("end").over(before) <= F.col("start"), F.lit(True))
    return each.withColumn("apart", apart).where("base or apart").drop("apart")


def votes(spans: DataFrame) -> DataFrame:
    """spans with a vote of each labeler, 1, -1 or 0, and the features. A span of none of the kinds gets no votes."""
    word, n = F.col("word"), F.length(digits(F.col("word")))
    by_kind = lambda **of: F.coalesce(*(F.when(F.col("kind") == k, c) for k, c in of.items()), F.lit(0)).cast("int")
    sign = lambda c: F.when(c, 1).otherwise(-1)
    strict = reduce(lambda a, b: a | b, [(F.col("kind") == k) & word.rlike(rf"^(?:{p})$") for k, p in BASE.items()])
    checked = F.coalesce(*(F.when(F.col("kind") == k, passes(k, word)) for k in KINDS), F.lit(False))
    v6 = word.contains(":")
    local = F.regexp_extract(word, r"^([^@\[({<\x20]+)", 1)
    sums = by_kind(
        email=sign((F.length(local) <= 64) & local.rlike(r"^[A-Za-z0-9]") & ~local.rlike(r"\.\.|\.$")), ip=sign(F.when(v6, word.rlike(r"[A-Fa-f]")).otherwise(octets_fit(word))),
        card=sign(F.call_function("luhn_check", digits(word)) & ~digits(word).rlike(r"^(.)\1+$")), phone=F.when(~n.between(8, 15), -1).when(word.rlike(CODED), F.when(n.between(10, 13), 1).otherwise(0)).otherwise(F.when(n.between(10, 11), 0).otherwise(-1)),
    )
    gazetteer = by_kind(
        email=sign(word.rlike(DOMAINS)), ip=F.when(v6, 0).when(word.rlike(RESERVED), -1).otherwise(1), card=sign(digits(word).rlike(ISSUERS)),
        phone=F.when(word.rlike(r"^(?:\+|00)"), sign(word.rlike(CALLING))).otherwise(F.when(word.rlike(AREA), 0).otherwise(-1)),
    )
    context = F.when(F.col("before").rlike(OTHER_CUES), -1).when(reduce(lambda a, b: a | b, [(F.col("kind") == k) & F.col("before").rlike(c) for k, c in CUES.items()]), 1).otherwise(0)
    left, right = F.right("before", F.lit(1)), F.col("after")
    edges = F.when(left.rlike(r"[\p{L}\p{N}_=/@#-]") | right.rlike(r"[\p{L}\p{N}_=/@#-]"), -1).otherwise(1)
    shape = F.when(~strict, 0).when(checked, 1).otherwise(-1)
    named = {"shape": shape, "sums": sums, "gazetteer": gazetteer, "context": context, "edges": edges}
    flags = {"strict": strict, "spaced": word.contains(" "), "grouped": word.rlike(r"[.()/-]"), "lettered": word.rlike(r"[A-Za-z]")}
    return spans.withColumns({**{k: c.cast("int") for k, c in named.items()}, **{k: c.cast("int") for k, c in flags.items()}})


def reliabilities(patterns: np.ndarray, counts: np.ndarray, rounds: int = 50, trust: float = 0.8, pseudo: float = 10.0) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """Expectation-maximisation over patterns of votes (rows of 1, -1, 0) that occur counts times: (share of personal data,
    each labeler's share of right votes on it, and on the rest, probability of each pattern). trust and pseudo: what a
    labeler is held to be before its votes are seen, and what weight that has. It starts from the majority of votes."""
    p = 1 / (1 + np.exp(-patterns.sum(axis=1).astype(float)))
    for _ in range(rounds):
        share = (counts @ p + 1) / (counts.sum() + 2)
        right = np.empty((2, patterns.shape[1]))
        for y, weight, vote in ((1, counts * p, 1), (0, counts * (1 - p), -1)):
            right[y] = (weight @ (patterns == vote) + trust * pseudo) / (weight @ (patterns != 0) + pseudo)
        odds = np.log(share / (1 - share)) + (patterns == 1) @ np.log(right[1] / (1 - right[0])) + (patterns == -1) @ np.log((1 - right[1]) / right[0])
        p = 1 / (1 + np.exp(-odds))
    return float(share), right[1], right[0], p


def logistic(x: np.ndarray, p: np.ndarray, counts: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Weights of a logistic classifier of rows x (each counts times) towards the probabilities p, by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        s = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (counts * (p - s)) - ridge * w
        w = w + np.linalg.solve((x * (counts * s * (1 - s))[:, None]).T @ x + ridge * np.eye(len(w)), grad)
    return w


def _inputs(rows: list) -> np.ndarray:
    """The classifier's inputs: one, each vote for, each vote against, the features."""
    v = np.array([[r[k] for k in LABELERS] for r in rows], float).reshape(len(rows), len(LABELERS))
    f = np.array([[r[k] for k in FEATURES] for r in rows], float).reshape(len(rows), len(FEATURES))
    return np.hstack([np.ones((len(rows), 1)), v > 0, v < 0, f])


def fitted(voted: DataFrame) -> dict[str, list[float]]:
    """Weights a kind, from the counts of (kind, votes, features)."""
    rows = voted.groupBy("kind", *LABELERS, *FEATURES).agg(F.count("*").alias("times")).orderBy("kind", *LABELERS, *FEATURES).collect()
    out = {}
    for kind in KINDS:
        own = [r for r in rows if r["kind"] == kind]
        if own:
            counts = np.array([r["times"] for r in own], float)
            p = reliabilities(np.array([[r[k] for k in LABELERS] for r in own]), counts)[3]
            out[kind] = logistic(_inputs(own), p, counts).tolist()
    return out


def private_spans(docs: DataFrame, least: float = 0.9) -> DataFrame:
    """One row a row of docs: doc_id, base and added, arrays of (kind, start, end, word) in order of kind and start.

    docs needs doc_id and text; other columns are ignored; a null text is empty. Rows that repeat, or have no doc_id,
    are judged each by itself. start and end are code points, end exclusive. An added span touches no base span. A table
    without candidates, or an empty one, adds none.
    """
    found = staged(scanned(docs), "found")
    voted = staged(votes(candidates(found)).select("id", "base", "kind", "start", "end", "word", *LABELERS, *FEATURES), "voted")
    weights = fitted(voted)
    inputs = [F.lit(1.0), *((F.col(k) > 0).cast("double") for k in LABELERS), *((F.col(k) < 0).cast("double") for k in LABELERS), *(F.col(k).cast("double") for k in FEATURES)]
    raw = [F.when(F.col("kind") == k, reduce(lambda a, b: a + b, [x * F.lit(v) for x, v in zip(inputs, w, strict=True)])) for k, w in weights.items()]
    score = 1 / (1 + F.exp(-F.coalesce(*raw, F.lit(-30.0))))
    place = reduce(lambda c, k: c.when(F.col("kind") == k, KINDS.index(k)), KINDS[1:], F.when(F.col("kind") == KINDS[0], 0))
    more = voted.where(~F.col("base")).where(score >= least).groupBy("id").agg(F.array_sort(F.collect_list(F.struct(place.alias("place"), "start", "end", "kind", "word"))).alias("more"))
    cut = lambda a: F.transform(a, lambda s: F.struct(*(s[c].alias(c) for c in ("kind", "start", "end", "word"))))
    empty = F.expr("CAST(array() AS array<struct<kind: string, start: long, end: long, word: string>>)")
    return found.select("id", "doc_id", cut("base").alias("base")).join(more, "id", "left").select("doc_id", "base", F.coalesce(cut("more"), empty).alias("added"))


def private_query(docs: DataFrame) -> DataFrame:
    """The query's columns, from the spans of docs."""
    of = lambda spans, kind: F.filter(spans, lambda s: s["kind"] == kind)
    by_start = lambda kind: F.array_sort(F.concat(of("base", kind), of("added", kind)), lambda a, b: (a["start"] - b["start"]).cast("int"))
    every = F.when(F.size("added") == 0, F.col("base")).otherwise(F.concat(*(by_start(k) for k in KINDS)))
    counts = [F.size(of("base", k)).cast("long").alias(f"n_{k}") for k in KINDS]
    return private_spans(docs).select("doc_id", *counts, F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), joined(every).alias("spans"))
