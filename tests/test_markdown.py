"""Blocks of markdown against a loop over lines; windows of long texts against the loop."""

import random
import re

from pyspark.sql import functions as F

from ragset.functions.text import letter_words, word_count
from ragset.operators import chunking as C

RNG = random.Random(21)
LINES = [
    "", "", " \t", "# Title", "## Part two", "#no heading", "Intro ........ 1", "Last .... 20", "| a | b |", "|---|---|", "| 1 | ![x](p.png) |", "| not closed", "![img](a/b.png)", "text ![in](l.png) line", "Figure 3.1 - seen", "**Table 2** - sums",
    "Table 2 - sums", "A sentence.", "A line that goes on", "*note*", "ünïcödé 😀", "    code # x",
]


def kind(line):
    for name, pattern in (("heading", r" {0,3}#{1,6}[ \t]"), ("index", r".{1,80}\.{4,} *[0-9]+ *$"), ("row", r"[ \t]*\|.*\|[ \t]*$"), ("figure caption", r"[ \t*_]*(?i:figure|fig\.)[ \t]+[A-Z0-9]"), ("table caption", r"[ \t*_]*(?i:table|tab\.)[ \t]+[A-Z0-9]")):
        if re.match(pattern, line):
            return name
    return "image" if re.search(r"!\[[^\]]*\]\([^)]+\)", line) else "text"


def type_of(block):
    kinds, image = [kind(x) for x in block], any(re.search(r"!\[[^\]]*\]\([^)]+\)", x) for x in block)
    if "index" in [kind(x) for x in block if kind(x) != "heading"] or any(re.match(r".{1,80}\.{4,} *[0-9]+ *$", x) for x in block):
        return "index"
    if "row" in kinds:
        return "table with images" if image else "table"
    if image:
        return "figure" if "figure caption" in kinds else "standalone image"
    return "text"


def blocks(text, least):
    """A loop that keeps the open block and the last line that was not blank."""
    out, last, gap = [], None, False
    for line in (text or "").split("\n"):
        if not line.strip(" \t\r\f\x0b"):
            gap = True
            if out:
                out[-1].append(line)
            continue
        k = kind(line)
        linked = (last, k) in {("table caption", "row"), ("image", "figure caption"), ("index", "index")}
        if last is None or last != "heading" and (k == "heading" or (k == "index") != (last == "index") or gap and not linked):
            out.append([])
        out[-1].append(line)
        last, gap = k, False
    while len(out) > 1 and all(kind(x) == "heading" or not x.strip(" \t\r\f\x0b") for x in out[-1]):
        lone = out.pop()
        out[-1] += lone
    for b in out:
        while not b[-1].strip(" \t\r\f\x0b"):
            b.pop()
    done = []
    for b in out:
        plain = type_of(b) == "text" and kind(b[0]) != "heading"
        if done and least and plain and type_of(done[-1][-1]) == "text" and len("\n".join(done[-1][-1])) < least:
            done[-1].append(b)
        else:
            done.append([b])
    return ["\n\n".join("\n".join(b) for b in group) for group in done]


def records(text, least=0):
    rows, found = [], blocks(text, least)
    for i, content in enumerate(found):
        t = type_of(content.split("\n"))
        marks = " ".join(m[0] for m in re.finditer(r"!\[[^\]]*\]\([^)]+\)", content)) or "None"
        whole = t == "index" or i < len(found) - 1 or re.search(r"[.!?:;…)\]}\"'»”*`|>]$", content)
        rows.append((str(i + 1), t, *(("None", "None") if t == "index" else (content, marks)), "COMPLETE" if whole else "INCOMPLETE"))
    return rows


def test_blocks_are_the_loop_s(spark):
    texts = [None, "", " \n\t\n", "# only\n\n## heads", "x", "\n\nafter\n\n"] + ["\n".join(RNG.choice(LINES) for _ in range(RNG.randrange(1, 14))) for _ in range(250)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").withColumn("status", F.lit("clash")).drop("status")
    for least in (0, 15):
        got = {}
        for r in C.segment_markdown(df, least=least).collect():
            got.setdefault(r.id, []).append((r.chunk_id, r.chunk_type, r.content, r.artifact, r.status))
        for i, text in enumerate(texts):
            assert sorted(got.get(i, []), key=lambda r: int(r[0])) == records(text, least), text
    assert C.segment_markdown(df.limit(0)).count() == 0


def test_many_windows_are_the_loop_s(spark, monkeypatch):
    monkeypatch.setattr(C, "PER_SLICE", 3)
    texts = ["é" * n for n in (0, 1, 9, 10, 11, 17, 18, 29, 30, 31, 32, 33, 100, 500)] + [None, "".join(RNG.choice("aé😀 ") for _ in range(700))]
    got = {}
    for r in C.char_windows(spark.createDataFrame(list(enumerate(texts)), "id int, text string"), 10, 3).collect():
        got.setdefault(r.id, []).append((r.w, r.content, r.n_windows))
    for i, t in enumerate(texts):
        n = 0 if not t else 1 if len(t) <= 10 else 1 + -(-(len(t) - 10) // 7)
        assert sorted(got.get(i, [])) == [(w, t[7 * w : 7 * w + 10], n) for w in range(n)]


def test_words(spark):
    texts = ["", " ", "a", " a", "a ", "\t a\n\nb c \r", "é\xa0x y", None, "Ab1cD éf"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", word_count(F.col("t")).alias("n"), letter_words(F.col("t")).alias("w")).collect()
    for r in rows:
        assert r.n == len(re.findall(r"[^ \t\n\r\f\x0b]+", r.t or "")) and (r.w or []) == re.findall("[a-z]+", (r.t or "").lower())


def test_files_match_by_spans(spark):
    names = [None, "", "a", "ab", "Doc_1", "report_2024_final", "final", "x" * 30] + ["".join(RNG.choice("abc_") for _ in range(RNG.randrange(1, 20))) for _ in range(120)]
    sources = ["DOC_1_ref", "my report_2024_FINAL copy", "xxx", "zzz", "", None] + ["".join(RNG.choice("abcC_") for _ in range(RNG.randrange(1, 24))) for _ in range(120)]
    a = spark.createDataFrame(list(enumerate(sources)), "k int, source string")
    b = spark.createDataFrame([(n,) for n in names], "file_name string")
    want = {}
    for i, s in enumerate(sources):
        hits = sorted(n for n in names if n and s and (n.lower() in s.lower() or s.lower() in n.lower()))
        if hits:
            want[i] = hits[0]
    for q in (3, 8):
        got = C.match_files(a, b, "k", q=q).collect()
        assert len(got) == len(want) and {r.k: r.file_name for r in got} == want
    assert C.match_files(a, b.limit(0), "k").count() == 0
