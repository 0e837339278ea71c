"""Rules against plain restatements of them."""

import random

from pyspark.sql import functions as F

from ragset.functions.text import keyed
from ragset.operators.chunking import backfill_artifact, char_windows
from ragset.operators.dedup import communities, leader_clusters, similar_pairs
from ragset.operators.html import html_to_markdown
from ragset.operators.metrics import necessity, visual_dependency
from ragset.operators.replies import claim_verdicts, keyword_spans, misleading_visual, parse_keyword_map, relevant, search_strings, verified
from ragset.sources.shared import written


def test_windows_are_the_loop_s(spark):
    texts = ["", "a", "x" * 10, "y" * 11, "z" * 19, "é" * 100]
    got = char_windows(spark.createDataFrame(list(enumerate(texts)), "id int, text string"), 10, 3).orderBy("id", "w").collect()
    want = []
    for i, t in enumerate(texts):
        at = 0
        while t:
            want.append((i, t[at : at + 10]))
            if at + 10 >= len(t):
                break
            at += 7
    assert [(r.id, r.content) for r in got] == want


def test_keyed_replies(spark):
    rows = [("<|#|>START<|#|>Status<|#|>A<|#|>status<|#|>B<|#|>END<|#|>x",), ("Status: old style\nReason: r",), ("nothing",), (None,), ("<|#|>Status",)]
    d = spark.createDataFrame(rows, "r string").select(keyed(F.col("r"), "Status").alias("first"), keyed(F.col("r"), "Status", last=True).alias("last")).collect()
    assert [tuple(x) for x in d] == [("A", "B"), ("old style", "old style"), (None, None), (None, None), (None, None)]


def test_artifacts(spark):
    rows = [("a ![x](1.png) b ![](2.png)", "None"), ("plain", ""), ("![x](1.png)", "kept"), ("plain", None)]
    d = spark.createDataFrame(rows, "c string, a string").select(backfill_artifact(F.col("c"), F.col("a")).alias("x")).collect()
    assert [r.x for r in d] == ["![x](1.png) ![](2.png)", "None", "kept", "None"]


def test_search_strings(spark):
    rows = [("'a' | none | \"b\"|c|d|e|f", None), ("None", "see figure 3, Formula B.2 and Section 4"), (None, None)]
    d = spark.createDataFrame(rows, "r string, e string").select(search_strings(F.col("r"), F.col("e")).alias("x")).collect()
    assert [r.x for r in d] == [["a", "b", "c", "d", "e"], ["figure", "Formula"], []]


def test_keyword_spans(spark):
    texts = [(0, "aaa The then"), (1, "no hits"), (2, ""), (3, "thethe"), (4, "😀 THE été é then" * 50)]
    words = ["aa", "the", "then", "hen", "É", "é then"]
    df, k = spark.createDataFrame([*texts, (5, None), (None, "the")], "id int, t string").repartition(2), spark.createDataFrame([(w,) for w in [*words, "", None, "THE"]], "keyword string")
    got = keyword_spans(df, "id", "t", k).collect()
    parts = keyword_spans(df, "id", "t", k, most=4).collect()  # several automata
    assert sorted(map(repr, got)) == sorted(map(repr, parts)) and len([r for r in got if r.id is None]) == 1
    assert keyword_spans(df, "id", "t", k.limit(0)).count() == 0
    got, words = [r for r in got if r.id is not None], [w.lower() for w in words]
    want = set()
    for i, t in texts:
        hits = sorted((p, p + len(w)) for w in words for p in range(len(t)) if t.lower().startswith(w, p))
        spans: list[list[int]] = []
        for a, b in hits:
            if spans and a < spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], b)
            else:
                spans.append([a, b])
        want |= {(i, a, b) for a, b in spans}
    assert {tuple(r) for r in got} == want


def test_communities_and_leaders_are_the_greedy_ones(spark):
    rng = random.Random(3)
    n = 40
    edges = sorted({tuple(sorted(rng.sample(range(n), 2))) for _ in range(60)})
    ids = spark.range(n).select("id")
    pairs = spark.createDataFrame(edges, "a long, b long")
    near = {i: {i} for i in range(n)}
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    best = {i: max(near[i], key=lambda j: (len(near[j]), -j)) for i in range(n)}
    assert {r.id: r.community for r in communities(ids, pairs).collect()} == best
    leader = {}
    for i in range(n):
        if i not in leader:
            leader[i] = i
            for j in sorted(near[i]):
                if j > i and j not in leader:
                    leader[j] = i
    assert {r.id: r.leader for r in leader_clusters(ids, pairs, written).collect()} == leader


def test_similar_pairs(spark):
    v = [(i, [float(x) for x in w]) for i, w in enumerate([(1, 0), (0.8, 0.6), (0, 1), (1, 0), (-1, 0)])]
    got = {(r.a, r.b) for r in similar_pairs(spark.createDataFrame(v, "id long, v array<double>"), 0.6).collect()}
    assert got == {(0, 1), (0, 3), (1, 2), (1, 3)}
    assert similar_pairs(spark.createDataFrame([], "id long, v array<double>"), 0.6).collect() == []


def test_markdown(spark):
    pages = [
        "<head><title>t</title></head><h2>A  b</h2><p>x <b>y</b></p><ul><li>one<li>two</ul><table><tr><th>1</th><th>2</th></tr><tr><td>3</td><td>4</td></tr></table><img src='i.png' alt='a'>", None, "", "plain &amp; <i>simple</i> 1 < 2",
        "<p>see <a class=x href=\"u/v?a=1\">the <b>page</b></a></p><script>if (a<b) {}</script><!-- no --><img alt='' src='k.png'><img src='only.png'><h1></h1><li></li><tr></tr>", "<DIV>Up<BR>per</DIV><style>p{}</style>&lt;tag&gt; &eacute;&nbsp;x",
    ]
    got = html_to_markdown(spark.createDataFrame(list(enumerate(pages)), "k int, h string"), "k", "h").orderBy("k").collect()
    assert [r.markdown for r in got] == [
        "## A b\n\nx y\n\n- one\n\n- two\n\n| 1 | 2 |\n|---|---|\n| 3 | 4 |\n\n![a](i.png)", "", "", "plain & simple 1 < 2", "see [the page](u/v?a=1)\n\n![](k.png) ![](only.png)", "Up\n\nper\n\n<tag> &eacute; x",
    ]


def test_any_page_gives_text(spark):
    rng = random.Random(9)
    parts = ["<", ">", "</", "<p>", "<a href='", "'>", "</a>", "<img ", "src='x'", "alt=\"", "\"", "&amp;", "&", "|", "\n", "<table><tr><td>", "é😀", "<!--", "-->", "word ", "<h3>", "$1", "\\"]
    pages = [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(40)))) for i in range(300)]
    got = html_to_markdown(spark.createDataFrame(pages, "k int, h string"), "k", "h").collect()
    assert len(got) == 300 and all(isinstance(r.markdown, str) and "\x01" not in r.markdown for r in got)


def test_overlaps():
    from ragset.operators.chunking import find_overlap

    tail = "".join(chr(97 + i % 26) + str(i) for i in range(60))
    assert find_overlap("start " + tail[:100], tail[:100] + " goes on", 200) == 100
    assert find_overlap("nothing alike here, nothing at all to be seen anywhere near", "other", 200) == 0
    a = "one two three four five six seven eight nine ten eleven twelve"
    b = a.replace(" ", "  ") + " rest"
    assert b[find_overlap(a, b, 60) :].strip() == "rest"
    assert find_overlap("", "x") == 0


def test_every_chunk_is_embedded(spark):
    from ragset.jobs.metrics import e1_embed_chunks
    from ragset.sources.tables import chunks

    data = "/root/testdata/sf0.001"
    got = e1_embed_chunks(spark, data).collect()
    assert sorted((r.file_name, r.chunk_id) for r in got) == sorted(tuple(r) for r in chunks(spark, data).select("file_name", "chunk_id").collect())
    assert {r.norm for r in got} <= {0.0, 1.0} and len({r.dim for r in got}) == 1


def test_gates_read_the_status(spark):
    good = "QUESTION_CORRECT, ANSWER_CORRECT, REQUIRES_CONTENT"
    rows = [(f"<|#|>START<|#|>Status<|#|>{good}<|#|>Explanation<|#|>not ANSWER_INCORRECT<|#|>END<|#|>", True), (f"<|#|>Status<|#|>{good}, CAN_ANSWER_WITHOUT_CONTENT<|#|>", False), (good.lower(), True), (None, False), ("", False), ("<|#|>Status<|#|>QUESTION_CORRECT<|#|>Explanation<|#|>" + good, False)]
    d = spark.createDataFrame(rows, "r string, want boolean")
    assert all(r.got == r.want for r in d.withColumn("got", verified(F.col("r"))).collect())
    figure = verified(F.col("r"), F.lit("What is shown in the figure?"), F.lit("A tree."), F.lit(True))
    assert not d.limit(1).select(figure.alias("x")).first().x
    rows = [("<|#|>Status<|#|>RELEVANT<|#|>Explanation<|#|>NOT_RELEVANT to x", True), ("not_relevant", False), ("Relevant", True), (None, False)]
    assert all(r.got == r.want for r in spark.createDataFrame(rows, "r string, want boolean").withColumn("got", relevant(F.col("r"))).collect())


def test_misleading_visuals(spark):
    rows = [("What is graph theory?", "Maths.", False, False), ("What does the figure show, based on the Diagram?", "The axis is time.", True, False), ("According to the chart, who?", "He.", True, True), ("As depicted in the image, who?", "At the top of it.", False, True)]
    d = spark.createDataFrame(rows, "q string, a string, i boolean, want boolean").withColumn("got", misleading_visual(F.col("q"), F.col("a"), F.col("i")))
    assert [(r.q, r.got) for r in d.collect()] == [(r[0], r[3]) for r in rows]


def test_judges_replies(spark):
    rows = [("MATCH: NO, yes only in part", 0.9, 0.0), ("match: yes", 0.0, 0.0), ("MATCH: PARTIAL", 0.5, 0.0), ("I CANNOT_ANSWER", 1.0, 0.0), ("ERROR: MATCH: YES", 0.5, 0.0), (None, 0.9, 0.0), ("VISUAL_ESSENTIAL.", 0.9, 1.0), ("visual_helpful", 0.9, 0.5)]
    d = spark.createDataFrame([(r[0],) for r in rows], "r string").select("r", necessity(F.col("r")).alias("n"), visual_dependency(F.col("r")).alias("v")).collect()
    assert [tuple(x) for x in d] == rows


def test_repeated_labels(spark):
    d = spark.createDataFrame([("Chunk 1: [A, B], Chunk 2: [C], Chunk 1: [D]",)], "r string").select(parse_keyword_map(F.col("r")).alias("m")).first().m
    assert d == {"chunk_1": ["D"], "chunk_2": ["C"]}
    r = spark.createDataFrame([(1, "claim_1: supported\nCLAIM_1: NOT_SUPPORTED\nsupported\nnot supported", 5)], "k int, r string, n int")
    assert {x.i: x.supported for x in claim_verdicts(r, "k", "r", "n").collect()} == {1: True, 2: False, 3: True, 4: False, 5: False}


def test_headers_of_generated_questions(spark):
    from ragset.operators.replies import parse_generated_qa

    m = "<|#|>"
    head = f"Chunk Count: 3\nKeywords per Chunk: <Chunk 1: [a, b c], Chunk 2: [d]>\nRelated Keywords: <[a] to [d] via x question>\n{m}QA_GENERATION{m}{m}Question{m}q?{m}Answer{m}a"
    rows = [(0, head), (1, f"{m}QA_GENERATION{m}{m}Question{m}p{m}Answer{m}b"), (2, "free text"), (3, None)]
    got = {r.i: (r.question, r.answer, r.chunk_count, r.keywords_per_chunk, r.related_keywords) for r in parse_generated_qa(spark.createDataFrame(rows, "i int, reply string")).collect()}
    assert got[0] == ("q?", "a", 3, {"chunk_1": ["a", "b c"], "chunk_2": ["d"]}, "[a] to [d] via x question")
    assert got[1][:3] == ("p", "b", None) and got[1][4] is None and got[2][:3] == ("free text", "", None)


def test_listed_documents(spark):
    from ragset.sources.files import format_counts, pick_documents

    files = spark.createDataFrame([("d/b.PDF", 5), ("d/a.html", 5), ("x.docx", 1), ("y/c.htm", None), ("done.pdf", 2), (None, 3)], "path string, length long")
    done = spark.createDataFrame([("done",), ("done",)], "file_name string")
    assert [r.file_name for r in pick_documents(files, done).collect()] == ["c", "a", "b"] and [r.file_name for r in pick_documents(files, most=2).collect()] == ["c", "done"]
    assert {(r.format, r.files, r.bytes) for r in format_counts(files).collect()} == {("pdf", 2, 7), ("html", 1, 5), ("htm", 1, 0), ("other", 2, 4)}
