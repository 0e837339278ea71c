"""Streams, seams, targets, judgements, eval rows and boxes against plain restatements."""

import os
import random
import shutil
import sys

import pandas as pd
import pytest
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import functions as F

from ragset.operators import contexts as X
from ragset.operators import datasets as DS
from ragset.operators import evaluation as V
from ragset.operators import metrics as E
from ragset.operators import replies as P
from ragset.operators import retrieval as R
from ragset.operators import seams
from ragset.operators import topics as T
from ragset.sources.shared import written
from ragset.streaming.ingest import DOCUMENT, ingest_windows

register_pickle_by_value(sys.modules[__name__])
RNG = random.Random(4)
M = "<|#|>"


def drop(spark, folder, name, ids):
    """A file of documents in folder; text and source follow from the id, but for a row without one."""
    rows = [(i, f"text of {i} " * (i % 5 + 1) if i is not None else "no id", "en", f"s{(i or 0) % 3}", 1) for i in ids]
    part = str(folder / f"_{name}")
    spark.createDataFrame(rows, DOCUMENT).coalesce(1).write.parquet(part)
    os.makedirs(folder / "in", exist_ok=True)
    shutil.move(next(str(p) for p in (folder / f"_{name}").glob("part-*.parquet")), str(folder / "in" / f"{name}.parquet"))


def test_each_document_is_ingested_once(spark, tmp_path):
    def run():
        return ingest_windows(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/checkpoint", 10, 2)

    drop(spark, tmp_path, "a", [1, 2, 3, 3, None])
    first = sorted((r.doc_id or 0, r.w) for r in run().collect())
    assert {i for i, _ in first} == {0, 1, 2, 3} and len(first) == len(set(first))
    drop(spark, tmp_path, "b", [2, 3, 4, None, 5])  # overlaps the first file
    both = sorted((r.doc_id or 0, r.w) for r in run().collect())
    assert {i for i, _ in both} == {0, 1, 2, 3, 4, 5} and len(both) == len(set(both)) and set(first) <= set(both)
    assert sorted((r.doc_id or 0, r.w) for r in run().collect()) == both  # nothing new
    # a batch whose end was not noted is run again, and replaces what it had written
    for name in ("1", ".1.crc"):
        (tmp_path / "checkpoint" / "commits" / name).unlink(missing_ok=True)
    drop(spark, tmp_path, "c", [5, 6])
    again = sorted((r.doc_id or 0, r.w) for r in run().collect())
    assert len(again) == len(set(again)) and {i for i, _ in again} == {0, 1, 2, 3, 4, 5, 6} and set(both) <= set(again)


@pytest.mark.parametrize("good, target", [(1, 20), (2, 20), (3, 7), (1, 500)])
def test_a_target_stops_the_requests(spark, tmp_path, good, target):
    """Every good-th chunk gives two pairs. Requests are counted by files that the model writes."""
    n, log = 200, str(tmp_path / "asked")
    os.makedirs(log)
    chunks = spark.createDataFrame([(i, f"chunk {i}") for i in range(n)], "chunk_id long, content string").repartition(3)

    def generate(text):
        i = int(text.split()[1])
        open(f"{log}/{i}", "w").close()
        return f"Question{M}q{i}{M}Answer{M}a{M}NEXT{M}Question{M}r{i}{M}Answer{M}b" if i % good == 0 else f"Question{M}bad{i}{M}Answer{M}a"

    kinds = lambda t: F.array(F.when(t["question"].startswith("bad"), "text").otherwise("multimodal"))
    taken, aside, stats = DS.generate_to_target(chunks, F.col("content"), generate, kinds, "multimodal", target, "chunk_id")
    order = [r.chunk_id for r in chunks.orderBy(DS.seeded_order("chunk_id"), "chunk_id").collect()]
    asked, budget, s = len(os.listdir(log)), -(-11 * target // 10), stats.first()
    assert {int(x) for x in os.listdir(log)} == set(order[:asked]) and asked <= budget and s.requests == asked
    want = [f"{k}{i}" for i in order[:asked] if i % good == 0 for k in "qr"][:target]
    assert sorted(r.question for r in taken.collect()) == sorted(want) and s.generated == len(want)
    assert sorted(r.question for r in aside.collect()) == sorted(f"bad{i}" for i in order[:asked] if i % good)
    assert s.target_reached == (len(want) >= target) and s.corpus_exhausted == (len(want) < target)
    assert asked < n or target == 500


def test_an_empty_corpus_gives_no_pairs(spark):
    none = spark.createDataFrame([], "chunk_id long, content string")
    taken, aside, stats = DS.generate_to_target(none, F.col("content"), str, lambda t: F.array(F.lit("text")), "text", 5, "chunk_id")
    assert taken.count() == aside.count() == 0 and stats.first().corpus_exhausted and stats.first().requests == 0


def test_figures_need_an_image(spark):
    rows = [(1, "q", "a", "bad", True), (2, "q", "a", "bad", False), (3, "q", "a", "bad", None)]
    failed = spark.createDataFrame(rows, "id long, question string, answer string, verification string, has_image boolean")
    passed, lost = DS.correction_rounds(failed, lambda t: f"{M}Question{M}As shown in the figure, what?{M}Answer{M}The figure shows it.", lambda t: f"Status: {', '.join(P.GOOD)}", written)
    assert [r.id for r in passed.collect()] == [1] and sorted(r.id for r in lost.collect()) == [2, 3]


def test_judgements(spark):
    rows = [
        (f"{M}START{M}Status{M}INCOMPLETE{M}Query{M}a|b{M}Explanation{M}x{M}Status{M}complete{M}END{M}", "COMPLETE", "a|b", "x"), ("Status: INCOMPLETE, Query: wind|rain, Explanation: cut\n\nmore", "INCOMPLETE", "wind|rain", "cut"),
        ("status: complete", "COMPLETE", "", ""), (f"{M}Status{M}INCOMPLETE{M}Query{M}None{M}Explanation{M}Table 2", "INCOMPLETE", "", "Table 2"), ("nothing at all", None, "", ""), ("Status: INCOMPLETE\nQuery: one|two\nExplanation: why", "INCOMPLETE", "one|two", "why"), (None, None, None, ""),
    ]
    got = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "i int, r string").select("i", X.judgement(F.col("r")).alias("j")).orderBy("i").collect()
    assert [(g.j.status, g.j.query or "", g.j.explanation) for g in got] == [(r[1], r[2] or "", r[3]) for r in rows]


def test_context_rows(spark):
    statuses = spark.createDataFrame([(1, "INCOMPLETE_MAX_DEPTH", 2, 1, 2), (2, "COMPLETE", 1, 0, 0)], "seed long, status string, depth int, hop_count int, max_breadth int")
    contexts = spark.createDataFrame([(1, 1, 7, "later"), (1, 0, 9, "first"), (2, 0, 5, None)], "seed long, n int, item_id long, content string")
    logs = spark.createDataFrame([(1, 2, ["c"]), (1, 1, ["b", "a"])], "seed long, depth int, search_strings array<string>")
    got = {r.seed: (r.termination_reason, r.context, r.chunks_added, r.search_history) for r in X.context_rows(statuses, contexts, logs).collect()}
    assert got == {1: ("Maximum depth of 2 iterations reached", "first\n\nlater", [9, 7], ["b", "a", "c"]), 2: ("Context verified as complete", "", [5], [])}


def test_results_are_flat(spark):
    df = spark.createDataFrame([(1, None, [1], {"a": 1}, b"x", True)], "qa_id long, difficulty string, list array<int>, m map<string, int>, raw binary, ok boolean")
    got = DS.flatten_results(df, {"difficulty": "0", "list": "none", "num_hops": 0})
    assert got.columns == ["qa_id", "difficulty", "ok", "list", "num_hops"] and tuple(got.first()) == (1, "0", True, "none", 0)


def test_failing_encoder_gives_zeros(spark):
    def encode(texts: pd.Series):
        if any(t is None or "bad" in t for t in texts):
            raise ValueError("no")
        return [[float(len(t)), 1.0] for t in texts]

    df = spark.createDataFrame([(0, "four"), (1, "bad one"), (2, None), (3, "x")], "i int, t string").coalesce(1)
    assert [r.v for r in seams.embed(df, "t", encode=encode, dim=2).orderBy("i").collect()] == [[4.0, 1.0], [0.0, 0.0], [0.0, 0.0], [1.0, 1.0]]


def test_scores_and_their_best(spark):
    rows = [(1, i, "the red fox", c) for i, c in enumerate(["red fox", "THE Red fox ran", "fox", "", None])] + [(2, 9, "", "x")]
    df = spark.createDataFrame(rows, "query_id long, item_id long, q string, c string")
    got = [(r.query_id, r.item_id, round(r.score, 4), r["rank"]) for r in seams.score(df, "q", "c", top=2).orderBy("query_id", "rank").collect()]
    assert got == [(1, 1, 1.0, 1), (1, 0, 0.6667, 2), (2, 9, 0.0, 1)]
    own = seams.score(df, "q", "c", scorer=lambda q, c: c.fillna("").str.len().astype(float), top=1)
    assert {(r.query_id, r.item_id, r.score) for r in own.collect()} == {(1, 1, 15.0), (2, 9, 1.0)}


def test_issues_carry_their_claims(spark):
    scores = spark.createDataFrame([(1, 0.5, 0.5, "x" * 150), (2, 0.8, 0.7, "ok"), (3, 0.1, 0.9, None)], "qa_id long, faithfulness double, relevancy double, question string")
    claims = spark.createDataFrame([(1, 2, "late", False), (1, 0, "early", False), (1, 1, "fine", True), (2, 0, "no", False)], "qa_id long, i long, claim string, supported boolean")
    got = sorted((r.qa_id, r.issue, r.score, len(r.question or ""), r.unsupported_claims) for r in E.flag_issues(scores, claims).collect())
    assert got == [(1, "LOW_FAITHFULNESS", 0.5, 100, ["early", "late"]), (1, "LOW_RELEVANCY", 0.5, 100, None), (3, "LOW_FAITHFULNESS", 0.1, 0, [])]


def test_eval_rows_fall_back(spark):
    chunk = "array<struct<content: string, image_path: string>>"
    rows = [(1, "q", "a", [("c1", "null"), ("", "p.png"), (None, None)], "f", "o"), (2, "q", None, [], "f", "o"), (3, None, "a", None, None, "o"), (4, "q", "a", None, None, None)]
    df = spark.createDataFrame(rows, f"qa_id long, question string, answer string, context_chunks {chunk}, final_context string, original_chunk string").withColumn("domain", F.lit("d"))
    got = {r.qa_id: (r.question, r.ground_truth, r.contexts, r.image_contexts, r.type, r.metadata.domain) for r in V.to_eval_rows(df).collect()}
    assert got == {1: ("q", "a", ["c1"], ["p.png"], "visual", "d"), 2: ("q", "", ["f"], [], "text", "d"), 3: ("", "a", ["o"], [], "text", "d"), 4: ("q", "a", [""], [], "text", "d")}


def test_pictures_in_tables_of_their_page(spark):
    box = lambda big: (x := RNG.uniform(-50, 400), y := RNG.uniform(-50, 400), x + RNG.uniform(0, big), y + RNG.uniform(0, big))
    pictures = [(i, RNG.randrange(2), RNG.randrange(2), *box(30)) for i in range(300)] + [(300, 0, 0, None, 1.0, 2.0, 3.0)]
    tables = [(RNG.randrange(2), RNG.randrange(2), *box(200)) for _ in range(25)] + [(0, 0, 5.0, 5.0, 1.0, 9.0)]
    p = spark.createDataFrame(pictures, "id long, doc int, page_no int, l double, b double, r double, t double")
    t = spark.createDataFrame(tables, "doc int, page_no int, l double, b double, r double, t double")
    inside = lambda x, o: x[1:3] == o[:2] and None not in x and o[2] <= x[3] and o[3] <= x[4] and x[5] <= o[4] and x[6] <= o[5]
    want = {x[0] for x in pictures if any(inside(x, o) for o in tables)}
    for cell in (7.0, 100.0):
        got = [r.id for r in T.pictures_in_tables(p, t, cell).collect()]
        assert len(got) == len(set(got)) and set(got) == want and 0 < len(want) < 300


def test_far_rows_have_no_topic(spark):
    v = [(i, [RNG.gauss(5 * (i % 3), 0.1), RNG.gauss(-3 * (i % 3), 0.1), RNG.gauss(0, 0.1)]) for i in range(300)]
    v += [(300 + k, [5.0 + 20 * k, 90.0, 90.0]) for k in range(2)]
    df = spark.createDataFrame(v, "vec_id long, v array<double>")
    plain = {r.vec_id: r for r in T.assign_topics(df, 3, written, dims=2).collect()}
    got = {r.vec_id: r.topic for r in T.assign_topics(df, 3, written, dims=2, outliers=0.9).collect()}
    for topic in {r.topic for r in plain.values()}:
        own = sorted((r.far, i) for i, r in plain.items() if r.topic == topic)
        edge = own[max(0, -(-len(own) * 9 // 10) - 1)][0]
        assert all(got[i] == (-1 if far > edge else topic) for far, i in own)
    assert sum(t == -1 for t in got.values()) > 10


def test_rerank_chain(spark):
    q = spark.createDataFrame([(1, [1.0, 0.0])], "query_id long, v array<double>")
    items = spark.createDataFrame([(i, [1.0 - i / 10, i / 10], i % 3) for i in range(8)], "item_id long, v array<double>, bonus int")
    got = [(r.item_id, r.score, r["rank"]) for r in R.retrieve_rerank(q, items, F.col("bonus").cast("double"), 6, 4, 3).collect()]
    assert got == [(2, 2.0, 1), (5, 2.0, 2), (1, 1.0, 3)]
    cos = R.cosine_rerank(spark.createDataFrame([(1, 0), (1, 7), (1, 99)], "query_id long, item_id long"), q, items, 5).collect()
    assert [(r.item_id, r["rank"]) for r in cos] == [(0, 1), (7, 2)] and abs(cos[1].score - 0.3 / (0.09 + 0.49) ** 0.5) < 1e-12
    both, lost = R.align_chunks(spark.createDataFrame([("f", "1"), ("f", "2")], "file_name string, chunk_id string"), spark.createDataFrame([("f", "2", "x"), ("g", "1", "y")], "file_name string, chunk_id string, content string"))
    assert [tuple(r) for r in both.collect()] == [("f", "2", "x")] and [tuple(r) for r in lost.collect()] == [("f", "1")]


def test_cache_table_touches_its_buckets_alone(spark, tmp_path):
    path, files = str(tmp_path / "cache"), lambda: {p: os.stat(p).st_mtime_ns for p in (str(x) for x in (tmp_path / "cache").rglob("*.parquet"))}
    row = lambda k, r, v: (f"k{k}", r, v)
    table = lambda rows: spark.createDataFrame(rows, "cache_key string, response string, version int")
    assert DS.cache_store(table([]), path) == 0
    asked = spark.createDataFrame([("k1",), ("k1",), ("k99",), (None,)], "cache_key string")
    looked, missing = DS.cache_find(asked, path, "cache_key string, response string, version int")
    assert {r.response for r in looked.collect()} == {None} and missing.count() == 3
    DS.cache_store(table([row(i, f"r{i}", 1) for i in range(40)] + [row(1, "", 9), row(2, "z", 1), row(2, "a", 2)]), path, buckets=16)
    before = files()
    assert DS.cache_store(table([row(3, "new", 2), row(4, "old", 0), row(5, "", 5)]), path, buckets=16) <= 2
    after = files()
    buckets = lambda t: {p.split("bucket=")[1].split("/")[0] for p in t}
    changed = buckets(set(before.items()) ^ set(after.items()) and {p for p, _ in set(before.items()) ^ set(after.items())})
    assert 0 < len(changed) <= 2 and len(buckets(after)) > 8
    want = {f"k{i}": f"r{i}" for i in range(40)} | {"k2": "a", "k3": "new"}
    stored = spark.read.parquet(path)
    assert sorted((r.cache_key, r.response) for r in stored.collect()) == sorted(want.items())
    for sent in (200_000, 1):
        looked, missing = DS.cache_find(asked, path, "cache_key string, response string, version int", buckets=16, sent=sent)
        assert sorted((r.cache_key or "", r.response) for r in looked.collect()) == [("", None), ("k1", "r1"), ("k1", "r1"), ("k99", None)] and sorted(r.cache_key or "" for r in missing.collect()) == ["", "k99"]


def test_keywords_are_diverse(spark):
    words = ["river", "rivers", "riven", "stone", "a", "tone", "mill", "mills"]
    rows = [(t, w, 1.0 / (i + 1), i + 1) for t in ("x", "y") for i, w in enumerate(words[: 8 if t == "x" else 3])] + [("z", "only", 0.0, 1)]
    df = spark.createDataFrame(rows, "topic string, word string, weight double, rank int").withColumn("v", T.letter_pairs(F.col("word")))
    vec = {(r.topic, r.word): r.v for r in df.collect()}
    want = set()
    for topic in "xyz":
        own, chosen = [r for r in rows if r[0] == topic], []
        top = max(max(r[2] for r in own), 1e-12)
        cos = lambda a, b: sum(x * y for x, y in zip(vec[topic, a], vec[topic, b]))  # noqa: B023, E731
        while len(chosen) < min(5, len(own)):
            left = [r for r in own if r[1] not in chosen]
            best = max(left, key=lambda r: (round(0.5 * r[2] / top - 0.5 * max((cos(r[1], c) for c in chosen), default=0.0), 9), -r[3]))
            chosen.append(best[1])
        want |= {(topic, w, i) for i, w in enumerate(chosen, 1)}
    assert {tuple(r) for r in T.diversify_keywords(df, 5).collect()} == want
    assert T.diversify_keywords(df.limit(0), 5).count() == 0


def test_stitched_windows_are_the_chain_s(spark):
    from ragset.operators.chunking import find_overlap, stitch_windows

    rows, want = [], []
    for f in range(30):
        text = "".join(RNG.choice("abc d\n") for _ in range(RNG.randrange(150, 900)))
        cuts = [text[a : a + 250] for a in range(0, max(1, len(text) - 100), 150)]
        status = ["INCOMPLETE" if RNG.random() < 0.6 else "COMPLETE" for _ in cuts]
        open_ = False
        for w, (part, st) in enumerate(zip(cuts, status)):
            rows.append((f"f{f}", w, part, st))
            if open_:
                name, first, n, so_far = want[-1]
                end = find_overlap(so_far, part, 200)
                want[-1] = (name, first, n + 1, so_far + part[end:] if end else so_far + "\n\n" + part)
            else:
                want.append((f"f{f}", w, 1, part))
            open_ = st == "INCOMPLETE"
    df = spark.createDataFrame(rows, "file_name string, w long, content string, status string").repartition(3)
    assert sorted(tuple(r) for r in stitch_windows(df).select("file_name", "w", "n_windows", "content").collect()) == sorted(want)
