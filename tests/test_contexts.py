"""Grown contexts, verdicts, links, corrections and claims against plain restatements."""

import sys

import numpy as np
import pandas as pd
import pytest
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import functions as F

from ragset.operators import contexts as C
from ragset.operators import datasets as DS
from ragset.operators import evaluation as V
from ragset.operators.seams import hashed_encoder
from ragset.sources.shared import written

register_pickle_by_value(sys.modules[__name__])

WORDS = ["river bank", "stone bridge", "old mill", "mill pond", "river delta", "bridge toll", "salt road", "", "delta salt"]


def judge(text):
    n = text.count("Chunk ")
    last = text.rsplit(": ", 1)[-1].split()
    if "salt road" in text:
        return "<|#|>START<|#|>Status<|#|>COMPLETE<|#|>Explanation<|#|>done<|#|>END<|#|>"
    if not last or n > 4:
        return "<|#|>START<|#|>Status<|#|>INCOMPLETE<|#|>Query<|#|>None<|#|>Explanation<|#|>nothing<|#|>END<|#|>"
    return f"<|#|>START<|#|>Status<|#|>INCOMPLETE<|#|>Query<|#|>{'|'.join(last)}<|#|>Explanation<|#|>more<|#|>END<|#|>"


def verify(text):
    candidate = text.split("Candidate: ")[1].split("\n")[0]
    word = "HELPFUL" if "r" in candidate else "RELATED" if "mill" in candidate else "junk"
    return f"Status: {word}\nExplanation: about {candidate}"


def expected(mode, depth=2, breadth=5, k=2):
    vec = np.array(hashed_encoder(pd.Series(WORDS)))
    out = {}
    for seed in range(len(WORDS)):
        items, widest, status, d = [seed], 0, C.MAX_DEPTH, 0
        for d in range(1, depth + 1):
            reply = judge("Judge:\n" + "\n---\n".join(f"Chunk {i + 1}: {WORDS[x]}" for i, x in enumerate(items)))
            if "Status<|#|>COMPLETE" in reply:
                status = C.COMPLETE
                break
            said = reply.split("Query<|#|>")[1].split("<|#|>")[0]
            strings = [] if said == "None" else said.split("|")[:breadth]
            if not strings:
                status = C.NO_STRINGS
                break
            widest = max(widest, len(strings))
            new = []
            for q in strings:
                score = vec @ np.array(hashed_encoder(pd.Series([q]))[0])
                for x in sorted(range(len(WORDS)), key=lambda x: (-round(float(score[x]), 12), x))[:k]:
                    good = "r" in WORDS[x] or (mode == "RELATED" and "mill" in WORDS[x])
                    if x not in items and x not in new and good:
                        new.append(x)
            items += new
            if not new:
                status = C.NO_CHUNKS
                break
        out[seed] = (status, d, len(items) - 1, widest, items)
    return out


@pytest.mark.parametrize("mode", ["EXPLANATORY", "RELATED"])
def test_contexts_are_the_loop_s(spark, mode):
    rows = [(i, v, w) for i, (v, w) in enumerate(zip(hashed_encoder(pd.Series(WORDS)), WORDS))]
    items = spark.createDataFrame(rows, "item_id long, v array<double>, content string")
    seeds = items.select(F.col("item_id").alias("seed"), "item_id")
    status, context, logs = C.grow_contexts(seeds, items, judge, verify, written, mode=mode)
    order = {}
    for r in context.orderBy("seed", "n").collect():
        order.setdefault(r.seed, []).append(r.item_id)
    got = {r.seed: (r.status, r.depth, r.hop_count, r.max_breadth, order[r.seed]) for r in status.collect()}
    assert got == expected(mode)
    added = sum(x.accepted for r in logs.collect() for x in r.retrieved)
    assert added == sum(len(v[4]) - 1 for v in got.values())
    assert len({v[0] for v in got.values()}) > 2


def test_verdicts(spark):
    m = "<|#|>"
    rows = [f"{m}START{m}Status{m}helpful{m}Explanation{m}x{m}END{m}", f"{m}Status{m}related{m}", "status: not_helpful", "Status: Explanatory - y", "nothing", None, f"{m}Status{m}odd{m}"]
    d = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, r string").select("i", C.addition_verdict(F.col("r")).alias("v"))
    assert [r.v for r in d.orderBy("i").collect()] == ["EXPLANATORY", "RELATED", "UNRELATED", "EXPLANATORY", "UNRELATED", "UNRELATED", "UNRELATED"]


def test_keyword_links(spark):
    d = spark.createDataFrame([(1, "[a b] to [c] via d ; junk; [x] -> [y] via z w"), (2, None)], "id int, t string")
    got = C.keyword_links(d, "id", "t").orderBy("at").collect()
    assert [(r.id, r.at, r.source, r.target, r.via) for r in got] == [(1, 0, "a b", "c", "d"), (1, 2, "x", "y", "z w")]


def test_corrections(spark):
    rows = [(1, "p", "a", "bad"), (2, "q", "b", "bad"), (3, "none", "c", "bad"), (4, "{answer}", "d", "bad")]
    failed = spark.createDataFrame(rows, "id long, question string, answer string, verification string")
    m, good = "<|#|>", "QUESTION_CORRECT, ANSWER_CORRECT, REQUIRES_CONTENT"

    def correct(text):
        q = text.split("\n")[0][len("Question: ") :]
        return "no" if q == "none" else f"{m}Question{m}{q}+{m}Answer{m}a"

    passed, lost = DS.correction_rounds(failed, correct, lambda t: f"Status: {good}" if t.startswith(("Question: p+", "Question: q++", "Question: {answer}+")) else "Status: QUESTION_INCORRECT", written, 2)
    assert sorted((r.id, r.question, r.correction_attempt) for r in passed.collect()) == [(1, "p+", 1), (2, "q++", 2), (4, "{answer}+", 1)]
    assert [(r.id, r.failure_reason) for r in lost.collect()] == [(3, "Correction produced no valid pairs")]


def test_claims_and_sources(spark):
    reply = "x\nANSWER_CLAIMS:\n- one\n\n-\n  two \nREFERENCE_CLAIMS:\n- r\nREVERSE_QUESTIONS:\n- a?\nb?\nc?\nd?"
    rows = [(0, reply, "q", "a", "r"), (1, "ERROR: x", "q", "a", ""), (2, None, "q", "", None), (3, "nothing", "q", "a", "r")]
    d = spark.createDataFrame(rows, "i int, reply string, question string, answer string, reference string")
    got = {r.i: (r.answer_claims, r.reference_claims, r.reverse_questions) for r in V.parse_claims(d).collect()}
    assert got == {0: (["one", "two"], ["r"], ["a?", "b?", "c?"]), 1: (["a"], [], ["q"]), 2: ([], [], ["q"]), 3: ([], [], [])}
    text = "CLAIM_1: supported\nclaim_2: NOT_SUPPORTED | source: image\nCLAIM_1: NOT_SUPPORTED | SOURCE: BOTH\nCLAIM_11: SUPPORTED | SOURCE: TEXT"
    v = spark.range(1).select(V.sourced_verdicts(F.lit(text), F.lit(3)).alias("v"), V.sourced_verdicts(F.lit(text), F.lit(0)).alias("none")).first()
    assert [tuple(x) for x in v.v] == [(False, "BOTH"), (False, "IMAGE"), (False, "UNKNOWN")] and v.none == []


def test_empty_tables(spark):
    none = spark.createDataFrame([], "file_name string, chunk_id string, chunk_type string, content string, artifact string")
    assert V.domain_coverage(none, none).first().uncovered == 0
    assert DS.corpus_stats(none).first().total == 0
    assert DS.qa_category_stats(none.withColumns({"relevance_score": F.lit("1"), "difficulty_score": F.lit("1")}), F.lit(True), F.lit(None).cast("boolean")).first().multihop_pct is None
    assert V.data_completeness(none.withColumn("n", F.lit(1)), "n", False).where("can_evaluate").count() == 8
