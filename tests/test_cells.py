"""Joins and searches of vectors by cells: the rows of brute force, without meeting what is far."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ragset.operators import cells as C
from ragset.operators import retrieval as R
from ragset.operators import dedup as D
from ragset.operators.dedup import similar_pairs

RNG = np.random.default_rng(8)


def unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def clustered(n=600, groups=30, dims=16, spread=0.05, equal=True):
    v = unit(np.repeat(unit(RNG.normal(size=(groups, dims))), n // groups, axis=0) + spread * RNG.normal(size=(n, dims)))
    if equal:
        v[: n // 3] = v[0]
    return v[RNG.permutation(n)]


def table(spark, v, name="id"):
    return spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], f"{name} long, v array<double>").repartition(3)


@pytest.mark.parametrize("threshold", [0.95, 0.5])
@pytest.mark.parametrize("kind", ["clustered", "even"])
def test_pairs_are_those_of_brute_force(spark, kind, threshold):
    v = clustered() if kind == "clustered" else unit(RNG.normal(size=(300, 8)))
    rows = similar_pairs(table(spark, v), threshold, size=40).collect()
    got = {(r.a, r.b) for r in rows}
    cos = v @ v.T
    i, j = np.nonzero(np.triu(cos >= threshold, 1))
    assert len(got) == len(rows) and got == set(zip(i.tolist(), j.tolist()))


def test_far_tiles_never_meet(spark):
    """Pairs compared at a threshold of 0.95: each row of a pair of tiles with each of its other side."""
    v = clustered(900, 45, spread=0.02, equal=False)
    dealt = C.pairs_within(table(spark, v), float(np.sqrt(2 - 2 * 0.95)), 20)
    sides = dealt.groupBy("x", "y").agg(F.count_if(F.col("side") == 0).alias("p"), F.count_if(F.col("side") == 1).alias("q"))
    compared = sides.agg(F.sum(F.col("p") * F.col("q"))).first()[0]
    assert compared < 0.15 * len(v) ** 2


def nearest(q, x, k):
    out = set()
    for i, v in enumerate(q):
        score = np.round(x @ v, 12)
        out |= {(i, int(j), r) for r, j in enumerate(sorted(range(len(x)), key=lambda j: (-score[j], j))[:k], 1)}
    return out


@pytest.mark.parametrize("kind", ["clustered", "norms", "few"])
def test_search_is_that_of_brute_force(spark, monkeypatch, kind):
    monkeypatch.setattr(R, "QUERIES", 7)
    x = {"clustered": clustered(), "norms": unit(RNG.normal(size=(500, 6))) * RNG.exponential(size=(500, 1)), "few": unit(RNG.normal(size=(7, 6)))}[kind]
    q = np.concatenate([RNG.normal(size=(20, x.shape[1])), x[:5], np.zeros((1, x.shape[1]))])
    items = table(spark, x, "item_id").union(spark.createDataFrame([(9999, None)], "item_id long, v array<double>"))
    got = [(r.query_id, r.item_id, r["rank"]) for r in R.knn_topk(table(spark, q, "query_id"), items, 12, size=40).collect()]
    assert len(got) == len(set(got)) and set(got) == nearest(q, x, 12)


def test_cells_out_of_reach_are_not_searched(spark, monkeypatch):
    """With clusters and with falling norms most visits of the second round are left out."""
    for x in (clustered(spread=0.02), unit(RNG.normal(size=(600, 6))) * np.geomspace(1, 1e-3, 600)[:, None]):
        visits = []
        search = R._searched
        monkeypatch.setattr(R, "_searched", lambda v, c, asked, k: visits.append((v.count(), len(c.tiles))) or search(v, c, asked, k))
        R.knn_topk(table(spark, x[:50], "query_id"), table(spark, x, "item_id"), 5, size=20).collect()
        monkeypatch.undo()
        (begun, n), (more, _) = visits
        assert n > 10 and begun + more < 0.6 * 50 * n


def test_empty_tables(spark):
    none = spark.createDataFrame([], "id long, v array<double>")
    one = spark.createDataFrame([(1, [1.0, 0.0])], "id long, v array<double>")
    q, i = (lambda t, n: t.withColumnRenamed("id", n) for _ in range(2))
    assert similar_pairs(none, 0.5).count() == 0 and similar_pairs(one, 0.5).count() == 0
    assert R.knn_topk(q(none, "query_id"), i(one, "item_id"), 3).count() == 0
    assert R.knn_topk(q(one, "query_id"), i(none, "item_id"), 3).count() == 0
    assert [tuple(r) for r in R.knn_topk(q(one, "query_id"), i(one, "item_id"), 3).collect()] == [(1, 1, 1.0, 1)]


def greedy_clusters(community, v, refs, threshold, alpha):
    n, leader = len(v), {}
    for i in range(n):
        if i not in leader:
            leader[i] = i
            for j in range(i + 1, n):
                if j not in leader and community[i] == community[j] and combined(v, refs, i, j, alpha)[2] >= threshold:
                    leader[j] = i
    return leader


def combined(v, refs, i, j, alpha):
    a, b = set(refs[i]), set(refs[j])
    jaccard = len(a & b) / len(a | b) if a and b else 0.0
    cos = float(v[i] @ v[j])
    return cos, jaccard, alpha * cos + (1 - alpha) * jaccard


def qa_like(n=160):
    v = np.round(clustered(n, 8, 6, 0.3), 6)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    refs = [[f"c{RNG.integers(6)}" for _ in range(RNG.integers(0, 4))] + (["hot"] if i % 3 == 0 else []) for i in range(n)]
    for i in range(0, n, 7):  # whole copies
        v[i], refs[i] = v[0], refs[0]
    return v, refs, [int(x) for x in RNG.integers(0, 3, n)]


@pytest.mark.parametrize("threshold, alpha", [(0.7, 0.6), (0.55, 0.6), (0.9, 0.5), (0.97, 0.6), (0.3, 0.9)])
def test_combined_similarity_and_leaders(spark, threshold, alpha):
    v, refs, community = qa_like()
    rows = spark.createDataFrame([(i, community[i], v[i].tolist(), refs[i]) for i in range(len(v))], "id long, community long, v array<double>, refs array<string>").repartition(3)
    want = {(i, j) for i in range(len(v)) for j in range(i + 1, len(v)) if community[i] == community[j] and combined(v, refs, i, j, alpha)[2] >= threshold}
    got = D.combined_similarity(rows, threshold, alpha, size=30).collect()
    assert len(got) == len(want) and {(r.a, r.b) for r in got} == want
    for r in got:
        assert np.allclose((r.cos, r.jaccard, r.similarity), combined(v, refs, r.a, r.b, alpha))
    assert {r.id: r.leader for r in D.answer_clusters(rows, threshold, alpha, size=30).collect()} == greedy_clusters(community, v, refs, threshold, alpha)


def test_question_communities_with_copies(spark):
    v = clustered(240, 12, 5, 0.4)
    near = v @ v.T >= 0.8
    degree = near.sum(1)
    want = {i: max(np.flatnonzero(near[i]).tolist(), key=lambda j: (degree[j], -j)) for i in range(len(v))}
    assert {r.id: r.community for r in D.question_communities(table(spark, v), 0.8, size=30).collect()} == want


def test_cluster_statistics(spark):
    v = clustered(200, 5, 6, 0.3)
    leader = [int(x) for x in RNG.choice([0, 1, 2, 3, 190, 191], 200)]
    leader[150] = 150
    got = D.cluster_stats(spark.createDataFrame(list(enumerate(leader)), "id long, leader long"), table(spark, v), size=15).collect()
    assert 150 not in {r.leader for r in got} and len(got) == len({x for x in leader if leader.count(x) > 1})
    for r in got:
        m = [i for i, x in enumerate(leader) if x == r.leader]
        cos = (v[m] @ v[m].T)[np.triu_indices(len(m), 1)]
        assert r.size == len(m) and np.isclose(r.max_cos, max(0, cos.max())) and np.isclose(r.mean_cos, cos.mean())


def test_large_clusters_become_one_row(spark):
    """Forty-five rows of a cluster: three requests, then one of their results, then packs."""
    rows = spark.createDataFrame([(i, f"q{i}", "a", str(i), "x") for i in range(47)], "id long, question string, answer string, relevance_score string, difficulty_score string")
    clusters = spark.createDataFrame([(i, 0 if i < 45 else 45) for i in range(47)], "id long, leader long")
    tiers = spark.createDataFrame([(0, "llm_merge_high"), (45, "llm_merge_medium")], "leader long, tier string")
    m = "<|#|>"

    def merge(text):
        names = [line.split(". ", 1)[1] for line in text.split("\n\n")[0].split("\n")[1:]]
        return "none" if names == ["q45", "q46"] else f"Question{m}{names[0]}~{len(names)}{m}Answer{m}b{m}NEXT{m}Question{m}{names[-1]}{m}Answer{m}c"

    got = D.merge_clusters(rows, clusters, tiers, merge, lambda t: f"Question{m}{t.count(chr(10))}{m}Answer{m}z").collect()
    # 20 + 20 + 5 rows give 2 each; those 6 give 2 in one request; these are reorganised into one pack
    assert sorted((r.id, r.pack, r.question, r.merged_from_count, r.dedup_method, r.reorganized, r.relevance_score) for r in got) == [(0, 0, "6", 45, "llm_merge_high", True, "0"), (45, 0, "q45", 2, "llm_merge_medium", False, "45")]
    same = D.merge_clusters(rows, clusters, tiers, lambda t: m.join(f"NEXT{m}Question{m}q{i}{m}Answer{m}a{m}" for i in range(25)), lambda t: "")
    assert same.where("id = 0").count() == 75  # rounds that do not shrink end
