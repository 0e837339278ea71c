import itertools
import zlib

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline as P
from ragset.llm import packing, tokens
from ragset.llm.common import staged, table
from ragset.llm.quality import quality_query
from ragset.llm.toxicity import toxicity_query

DATA = "/root/testdata/sf0.001"


def first_of_copies(rows):
    """By brute force: of each group of documents linked by four fifths of their five-word shingles the smallest doc_id."""
    sets = {r.doc_id: (lambda w: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())((r.text or "").encode().lower().split()) for r in rows}
    group = {i: i for i in sets}
    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 5 * both >= 4 * len(sets[a] | sets[b]) and group[a] != group[b]:
            low, high = sorted((group[a], group[b]))
            group = {k: low if v == high else v for k, v in group.items()}
    return {i for i, g in group.items() if i == g}


def test_stages_keep_the_columns_and_agree_with_run(spark):
    docs = table(spark, DATA, "documents")
    names, kept = docs.columns, [docs.count()]
    for name, stage in P.STAGES[:-1]:
        before, docs = docs, staged(stage(spark, docs, DATA), name)
        assert docs.columns == names
        kept.append(docs.count())
        if name != "near_copies":
            query, bad = (quality_query, 0) if name == "quality" else (toxicity_query, 1)
            gone = {r.doc_id for r in query(before, table(spark, DATA, "labels")).where(F.col("predicted") == bad).collect()}
            assert {r.doc_id for r in docs.collect()} == {r.doc_id for r in before.collect()} - gone
        else:
            assert {r.doc_id for r in docs.collect()} == first_of_copies(before.collect())
    assert kept == sorted(kept, reverse=True) and kept[-1] > 0
    rows = P.STAGES[-1][1](spark, docs, DATA).collect()
    from tokenizers import Tokenizer

    library, sizes = Tokenizer.from_file(tokens.public_path("byte_bpe_50k.json")), packing.class_sizes(2048)
    for d in docs.collect():
        ids = np.array([*library.encode(d.text or "", add_special_tokens=False).ids, 1], "<u4")
        want = sorted((s, n, zlib.crc32(ids[s : s + n].tobytes())) for s, n in packing.cut(len(ids), 2048, sizes))
        assert sorted((r.start, r.length, r.ids_crc32) for r in rows if r.doc_id == d.doc_id) == want
    assert {r.doc_id for r in rows} == {r.doc_id for r in docs.select("doc_id").collect()}


def test_odd_documents(spark):
    docs = spark.createDataFrame([(1, None, "en", "s", 0), (None, "a b c d e f", None, None, None), (2, "", "en", "s", 0), (3, "a b c d e f", "en", "s", 11), (3, "a b c d e f", "en", "s", 11), (4, "A b c d e f", "en", "s", 11)], "doc_id long, text string, lang string, source string, n_chars long")
    out = P.distinct_documents(spark, docs, DATA)
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in out.collect()) == [(False, 0), (True, 1), (True, 2), (True, 3)]
    for _, stage in P.STAGES:
        assert stage(spark, docs.limit(0), DATA).count() == 0


def test_a_rejected_row_takes_no_other_with_it(spark, tmp_path):
    """Rows of a rejected row's doc_id, or without one as it, stay if their own text is not rejected."""
    bad, clean = "go away you zorkfex", "we sat by the river for a while"
    rows = [(i, bad if i % 5 == 0 else clean) for i in range(200)]
    spark.createDataFrame([(i, int(t == clean), int(t == bad)) for i, t in rows], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    odd = [(None, bad), (None, clean), (900_001, bad), (900_001, clean)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string")
    for _, stage in P.STAGES[:2]:
        got = stage(spark, docs, str(tmp_path)).where("doc_id is null or doc_id = 900001").collect()
        assert sorted((r.doc_id or 0, r.text) for r in got) == [(0, clean), (900_001, clean)]


def test_texts_of_one_doc_id_stay_unless_they_are_near_copies(spark):
    rows = [(7, "a b c d e f"), (7, "p q r s t u"), (7, "p q r s t u"), (8, "P q r s t u"), (5, "k l m n o p"), (9, "short"), (9, "other"), (9, "other"), (None, "a b c d e f")]
    got = P.distinct_documents(spark, spark.createDataFrame(rows, "doc_id long, text string"), DATA).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == [(0, "a b c d e f"), (5, "k l m n o p"), (7, "a b c d e f"), (7, "p q r s t u"), (9, "other"), (9, "short")]
