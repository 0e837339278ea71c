"""Every query that SQL can express gives the rows of its SQL; the others give rows, as many as their tables ask for."""

import math
import os

import duckdb
import pytest

from ragset.jobs import catalog

DATA = "/root/testdata/sf0.001"


SEEDS = "SELECT count(*) FROM documents WHERE doc_id % 20 = 0 AND length(text) > 0"
#: Rows that queries without SQL have at least; their rules are tested apart, against loops.
LEAST = {
    "c5_stitch_windows": "SELECT count(*) FROM documents WHERE length(text) > 0", "t1_assign_topics": "SELECT count(*) FROM embeddings", "e1_embed_chunks": "SELECT count(*) FROM documents WHERE length(text) > 0", "s8_html_to_markdown": "SELECT count(*) FROM pages",
    "m7_iteration_logs": "SELECT count(*) FROM embeddings WHERE vec_id % 20 = 0", "m1_grow_contexts": SEEDS, "m5_context_statuses": SEEDS, "m6_grown_context_rows": SEEDS, "m7_context_logs": SEEDS,
}


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{DATA}/{f}'")
    return con


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 8))
    return repr(v)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, sql, name):
    df = catalog.queries()[name](spark, DATA)
    rows = [r.asDict() for r in df.collect()]
    query = catalog.oracle_sql().get(name)
    if query is None:
        assert len(rows) >= sql.execute(LEAST[name]).fetchone()[0] > 0 and all(set(r) == set(df.columns) for r in rows)
        return
    got = sql.execute(query)
    names = [x[0] for x in got.description]
    want = [dict(zip(names, r)) for r in got.fetchall()]
    assert sorted(df.columns) == sorted(names)
    assert sorted([norm(r[c]) for c in sorted(names)] for r in rows) == sorted([norm(r[c]) for c in sorted(names)] for r in want)
