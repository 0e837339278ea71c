"""Replies to questions of any letters and spaces are those of SQL."""

import duckdb

from ragset.functions.text import upper
from ragset.jobs import catalog


def test_capitals_are_those_of_sql():
    rows = duckdb.sql("SELECT c, upper(c) FROM (SELECT chr(CAST(i AS INTEGER)) AS c FROM range(1, 1114112) r(i) WHERE i NOT BETWEEN 55296 AND 57343)").fetchall()
    assert [c for c, u in rows if upper(c) != u] == [] and upper("weiß ﬁn") == "WEIẞ ﬁN"


def test_replies_are_those_of_sql(spark, tmp_path):
    texts = ["straße links", "ŉa b", "no\xa0break here", "a\u2003b c", "\x1cx y", " \t ", "", "ᾳ und", None]
    rows = [(i, t, r, x) for i, q in enumerate(texts) for t, (r, x) in enumerate([("user", q), ("assistant", "answer")])]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {tuple(r) for r in catalog.queries()["u2_responder"](spark, str(tmp_path)).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert got == set(con.execute(catalog.oracle_sql()["u2_responder"]).fetchall()) and len(got) == len(texts)
