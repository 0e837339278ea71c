"""Sets as they are sent to the join's test."""

import numpy as np
import pytest

from ragset.llm.ngram_join import SHORT, full, read_sets, sent_set


@pytest.mark.parametrize("n, m", [(0, 0), (0, 3), (1, 1), (500, 520), (SHORT, SHORT + 1), (SHORT + 5, SHORT + 900)])
def test_sent_sets_share_what_the_sets_share(n, m):
    rng = np.random.default_rng(n + m)
    every = np.unique(np.concatenate([rng.integers(0, 1 << 64, 2 * SHORT, dtype=np.uint64), np.array([0, (1 << 64) - 1], np.uint64)]))
    x, y = (np.sort(rng.choice(every, k, replace=False)) for k in (n, m))
    a, b = read_sets(sent_set(x), sent_set(y))
    assert len(a) == n and len(b) == m and len(np.intersect1d(a, b, assume_unique=True)) == len(np.intersect1d(x, y))
    assert len(sent_set(x)) == (6 if n <= SHORT else 8) * n + 1


def test_full_rows(spark):
    rows = spark.range(1000).selectExpr("id % 50 as token", "nullif(id, 3) as g")
    assert full(rows).count() == 999 and full(rows.select("token")).count() == 1000
