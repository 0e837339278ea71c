"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ragset.llm.common import staged


def components(edges: DataFrame, most: int = 50) -> DataFrame:
    """(node, component) of every node of edges (a, b): component is the smallest node that edges lead to."""
    now, was = staged(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "edges"), None
    for _ in range(most):
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select("b", "a"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()
        down = large.select(F.col("b").alias("u"), F.col("a").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(low, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).union(low.select(F.col("m").alias("a"), F.col("u").alias("b"))).where("a < b").distinct()
        now = staged(small, "edges")
        total = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b").cast("long"))).first()
        if total == was:
            break
        was = total
    else:
        raise RuntimeError("the components have not settled")
    return now.select(F.col("b").alias("node"), F.col("a").alias("component")).union(now.select("a", "a").distinct())
