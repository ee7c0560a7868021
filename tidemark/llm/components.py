"""Connected components of an edge table by alternating large-star and small-star rounds.

Only aggregations and joins on node ids: no component is ever in one task, and nothing but two
counters per round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % F.lit(1 << 40))).first()


def connected_components(spark, edges: DataFrame) -> DataFrame:
    """(a, b) long edges -> (node, root): every node of an edge with the smallest node it reaches.

    Rows with a null end or a = b say nothing and are left out. No edges: an empty table."""
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = staged(spark, e, "edges")
    state = _state(e)
    while state[0]:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.col("b").alias("x"), "a", "low")
        e = (small.select(F.col("x").alias("a"), F.col("low").alias("b"))
             .unionByName(small.select("a", F.col("low").alias("b"))).where("a <> b").distinct())
        e = staged(spark, e, "edges")
        now = _state(e)
        if now == state:
            break
        state = now
    roots = e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
