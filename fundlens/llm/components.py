"""Connected components of a large graph by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlens.llm.common import staged


def _rooted(edges: DataFrame, least_too: bool) -> DataFrame:
    """``a, b, m``: each edge with the least neighbour of ``a`` (or ``a`` itself). Both join
    inputs are written tables or scans, so adaptive execution can split a hot node."""
    low = staged(edges.groupBy("a").agg(F.min("b").alias("m")), "stars")
    rooted = edges.join(low, "a")
    return rooted.withColumn("m", F.least("a", "m")) if least_too else rooted


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, label`` for every end of the edges ``a, b`` (longs): the least node of its component.

    Each round every node hands its larger, then its smaller neighbours to its least one;
    the forest of stars is reached in a number of rounds that grows with the logarithm of
    the component size. Rounds are written tables, so nothing is recomputed or collected.
    """
    now = staged(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                 .distinct(), "edges")
    for _ in range(max_rounds):
        if _stars(now):
            break
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _rooted(both, True).filter("b > a AND b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = _rooted(staged(large, "edges-large"), False)
        now = staged(small.select(F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                                                    F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
                     .select("e.a", "e.b").filter("a <> b").distinct(), "edges-small")
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")) \
        .unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one edge up or only edges down: then the edges are finished stars."""
    ends = edges.select(F.col("a").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")) \
        .unionByName(edges.select(F.col("b").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down")) \
        .filter("up > 1 OR (up = 1 AND down = 1)").isEmpty()
