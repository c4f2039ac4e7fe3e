"""Connected components of an edge table, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import released, written


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(``node``, ``component``), the smallest node of its component, for every node with an edge (``a``, ``b``).

    Alternates two steps until nothing changes: every node links its larger neighbours to the
    smallest of its neighbourhood, then its smaller ones. Edges only ever shrink towards stars; no
    neighbourhood is gathered, only its minimum, and every round is a written table."""
    edges = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(), "edges")
    mark = None
    for _ in range(most_rounds):
        both = _both_ways(edges)
        low = both.groupBy("a").agg(F.least(F.min("b"), F.min("a")).alias("low"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a > b").distinct()
        large = written(large, "edges")
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        joined = large.join(low, "a")
        small = joined.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(joined.select("a", F.col("low").alias("b")))
        before, edges = edges, written(small.where("a > b").distinct(), "edges")
        released(before, large)
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
    made = written(stars, "components")
    released(edges)
    return made
