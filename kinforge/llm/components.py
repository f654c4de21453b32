"""Connected components of pairs, by alternating large and small stars; labels are the smallest member."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import stage


def _joined(edges: DataFrame, least: DataFrame) -> DataFrame:
    """edges with their a's least neighbour. That is staged, so that both sides are shuffled for the join and
    the adaptive planner may split a node of many edges."""
    return edges.join(stage(least, "least-neighbours"), "a")


def components(edges: DataFrame) -> DataFrame:
    """A row (id, label) for each id in edges (a, b) that isn't its component's smallest."""

    def oriented(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()

    def seal(pairs: DataFrame) -> tuple[DataFrame, tuple]:
        kept = stage(pairs, "component-edges")
        return kept, tuple(kept.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())

    now, mark = seal(oriented(edges))
    while mark[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = oriented(_joined(both, least).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = _joined(large, least).select(F.explode(F.array(F.struct("b", F.col("m")), F.struct(F.col("a").alias("b"), F.col("m")))).alias("e")).select(F.col("e.b").alias("a"), F.col("e.m").alias("b"))
        now, new = seal(oriented(small))
        if new == mark:
            break
        mark = new
    return now.select(F.col("a").alias("id"), F.col("b").alias("label"))
