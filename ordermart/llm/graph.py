"""Connected components of a pair table, as Spark joins (no link reaches the driver)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermart.llm.common import stored


def _summary(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b") % 1000003)).first())


def components(links: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a, b, of one orderable type): root is the
    smallest node of its component.

    Alternating large-star and small-star steps: each round hangs a node's larger neighbours, then
    its smaller ones, under the smallest neighbour, until nothing changes.  The number of rows
    never grows, the smallest neighbour is a map-side aggregate, and each round is written to the
    shared folder, so a hub with many neighbours is dealt out by the (skew-splitting) join.
    """
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .distinct(), "links")
    before = _summary(edges)
    for _ in range(max_rounds):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (both.where("b > a").join(low, "a")
                 .select(F.col("b").alias("a"), F.least("a", "m").alias("b")).where("a <> b").distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        edges = stored(small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                       .union(low.select("a", F.col("m").alias("b"))).distinct(), "links")
        after = _summary(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
