"""Connected components as rounds of joins, for edge lists of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from farelight.session import written

MAX_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for the nodes of an undirected edge list ``a, b`` of longs.

    ``component`` is the smallest node that can be reached. Alternates two steps that
    hang every node on the smallest node it knows of: first the neighbours that are larger
    than a node, then those that are smaller. Each step needs the minimum over the
    neighbours of a node, an aggregate that combines before the shuffle, and a join that
    adaptive execution can split, so a node with very many neighbours is no bottleneck.
    Each round is written, which cuts the lineage; the rounds end when every node hangs
    directly on its root. Loops and repeated edges are harmless; no edges give no rows.
    """
    links = written(edges.filter("a <> b").select("a", "b").distinct(), "edges")
    before = None
    for _ in range(MAX_ROUNDS):
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        links = written(_hang(both, larger=True), "large")
        below = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        links = written(_hang(below, larger=False), "small")
        # The links form a set; it has settled when a full round leaves it as it is.
        now = links.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long")), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before:
            roots = links.select(F.col("b").alias("node")).distinct()
            return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                roots.select("node", F.col("node").alias("component"))
            )
        before = now
    raise RuntimeError("components did not settle")


def _hang(pairs: DataFrame, larger: bool) -> DataFrame:
    """Of each node ``a``, link its neighbours (and itself) to the smallest of them."""
    least = pairs.groupBy("a").agg(F.min(F.least("a", "b")).alias("low"))
    hung = pairs.join(least, "a")
    if larger:
        hung = hung.filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        return hung.filter("a <> b").distinct()
    own = least.select("a", F.col("low").alias("b"))
    return hung.select(F.col("b").alias("a"), F.col("low").alias("b")).union(own).filter("a <> b").distinct()
