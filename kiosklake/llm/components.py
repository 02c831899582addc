"""Connected components of a link table, in shuffles of links alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kiosklake.session import materialize


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links`` (a, b): the least node it is connected with.

    Large-star and small-star steps in turn: every node's neighbours are tied to the least one
    seen, until nothing changes. A round at least halves a chain. Each step is a grouping and
    a join on a node, so a node with very many links is split like any skewed key; lineage is
    cut by a written table per round.
    """
    edges = materialize(_distinct(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))), "links")
    while True:
        large = _star(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))), keep_above=True)
        after = materialize(_distinct(_star(large, keep_above=False)), "links")
        if _same(edges, after):
            return after.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                after.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        edges = after


def _distinct(edges: DataFrame) -> DataFrame:
    return edges.filter("u <> v").distinct()


def _star(edges: DataFrame, *, keep_above: bool) -> DataFrame:
    """Ties neighbours of u to the least of u and them: those above u (large star), or those
    below u with u itself (small star, on edges that point down)."""
    least = edges.groupBy("u").agg(F.min("v").alias("_low")).withColumn("_low", F.least("u", "_low"))
    met = edges.join(least, "u")
    if keep_above:
        return met.filter("v > u").select(F.col("v").alias("u"), F.col("_low").alias("v"))
    below = met.select(F.col("v").alias("u"), F.col("_low").alias("v"))
    own = least.select("u", F.col("_low").alias("v"))
    return below.unionByName(own)


def _same(one: DataFrame, other: DataFrame) -> bool:
    """Equal sets of edges, told by their number and an order-free digest."""
    digest = [F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("v", "u"))]
    return one.agg(*digest).first() == other.agg(*digest).first()
