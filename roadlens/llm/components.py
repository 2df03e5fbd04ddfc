"""Connected components of an edge table, as Spark joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from roadlens.session import materialize


def _nearest(edges: DataFrame) -> DataFrame:
    """Per ``a``: the smallest of itself and its neighbours ``b``."""
    return edges.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return (both.join(_nearest(both), "a").filter("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    linked = down.join(low, "a")
    return (linked.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
            .unionByName(low.select("a", F.col("m").alias("b"))).distinct())


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``a, b``, longs, a <> b); root is the smallest node.

    Alternates the two star operations until the edges no longer change; each
    round halves the depth at least and keeps its edges as a written table in
    the shared folder. Only a count and a signature of the edges reach the
    driver. At the fixed point every node has one edge, to its root.
    """
    def signature(table: DataFrame):
        return tuple(table.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())

    current = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                          "edges")
    before = signature(current)
    while before[0]:
        current = materialize(_small_star(_large_star(current)), "edges")
        after = signature(current)
        if after == before:
            break
        before = after
    return (current.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()))
