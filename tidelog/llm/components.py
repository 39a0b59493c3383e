"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``a, b`` (long); the component's smallest node.

    Alternating star contraction: each node hooks its larger neighbours, then its smaller
    ones, onto the smallest it knows. Rounds grow with the logarithm of the longest path.
    Every round is one table of at most as many edges as before, written to the shared
    folder. A node with many edges is only ever reduced by a combining minimum and
    joined with that single row, which adaptive execution can split.
    Self-loops give a node of its own; NULL ends are ignored.
    """
    edges = edges.where("a is not null and b is not null")
    nodes = edges.select("a").union(edges.select("b")).distinct()
    now = stored(_canonical(edges), "edges")
    mark = None
    while True:
        sizes = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_000_007)).first()
        if tuple(sizes) == mark:
            break
        mark = tuple(sizes)
        now = stored(_small_star(_large_star(now)), "edges")
    # a star forest: every edge leads to the root
    roots = now.groupBy("a").agg(F.min("b").alias("root"))
    return nodes.join(roots, "a", "left").select(
        F.col("a").alias("node"), F.coalesce("root", "a").alias("component")
    )


def _canonical(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger node ``a`` to the smaller ``b``."""
    pair = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return pair.distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return _canonical(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    hooked = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _canonical(hooked.union(least.select("a", F.col("m").alias("b"))))
