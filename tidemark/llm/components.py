"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged


def _both_ways(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _with_smallest(pairs: DataFrame) -> DataFrame:
    """Add ``m``, the smallest of a node and the nodes it is paired with.

    An aggregate and a join rather than a window: a node with very many links is combined before the
    shuffle, and adaptive execution can split its rows in the join.
    """
    smallest = pairs.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return pairs.join(smallest, "a")


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    return _with_smallest(_both_ways(links)).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    pairs = _with_smallest(down)
    return pairs.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
        pairs.select("a", F.col("m").alias("b"))
    )


def smallest_reachable(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b) that is not the smallest of its component.

    Rounds go on until the links no longer change; each writes its links to the shared folder, which
    also cuts the lineage. The number of rounds grows with the logarithm of the longest chain.
    """
    current = staged(links.where("a <> b").select("a", "b"), "links")
    seen = None
    while True:
        mark = current.agg(
            F.count("*").alias("n"),
            F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("total"),
        ).first()
        if mark == seen or not mark.n:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = mark
        stars = _small_star(_large_star(current)).where("a <> b").distinct()
        current = staged(stars, "links")
