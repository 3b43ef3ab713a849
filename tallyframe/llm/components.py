"""Connected components of links, by Spark jobs that cut their lineage each round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.rows import store


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for all nodes of ``links(a, b)``; the root is the least node.

    Alternates two steps until nothing changes: every node's larger neighbours are
    linked to its least neighbour, then its smaller ones. Each keeps components as
    they are, and the number of rounds grows with the logarithm of their size.
    Links are made distinct before they are grouped, and a hub's neighbours meet
    only in partial minima and in a join that adaptive execution can split. Each
    round is written to the shared folder.
    """
    small = links.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).where("a <> b").distinct()
    links = store(small, "links")
    before = None
    while (now := _signature(links)) != before:
        before = now
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        links = store(_to_least(_to_least(both, larger=True), larger=False), "links")
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _signature(links: DataFrame) -> tuple:
    """Equal for equal sets of links, and else different but for chance of 2 ** -64."""
    total = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(links.agg(F.count("*"), total).first())


def _to_least(links: DataFrame, larger: bool) -> DataFrame:
    """Each node's neighbours (its larger ones, or its smaller ones and itself) linked
    to the least of the node and its neighbours; as ``(a > b)``."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    least = least.select("a", F.least("a", "least").alias("least"))
    met = links.join(least, "a")
    if larger:
        met = met.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        own = least.select("a", F.col("least").alias("b"))
        met = met.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(own)
    return met.where("a <> b").distinct()
