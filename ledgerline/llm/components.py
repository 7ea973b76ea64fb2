"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.session import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour that is larger than a node moves to the node's smallest neighbour."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # A table of its own, so that adaptive execution can split the join at a hub.
    least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
    return (
        both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours all move to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (its smallest node) for every node with an edge to another.

    ``edges`` has two integer columns; direction, repeats and self-loops do not
    matter.  Each round is a few equi-joins whose input is written to the shared
    folder first, and the number of rounds grows with the logarithm of the longest
    chain.  Edges of a node with very many neighbours are never gathered: its
    minimum is pre-aggregated, and adaptive execution splits the join back.
    """
    u, v = edges.columns
    stars = materialize(
        edges.select(F.col(u).cast("long").alias("u"), F.col(v).cast("long").alias("v"))
        .where("u <> v")
        .distinct(),
        "edges",
    )
    before = None
    while True:
        stars = materialize(_small_star(_large_star(stars)), "edges")
        seen = stars.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if seen == before:
            return stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = seen
