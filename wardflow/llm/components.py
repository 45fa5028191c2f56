"""Connected components of a table of links, by alternating star contractions.

Each round links every node's larger neighbours, then its smaller ones, to the smallest node it
sees, until only stars are left; the number of rounds grows with the logarithm of the size.
Minima are combined before the shuffle, so a node with very many links costs no single task, and
each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.session import materialize


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for nodes of links ``(a, b)``."""
    stars = materialize(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    state = _state(stars)
    while True:
        stars = materialize(_small_star(_large_star(stars)))
        now = _state(stars)
        if now == state:
            return stars.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
                stars.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
            )
        state = now


def _state(stars: DataFrame) -> tuple:
    return tuple(
        stars.agg(
            F.count("*"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
        ).first()
    )


def _large_star(links: DataFrame) -> DataFrame:
    """Links from each node's larger neighbours to the smallest node it sees."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("low"))
    # node a with its larger neighbour b
    return links.join(least, "a").select(F.col("low").alias("a"), "b").filter("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Links from each node and its smaller neighbours to the smallest of them."""
    least = links.groupBy("b").agg(F.min("a").alias("low"))
    others = links.join(least, "b").filter("a <> low").select(F.col("low").alias("a"), F.col("a").alias("b"))
    return others.unionByName(least.select(F.col("low").alias("a"), "b")).distinct()
