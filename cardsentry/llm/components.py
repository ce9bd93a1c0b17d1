"""Connected components by alternating large-star and small-star.

Each step replaces edges so that every node moves towards the smallest node it
can see; the graph stays sparse and no component is ever gathered in one place.
Every round is written to the shared folder, so a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, salted_join

MAX_ROUNDS = 200


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to the smallest of its neighbourhood."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return salted_join(both, least, ["a"], F.col("b")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of those."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    linked = salted_join(down, least, ["a"], F.col("b")).where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.union(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)``; component is the smallest node reachable.

    Links may repeat and may be given in either direction; self links are
    ignored.  An empty input gives an empty result.
    """
    edges = scratch.stash(
        links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    for _ in range(MAX_ROUNDS):
        after = scratch.stash(_small_star(_large_star(edges)), "star")
        # a star forest: every node has one edge, to a node that has none
        unsettled = after.join(after.select(F.col("a").alias("b")).distinct(), "b", "left_semi").limit(1).count()
        many = 0 if unsettled else after.groupBy("a").count().where("count > 1").limit(1).count()
        edges = after
        if not unsettled and not many:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
