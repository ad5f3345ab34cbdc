"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countpanel.llm.common import materialize


def _star(edges: DataFrame) -> DataFrame:
    """Edges (u, v) seen from every u in both directions are joined to the
    smallest neighbour of u (u itself included)."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(low, "u")


def _large(edges: DataFrame) -> DataFrame:
    """Every neighbour above u is linked to the smallest neighbour of u."""
    return _star(edges).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    """u and its neighbours below u are linked to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def connected(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(node, root) of every node with a link: root is the smallest node of
    its component.  ``edges`` has two long columns u and v, in any direction
    and with repeats.

    Each round cuts its lineage with a table in the shared folder.  The rows
    never exceed the number of links, hubs are pre-aggregated (min per node)
    and joined back, so that the engine can split a hub's rows.  The rounds
    end when a round changes nothing (O(log^2 n) rounds are enough).
    """
    edges = materialize(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                        .where("u != v").distinct(), "links")
    before = None
    for _ in range(max_rounds):
        edges = materialize(_small(_large(edges)), "stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == before or now[0] == 0:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
