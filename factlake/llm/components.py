"""Connected components of a link table, distributed.

Alternating large-star and small-star steps: each makes every node's larger
(or smaller) neighbours point at its least neighbour, so after a few rounds
every component is a star around its least id. The least neighbour is a partial
aggregate; the join that brings it back is an equi-join that Spark can split
where a node is hot. Each round is
written to the shared folder, and the one before deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .workspace import drop_stored, settle_driver, stored


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def _all_stars(links: DataFrame) -> bool:
    """Whether every node has one parent or is one, not both (links point down and don't repeat)."""
    ends = links.select(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(links.select(F.col("v").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up > 1 or up + down > 1").isEmpty()


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node, component: for every node of ``links`` (u, v bigint) but the least of its component, that least node.

    Links of a node with itself and repeated links count for nothing; an empty
    table gives an empty result.
    """
    at = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
    at = stored(at, "links")
    for _ in range(most_rounds):
        if _all_stars(at):
            out = at.select(F.col("u").alias("node"), F.col("v").alias("component"))
            out.stored_at = at.stored_at
            return out
        before, at = at, stored(_small_star(_large_star(at)), "star")
        drop_stored(before)
        settle_driver(links.sparkSession)
    raise RuntimeError(f"components didn't settle in {most_rounds} rounds")
