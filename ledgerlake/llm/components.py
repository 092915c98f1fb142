"""Connected components of a graph of links, by alternating large and small stars.

Each round hangs the larger neighbours of every node onto its smallest one, then does the same for the
smaller neighbours; after a number of rounds that grows with the logarithm of the longest chain every
component is a star around its smallest node.  Minima are partial before their shuffle, and the join that
hands them out leaves a node with very many links to the adaptive planner's skew handling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.sinks.stage import Stage

MAX_ROUNDS = 60


def _hand_out(links: DataFrame) -> DataFrame:
    """``node, other, low`` with the smallest of a node's own number and its neighbours' as ``low``."""
    low = links.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("low"))
    return links.join(low, "node")


def _round(stars: DataFrame) -> DataFrame:
    both = stars.unionByName(stars.select(F.col("other").alias("node"), F.col("node").alias("other")))
    large = _hand_out(both).where("other > node").select(F.col("other").alias("node"), F.col("low").alias("other"))
    small = _hand_out(large.distinct())
    return (
        small.select(F.explode(F.array(F.struct("node", F.col("low").alias("other")), F.struct(F.col("other").alias("node"), F.col("low").alias("other")))).alias("e"))
        .select("e.*")
        .where("node <> other")
        .distinct()
    )


def components(links: DataFrame, stage: Stage) -> DataFrame:
    """``node, component`` for every node with a link (columns ``a`` and ``b``); the component is its smallest node."""
    stars = stage.keep(
        links.where("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other")).distinct(),
        "links",
    )
    seen = None
    for _ in range(MAX_ROUNDS):
        mark = stars.agg(F.count("*").alias("n"), F.sum(F.xxhash64("node", "other").cast("decimal(38,0)")).alias("h")).first()
        if mark == seen or not mark["n"]:
            centres = stars.select(F.col("other").alias("node"), F.col("other").alias("component")).distinct()
            return stars.select("node", F.col("other").alias("component")).unionByName(centres)
        seen, stars = mark, stage.keep(_round(stars), "stars")
    raise RuntimeError(f"no stable components after {MAX_ROUNDS} rounds")
