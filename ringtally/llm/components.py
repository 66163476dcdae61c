"""Connected components of a graph given as links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringtally.llm.common import staged


def _to_lowest(links: DataFrame, larger_only: bool) -> DataFrame:
    """Ties the neighbours of every node (only the larger ones, or only the smaller ones and
    itself) to its lowest neighbour. Lowest values are combined before the shuffle."""
    if larger_only:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        kept = both.join(lowest, "a").where("b > a").select(F.col("low").alias("a"), "b")
        return kept.where("a != b").distinct()
    down = links.select(F.col("b").alias("u"), F.col("a").alias("v"))
    lowest = down.groupBy("u").agg(F.min("v").alias("low"))
    tied = down.join(lowest, "u").select(F.col("low").alias("a"), F.col("v").alias("b"))
    own = lowest.select(F.col("low").alias("a"), F.col("u").alias("b"))
    return tied.union(own).where("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``links``: a, b (numbers). One row per node that has a link: ``node``, ``component`` (the
    lowest node reachable). Ends when nothing changes, after about log(nodes) rounds; every
    round is written, and one row of sums reaches the driver."""
    ordered = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    now = staged(ordered.where("a != b").distinct(), "links")
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        now = staged(_to_lowest(_to_lowest(now, True), False), "links")
    tied = now.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return tied.union(now.select("a", "a")).distinct()
