"""Connected components by alternating large-star and small-star steps.

Every step is a join and a partial aggregation on the node, so a hub with
many links is combined map-side and a skewed join partition can be split by
Spark; no task holds a component.  Steps write their links with
``checkpoint()`` (the shared folder), so lineage stays short and a lost
executor costs one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfold.session import ensure_checkpoint_dir


def _hook(links: DataFrame, upward: bool) -> DataFrame:
    """Links each larger (``upward``) or smaller-or-equal neighbour of a node,
    and the node itself, to the smallest node of the neighbourhood."""
    low = links.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    both = links.join(low, "a")
    keep = F.col("b") > F.col("a") if upward else F.col("b") <= F.col("a")
    out = both.where(keep).select(F.col("b").alias("a"), F.col("m").alias("b"))
    if not upward:
        out = out.union(low.select("a", F.col("m").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node that has a link; ``links`` has columns a, b
    of one orderable type.  Null ends and loops are ignored.  The root is the
    smallest node of the component."""
    ensure_checkpoint_dir(links.sparkSession)
    links = links.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct().checkpoint()
    seen = None
    while True:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # large star keeps links from larger nodes to the minimum; small star merges the minima
        links = _hook(both, upward=True)
        links = _hook(links, upward=False).checkpoint()
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == seen:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        seen = state
