"""Connected components over a table of links, by alternating large and small stars.

Each round every node hands its larger neighbours (large star), then its smaller ones (small star), to the least node it
knows. The links stay distributed, a round adds none, and a round's result is written to the shared folder.
Hubs are pre-aggregated to their least neighbour; the join that follows is one that Spark can split by size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aislane.llm.common import staged


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").where("a < b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Links point from the smaller node ``a`` to the larger ``b``."""
    least = links.groupBy("b").agg(F.min("a").alias("m"))
    moved = links.join(least, "b").select(F.col("m").alias("a"), F.when(F.col("a") != F.col("m"), F.col("a")).alias("b"))
    kept = least.select(F.col("m").alias("a"), "b")
    return moved.where("b is not null").unionByName(kept).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (long columns ``a`` and ``b``): root is the least node reachable."""
    links = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
    seen = None
    while True:
        links = staged(_small_star(_large_star(links)), "stars")
        # A round that changes nothing leaves the same set of links.
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    roots = links.select(F.col("a").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return links.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(roots)
