"""Connected components by alternating large and small stars, on DataFrames.

Every round is written to the shared folder.  No task gets a component: nodes meet their
neighbours' minimum by a partial aggregate, which is written, so that both sides of the
join back are plain exchanges that Spark can split at a hub.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellforge.llm.tables import stash, unstash


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is linked to the least of node and neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = stash(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "star-least")
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = stash(down.groupBy("a").agg(F.min("b").alias("m")), "star-least")
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).where("a != b")


def components(edges: DataFrame) -> DataFrame:
    """``a, b`` (long, in any order) -> ``node, root``: root is the least node of the
    component; roots themselves are not listed."""
    kept = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    kept, before = stash(kept, "edges"), None
    while True:
        state = kept.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == before or not state[0]:
            return kept.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = tuple(state)
        large = stash(_large_star(kept).distinct(), "large-star")
        last, kept = kept, stash(_small_star(large).distinct(), "small-star")
        unstash(last)
        unstash(large)
