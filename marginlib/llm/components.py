"""Connected components of links, by alternating star contraction.

Each round points every node's larger neighbours at its smallest neighbour,
then every node and its smaller neighbours at the smallest of them; the links
end as stars around the smallest node of each component.  Rounds are joins and
minimum aggregations only: the minimum of a node with very many links is taken before the
shuffle.  A round's links replace those of the round before, which are deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginlib.llm.common import discard, stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    return (both.where(F.col("b") > F.col("a")).join(least, "a")
            .select(F.col("b").alias("a"), F.col("least").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` run from the larger node a to the smaller b."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    rest = (edges.join(least, "a").where(F.col("b") > F.col("least"))
            .select(F.col("b").alias("a"), F.col("least").alias("b")))
    return rest.union(least.select("a", F.col("least").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (columns a, b of one
    ordered type, a null or equal end is ignored); component is the smallest
    node reachable.  Nodes without links have no row.

    The number of rounds grows with the logarithm of the longest path.
    """
    edges = stored(links.where("a != b")
                   .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        old, edges = edges, stored(_small_star(_large_star(edges)))
        discard(old)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return (edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .union(edges.select(F.col("b"), F.col("b"))).distinct())
