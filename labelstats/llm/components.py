"""Connected components of links between numbered nodes, by shrinking stars.

Every round points each node at the smallest neighbour: first from larger neighbours, then
from smaller ones. Rounds grow with the logarithm of the longest chain. Minima are
pre-aggregated before the shuffle; the rows of a node with many neighbours are joined to its
minimum, which Spark's skew join splits. Each round is settled in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelstats.llm.common import settled


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of a link (a, b).

    Links of a node to itself and repeated links change nothing."""
    edges = settled(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    while edges.join(edges.select(F.col("v").alias("u")), "u", "left_semi").head(1):
        # Large star: neighbours above a node point at the smallest of the node and its neighbours.
        sides = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = sides.groupBy("u").agg(F.least(F.min("v"), "u").alias("m"))
        large = sides.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = settled(large.distinct())
        # Small star: a node and its smaller neighbours point at the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = settled(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
    # Stars: no centre points on.
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
