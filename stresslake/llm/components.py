"""Connected components of an edge table, as rounds of Spark jobs.

Large-star and small-star rounds (Kiveris et al., 2014) turn the graph into stars
around the smallest node of each component. A round only takes minima per node and
joins them back, so a hub is folded on the map side and no neighbour list is built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stresslake.llm.common import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Links each larger neighbour of a node to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return (
        both.where("v > u").join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Links each smaller neighbour of a node, and the node, to the smallest one."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node with a link.

    ``edges`` has two columns of one comparable type. Rows with a NULL end and loops
    do not count; repeated and reversed links are harmless. An empty table gives an
    empty result.
    """
    a, b = edges.columns
    current = materialize(
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    )
    mark = None
    while True:
        # The number of links and a sum of their hashes tell whether a round changed any.
        found = current.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).head()
        if tuple(found) == mark or not found[0]:
            break
        mark = tuple(found)
        current = materialize(_small_star(_large_star(current).distinct()))
    stars = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.unionByName(roots)
