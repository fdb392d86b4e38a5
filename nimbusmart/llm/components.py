"""Connected components of links, by alternating large and small stars.

Every round is a few DataFrame joins and aggregations; minima are pre-aggregated
before the shuffle, a node with very many links is split by the skew join (both
join sides are plain scans), and each round's links are written to the shared
folder, so no lineage grows and nothing reaches the driver but whether it is done.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nimbusmart.llm.tables import materialise


def _are_stars(links: DataFrame) -> bool:
    """Whether every node either has one link to its root, or is a root."""
    ends = links.select(F.col("u").alias("n"), F.lit(1).alias("out")).unionAll(links.select("v", F.lit(0)))
    nodes = ends.groupBy("n").agg(F.sum("out").alias("out"), F.count_if(F.col("out") == 0).alias("into"))
    return nodes.where("out > 1 or (out = 1 and into > 0)").isEmpty()


def _star(links: DataFrame, name: str) -> DataFrame:
    """Each node's links moved to the smallest node among it and its neighbours."""
    low = links.groupBy("u").agg(F.min("v").alias("low"))
    low = materialise(low.withColumn("low", F.least("u", "low")), f"{name}-low")
    return links.join(low, "u")


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of ``links`` (columns u, v) that isn't its
    component's smallest node."""
    links = materialise(
        links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), name
    )
    while not _are_stars(links):
        both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, name).where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = materialise(large, f"{name}-large")
        small = _star(large, name)
        moved = small.where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        links = materialise(moved.unionAll(small.select("u", F.col("low").alias("v"))).distinct(), name)
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
