"""Connected components of links, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airstrata.session import stored


def connected_components(links: DataFrame, left: str, right: str) -> DataFrame:
    """``(node, root)`` for every linked node, ``root`` being the smallest node it reaches.

    A large-star round hangs the larger neighbours of a node onto its smallest neighbour, a
    small-star round the smaller ones; the links of a component end as a star about its
    smallest node. Both are a partial aggregation and a join on the node, so a hub is
    pre-aggregated and split by the skew join. Every round is written to the shared folder:
    its lineage ends there. Only a count and a checksum reach the driver. Self-links and
    repeated links change nothing; no links give no rows.
    """
    a, b = F.col(left), F.col(right)
    edges = links.filter(a != b).select(
        F.greatest(a, b).alias("node"), F.least(a, b).alias("root")
    )
    edges = stored(edges.distinct(), "links")
    before = None
    while True:
        seen = edges.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("node", "root").cast("decimal(38,0)")).alias("sum"),
        ).first()
        if seen == before or seen["n"] == 0:
            break
        before = seen
        edges = stored(_small_star(_large_star(edges)), "links")
    roots = edges.select(F.col("root").alias("node"), "root").distinct()
    return edges.unionByName(roots)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("root").alias("node"), F.col("node").alias("root")))
    least = both.groupBy("node").agg(F.least(F.min("root"), F.col("node")).alias("least"))
    joined = both.withColumnRenamed("root", "other").join(least, "node")
    return (
        joined.filter("other > node")
        .select(F.col("other").alias("node"), F.col("least").alias("root"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("node").agg(F.min("root").alias("least"))
    moved = (
        edges.join(least, "node")
        .filter("root != least")
        .select(F.col("root").alias("node"), F.col("least").alias("root"))
    )
    return moved.unionByName(least.withColumnRenamed("least", "root")).distinct()
