"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def connected(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node of an edge; the component is its least
    node.  Each round hangs larger neighbours under the least one (large star),
    then smaller neighbours (small star); rounds grow with the logarithm of the
    largest component.  Stars are dealt out by node with partial minima, and each
    round is written, so neither a star nor the lineage meets in one task."""
    edges = written(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                    .where("u <> v").distinct(), "edges")
    while True:
        links = _both(edges)
        least = links.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (links.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        large = written(large.distinct(), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))))
        after = written(small.where("u <> v").distinct(), "small-star")
        changed = (edges.exceptAll(after).limit(1).count() or after.exceptAll(edges).limit(1).count())
        edges = after
        if not changed:
            break
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return roots.unionByName(roots.select(F.col("component").alias("node"), "component").distinct())
