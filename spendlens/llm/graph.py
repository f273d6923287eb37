"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (src, dst: long); a component's name is its least node.

    Alternating large-star and small-star rounds (a published map-reduce scheme): every round is two
    aggregations with partial minima and two joins on the node, so a node with very many
    neighbours is pre-aggregated and its join may be split. Rounds end when no edge changes.
    """
    edges = stored(edges.where("src <> dst")
                   .select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct(), "edges")
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = stored(both.join(least, "u").where("v > u")
                       .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))))
        edges = stored(small.distinct(), "small-star")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(edges.select("v", "v").distinct().toDF("node", "component")))
