"""Connected components of a graph that may be larger than any machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fringelake.llm.common import checkpointed


def _settled(edges: DataFrame) -> bool:
    """Every upper node has one lower node, which is no upper node itself: a forest of stars."""
    ends = edges.select(F.col("hi").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("low")).unionAll(
        edges.select("lo", F.lit(0), F.lit(1))
    )
    odd = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("low").alias("low")).filter("up > 1 OR (up = 1 AND low = 1)")
    return odd.isEmpty()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for each node of an edge; component is the smallest node that it reaches.

    Large stars and small stars alternate until every component is a star around its smallest node, after a number of
    rounds that grows with the logarithm of the nodes. Each round is two aggregations and joins on a node; a node with
    very many edges is aggregated before it is moved, and its side of the join can be split. Every round is written to
    the checkpoint folder. No links are no rows.
    """
    now = checkpointed(
        edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct()
    )
    while not _settled(now):
        both = now.unionAll(now.select("lo", "hi")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        lowest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        paired = large.join(lowest, "hi")
        small = paired.filter("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).unionAll(lowest.select("hi", F.col("m")))
        now = checkpointed(small.distinct())
    centres = now.select(F.col("lo").alias("node")).distinct()
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionAll(centres.select("node", F.col("node")))
