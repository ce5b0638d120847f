"""Weakly connected components and neighbour aggregates of arc tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def written(df: DataFrame) -> DataFrame:
    """df behind a reliable checkpoint in the folder that the session names. Where it names none, a folder of the warehouse is
    taken on a local master (tests, one machine); anything else is an error, as executors would not see it."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and context.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints")
    return df.checkpoint(eager=True)


def weak_components(arcs: DataFrame) -> DataFrame:
    """node, component (its smallest node). Every node takes the smallest label around it and then its label's label, until
    nothing changes; the second step halves the way to the smallest node each round."""
    both = written(arcs.select("a", "b").union(arcs.select("b", "a")).distinct())
    labels = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).select(F.col("a").alias("node"), "label"))
    while True:
        around = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("low"))
        lower = labels.join(around, labels.node == around.a).select("node", F.least("label", "low").alias("label"))
        jump = lower.select(F.col("node").alias("label"), F.col("label").alias("far"))
        after = written(lower.join(jump, "label", "left").select("node", F.coalesce(F.least("far", "label"), "label").alias("label")))
        if after.join(labels, ["node", "label"], "left_anti").isEmpty():
            return after.withColumnRenamed("label", "component")
        labels = after


def arc_differences(arcs: DataFrame, phase: DataFrame) -> DataFrame:
    """edge_id, ifg_id, dphi: wrapped phase of b less that of a; two equi-joins on points."""
    a = phase.select(F.col("ps_id").alias("a"), "ifg_id", F.col("phi").alias("pa"))
    b = phase.select(F.col("ps_id").alias("b"), "ifg_id", F.col("phi").alias("pb"))
    met = arcs.join(a, "a").join(b, ["b", "ifg_id"])
    d = F.col("pb") - F.col("pa")
    return met.select("edge_id", "a", "b", "ifg_id", F.atan2(F.sin(d), F.cos(d)).alias("dphi"))


def edge_noise(differences: DataFrame) -> DataFrame:
    """edge_id, ifg_id, noise: half of what an arc's difference departs from the arc's mean."""
    mean = differences.groupBy("edge_id").agg(F.avg("dphi").alias("m"))
    return differences.join(mean, "edge_id").select("edge_id", "ifg_id", (0.5 * (F.col("dphi") - F.col("m"))).alias("noise"))


def node_minimum(edge_stats: DataFrame) -> DataFrame:
    """node, std, max: least standard deviation and least maximum of the arcs at each node."""
    ends = edge_stats.select(F.explode(F.array("a", "b")).alias("node"), "std", "max")
    return ends.groupBy("node").agg(F.min("std").alias("std"), F.min("max").alias("max"))


def clamp_to_neighbours(values: DataFrame, arcs: DataFrame, column: str) -> DataFrame:
    """ps_id, column held within the least and greatest value around each point."""
    both = arcs.select("a", "b").union(arcs.select("b", "a")).distinct()
    seen = both.join(values.select(F.col("ps_id").alias("b"), F.col(column).alias("v")), "b").groupBy("a").agg(F.min("v").alias("low"), F.max("v").alias("high"))
    return values.join(seen, values.ps_id == seen.a, "left").select("ps_id", F.greatest(F.coalesce("low", column), F.least(F.coalesce("high", column), F.col(column))).alias(column))
