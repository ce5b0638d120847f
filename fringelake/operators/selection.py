"""Selections of points, regions and interferograms: thresholds, masks, reference areas and their scores."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fringelake.operators.graph import written
from fringelake.operators.points import near_pairs
from fringelake.operators.robust import MAD_SCALE, median, rank01


def consistent(kept: DataFrame, again: DataFrame, span: float) -> DataFrame:
    """The points whose second estimate passes the threshold too, with a slope less than one wrap over the baselines away."""
    other = again.select("ps_id", F.col("k").alias("k2"), F.col("coh").alias("coh2"))
    met = kept.join(other, "ps_id").filter((F.col("coh2") > F.col("limit")) & (F.abs(F.col("k") - F.col("k2")) < 2 * math.pi / span))
    return met.select(*kept.columns)


def quiet(points: DataFrame, std: float, largest: float) -> DataFrame:
    """Points whose least arc deviation and least arc maximum are below the limits; points without arcs stay, and limits of pi
    or more on both are no limits."""
    if std >= math.pi and largest >= math.pi:
        return points
    return points.filter(F.col("std").isNull() | (F.col("std") < std) & (F.col("max") < largest))


def in_reference(lon: tuple[float, float] | None = None, lat: tuple[float, float] | None = None, centre: tuple[float, float] | None = None, radius: float = math.inf) -> Column:
    """Whether a point is in the reference area: within the open box, and within the radius of the centre, its border included.
    A radius of -Inf is no point, Inf every one of the box."""
    from fringelake.functions.geometry import distance

    if radius == -math.inf:
        return F.lit(False)
    inside = F.lit(True)
    for name, ends in (("lon", lon), ("lat", lat)):
        if ends is not None:
            inside &= (F.col(name) > ends[0]) & (F.col(name) < ends[1])
    if centre is not None and radius < math.inf:
        inside &= distance(F.col("lon"), F.col("lat"), *centre) <= radius
    return inside


def patch_grid(points: DataFrame, target: int = 25_000, most: tuple[float, float] = (64, 64)) -> tuple[int, int]:
    """(patches along azimuth, along range): as many as hold about `target` points each, near square for the points' extent;
    while they are too few, the side whose patches are longer gets one more. `most` limits the sides; Inf is no limit. One row
    is collected."""
    n, rows, cols = points.agg(F.count("*"), F.max("row") - F.min("row") + 1, F.max("col") - F.min("col") + 1).first()
    if not n:
        raise ValueError("no points to lay out patches for")
    wanted, rows, cols = max(1, -(-n // target)), max(1, rows), max(1, cols)
    across = min(most[1], max(1, round(math.sqrt(wanted * cols / rows))))
    along = min(most[0], max(1, -(-wanted // across)))
    while along * across < wanted and (along < most[0] or across < most[1]):
        if across < most[1] and (along >= most[0] or cols / across >= rows / along):
            across += 1
        else:
            along += 1
    return along, across


def coherence_mask(left: DataFrame, right: DataFrame | None, strategy: str, threshold: float | None) -> DataFrame:
    """pt, in_left, in_right of two diagnostics tables (pt, coh): all rows, each side's coherent rows, or those coherent on both."""
    if strategy not in ("none", "coherence", "common_coherence"):
        raise ValueError("strategies are none, coherence and common_coherence")
    ok = lambda c: F.lit(True) if threshold is None or strategy == "none" else F.coalesce(c >= threshold, F.lit(False))
    a = left.select("pt", F.col("coh").alias("a"), F.lit(True).alias("l"))
    if right is None:
        return a.select("pt", ok(F.col("a")).alias("in_left"), F.lit(None).cast("boolean").alias("in_right"))
    met = a.join(right.select("pt", F.col("coh").alias("b"), F.lit(True).alias("r")), "pt", "full")
    both = ok(F.col("a")) & ok(F.col("b")) if strategy == "common_coherence" and threshold is not None else F.lit(True)
    side = lambda there, c: F.coalesce(there, F.lit(False)) & ok(c) & both
    return met.select("pt", side(F.col("l"), F.col("a")).alias("in_left"), side(F.col("r"), F.col("b")).alias("in_right"))


def regions(points: DataFrame, cell: float, radius: float, least: int) -> DataFrame:
    """Candidate reference regions: the points within `radius` of the median place of each cell that has `least` points, with
    `least` points of their own; of regions with the same members the first. region, cx, cy, members (an array of ids)."""
    cells = points.groupBy(F.floor(F.col("x") / cell).alias("cx"), F.floor(F.col("y") / cell).alias("cy")).agg(
        F.count("*").alias("n"), median("x").alias("x"), median("y").alias("y")
    )
    centres = cells.filter(F.col("n") >= least).select(F.concat_ws(":", "cx", "cy").alias("ps_id"), "cx", "cy", "x", "y")
    # near_pairs leaves out its border, which belongs to a region.
    near = near_pairs(centres, points, math.nextafter(radius, math.inf))
    found = near.groupBy("ps_id").agg(F.array_sort(F.collect_list("other")).alias("members")).filter(F.size("members") >= least)
    told = found.join(centres.select("ps_id", "cx", "cy"), "ps_id")
    first = told.groupBy("members").agg(F.min(F.struct("cx", "cy")).alias("first"))
    return first.select(F.concat_ws(":", "first.cx", "first.cy").alias("region"), "first.cx", "first.cy", "members")


def region_scores(found: DataFrame, points: DataFrame, error: str, weights: tuple[float, float, float] = (0.60, 0.25, 0.15)) -> DataFrame:
    """region, n, c50, c10, mad, score: coherence (0.7 of the rank of the median, 0.3 of that of the tenth percentile), spread
    of an error proxy (the lower the better) and density (log1p of the number of points), ranked from 0 to 1 and weighed."""
    rows = found.select("region", F.explode("members").alias("ps_id")).join(points.select("ps_id", "coh", F.col(error).alias("e")), "ps_id")
    told = rows.groupBy("region").agg(F.count("*").alias("n"), median("coh").alias("c50"), F.percentile("coh", F.lit(0.1)).alias("c10"), median("e").alias("middle"))
    spread = rows.join(told.select("region", "middle"), "region").groupBy("region").agg((MAD_SCALE * median(F.abs(F.col("e") - F.col("middle")))).alias("mad"))
    ranked = told.join(spread, "region").withColumn("calm", -F.col("mad")).withColumn("dense", F.log1p("n"))
    for x in ("c50", "c10", "calm", "dense"):
        ranked = rank01(ranked, x, "region", f"r_{x}")
    quality = 0.7 * F.col("r_c50") + 0.3 * F.col("r_c10")
    score = (weights[0] * quality + weights[1] * F.col("r_calm") + weights[2] * F.col("r_dense")) / sum(weights)
    return ranked.select("region", "n", "c50", "c10", "mad", score.alias("score"))


def diagnostic_points(values: DataFrame, key: str, x: str, rule: str, count: int) -> DataFrame:
    """The `count` rows of largest absolute value (rules high_velocity and high_variance), or evenly spaced in the order of the
    key (evenly_spaced); values that are not finite have no part."""
    finite = values.filter(F.col(x).isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    if rule in ("high_velocity", "high_variance"):
        return finite.orderBy(F.desc(F.abs(x)), F.desc(key)).limit(count)
    if rule != "evenly_spaced":
        raise ValueError("rules are high_velocity, high_variance and evenly_spaced")
    n = finite.count()
    places = list(range(n)) if n <= count else sorted({k * (n - 1) // max(1, count - 1) for k in range(count)})
    return at_places(finite, key, places)


def placed(df: DataFrame, key: str) -> DataFrame:
    """df with the place of each row, from 0, in the order by key: rows are dealt by range, counted by part, and numbered from
    the counts of the parts before; no task sees all rows."""
    part = written(df.repartitionByRange(key).withColumn("__part", F.spark_partition_id()))
    sizes = sorted((r["__part"], r["count"]) for r in part.groupBy("__part").count().collect())  # a row for each part
    starts, total = [], 0
    for k, n in sizes:
        starts.append((k, total))
        total += n
    begins = df.sparkSession.createDataFrame(starts, "__part int, __begin long")
    place = F.row_number().over(Window.partitionBy("__part").orderBy(key)) - 1
    told = part.withColumn("place", place).join(F.broadcast(begins), "__part").withColumn("place", F.col("place") + F.col("__begin"))
    return told.drop("__part", "__begin")


def at_places(df: DataFrame, key: str, places: list[int]) -> DataFrame:
    """The rows at the places, from 0, of the order by key."""
    return placed(df, key).filter(F.col("place").isin(places))


def common_places(left: DataFrame, right: DataFrame, keys: list[str], key: str = "ps_id") -> DataFrame:
    """left_id, right_id of the rows that share their coordinates; of equal rows on one side the first."""
    one = lambda df, name: df.groupBy(*keys).agg(F.min(key).alias(name))
    return one(left, "left_id").join(one(right, "right_id"), keys).select("left_id", "right_id")


def once_per_place(points: DataFrame, keys: list[str], compute) -> DataFrame:
    """Points with what `compute` makes of their distinct places: a place with many points is computed once."""
    return points.join(compute(points.select(*keys).distinct()), keys)


def report_row(points: DataFrame, velocity: str = "velocity", endpoint: str = "endpoint") -> DataFrame:
    """One row: points, finite velocities, their extent and extremes, and their correlation with the endpoint velocities."""
    v = F.when(~F.isnan(velocity), F.col(velocity))
    return points.agg(
        F.count("*").alias("n"), F.count(v).alias("n_finite"), F.min(v).alias("low"), F.max(v).alias("high"), F.avg(v).alias("mean"),
        F.corr(v, F.col(endpoint)).alias("correlation"),
    )
