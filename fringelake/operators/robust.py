"""Robust statistics of a column, whole or by group.

``median`` is an exact percentile of a group that is small by nature (a row for each interferogram, arc, cell or region).
Long tables with few groups go through ``quantiles``, which is exact too and never holds a group's values in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAD_SCALE = 1.4826
_TINY = 1e-12


def median(x) -> Column:
    return F.percentile(x, F.lit(0.5))


def quantiles(df: DataFrame, x: str, shares: dict[str, float], by: list[str] | None = None, bins: int = 256) -> DataFrame:
    """by and, for each name, the exact quantile of the finite values of x, between neighbours as a percentile is. For long tables
    with few groups (interferograms, acquisitions): the values are counted by bins between their ends, and only the bins that
    hold a wanted place are ordered. What is collected is a row for each group and at most `bins` counts of it; equal values are
    counted before they move."""
    keys, names = by or [], list(shares)
    rows = df.select(*keys, F.col(x).cast("double").alias("_q_x")).filter("_q_x IS NOT NULL AND NOT isnan(_q_x) AND abs(_q_x) < double('inf')")
    if not keys:
        keys, rows = ["_q_all"], rows.withColumn("_q_all", F.lit(0))
    spark, group = df.sparkSession, T.StructType([rows.schema[k] for k in keys])
    long = lambda *fields: T.StructType([*group.fields, *(T.StructField(n, t) for n, t in fields)])
    found = rows.groupBy(*keys).agg(F.min("_q_x").alias("lo"), F.max("_q_x").alias("hi"), F.count("*").alias("n")).collect()
    sizes = {tuple(r[k] for k in keys): r["n"] for r in found}
    ends = spark.createDataFrame([(*(r[k] for k in keys), r["lo"], r["hi"]) for r in found], long(("_q_lo", T.DoubleType()), ("_q_hi", T.DoubleType())))
    share = F.when(F.col("_q_hi") > F.col("_q_lo"), (F.col("_q_x") - F.col("_q_lo")) / (F.col("_q_hi") - F.col("_q_lo"))).otherwise(0.0)
    binned = rows.join(F.broadcast(ends), keys).select(*keys, "_q_x", F.least(F.lit(bins - 1), F.floor(share * bins)).cast("int").alias("_q_bin"))
    held, before = [], {}
    for r in binned.groupBy(*keys, "_q_bin").agg(F.count("*").alias("c")).orderBy(*keys, "_q_bin").collect():
        key = tuple(r[k] for k in keys)
        start = before.get(key, 0)
        before[key] = start + r["c"]
        for name, p in shares.items():
            place = p * (sizes[key] - 1)
            low = math.floor(place)
            for at, weight in {low: 1 - (place - low), math.ceil(place): place - low if place > low else 1.0}.items():
                if start <= at < start + r["c"]:
                    held.append((*key, name, r["_q_bin"], at - start, float(weight)))
    wanted = spark.createDataFrame(held, long(("what", T.StringType()), ("_q_bin", T.IntegerType()), ("inner", T.LongType()), ("weight", T.DoubleType())))
    few = binned.join(F.broadcast(wanted.select(*keys, "_q_bin").distinct()), [*keys, "_q_bin"], "left_semi").groupBy(*keys, "_q_bin", "_q_x").agg(F.count("*").alias("_q_c"))
    told = few.withColumn("_q_end", F.sum("_q_c").over(Window.partitionBy(*keys, "_q_bin").orderBy("_q_x")))
    met = told.join(F.broadcast(wanted), [*keys, "_q_bin"]).filter("inner < _q_end AND inner >= _q_end - _q_c")
    out = met.groupBy(*keys).agg(*(F.sum(F.when(F.col("what") == k, F.col("_q_x") * F.col("weight"))).alias(k) for k in names))
    return out if by else out.drop("_q_all")


def with_median_mad(df: DataFrame, x: str, by: list[str] | None = None) -> DataFrame:
    """df with med, mad, n, std (population) of the finite values of x in each group."""
    by = by or []
    finite = F.when(~F.isnan(x) & (F.abs(x) < math.inf), F.col(x))

    def joined(left, right):
        return left.join(F.broadcast(right), by, "left") if by else left.crossJoin(F.broadcast(right))  # one row

    middle = df.groupBy(*by).agg(F.count(finite).alias("n"), F.stddev_pop(finite).alias("std"), (F.max(finite) - F.min(finite)).alias("spread"))
    told = joined(joined(df, quantiles(df, x, {"med": 0.5}, by)), middle)
    apart = told.select(*by, F.abs(finite - F.col("med")).alias("_apart"))
    return joined(told, quantiles(apart, "_apart", {"mad": 0.5}, by))


def _windowed(df: DataFrame, x: str, by: list[str]) -> DataFrame:
    """As with_median_mad with names that start with _rz_, by two windows over the same partitions: for tables of a row for each interferogram, arc or cell."""
    group = Window.partitionBy(*by)
    finite = F.when(~F.isnan(x) & (F.abs(x) < math.inf), F.col(x))
    told = df.withColumn("_rz_med", median(finite).over(group)).withColumn("_rz_n", F.count(finite).over(group)).withColumn("_rz_std", F.stddev_pop(finite).over(group))
    told = told.withColumn("_rz_spread", F.max(finite).over(group) - F.min(finite).over(group))
    return told.withColumn("_rz_mad", median(F.abs(finite - F.col("_rz_med"))).over(group))


def robust_high_z(df: DataFrame, x: str, out: str, by: list[str] | None = None, kind: str = "selection") -> DataFrame:
    """How far a value is above the median, in robust deviations, from 0 up.

    Where the deviation is nought: `selection` falls back to spread / max(10, sqrt(n)) and tells non-finite values by +Inf;
    `grid` to the largest of the deviation and spread / sqrt(n), with 0 for non-finite values or less than two finite ones;
    `network` to the deviation or else 1, with NaN for non-finite values.
    """
    told = _windowed(df, x, by or [])
    robust, n = MAD_SCALE * F.col("_rz_mad"), F.col("_rz_n").cast("double")
    if kind == "selection":
        other, odd = F.col("_rz_spread") / F.greatest(F.lit(10.0), F.sqrt(n)), F.lit(math.inf)
    elif kind == "grid":
        other, odd = F.greatest(F.col("_rz_std"), F.col("_rz_spread") / F.sqrt(n), F.lit(_TINY)), F.lit(0.0)
    else:
        other, odd = F.when(F.col("_rz_std") > _TINY, F.col("_rz_std")).otherwise(1.0), F.lit(math.nan)
    scale = F.when(robust > _TINY, robust).otherwise(other)
    z = F.when(scale > _TINY, F.greatest(F.lit(0.0), (F.col(x) - F.col("_rz_med")) / scale)).otherwise(0.0)
    if kind == "grid":
        z = F.when(F.col("_rz_n") < 2, 0.0).otherwise(z)
    finite = F.col(x).isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf)
    return told.withColumn(out, F.when(finite, z).otherwise(odd)).drop("_rz_med", "_rz_mad", "_rz_n", "_rz_std", "_rz_spread")


def percentile_rank(df: DataFrame, x: str, key: str, out: str) -> DataFrame:
    """Place in the stable order, over the number of rows; a single row is 0.5, a value that is not finite 1."""
    finite = F.col(x).isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf)
    group = Window.partitionBy(finite)
    n = F.count("*").over(group)
    rank = F.row_number().over(group.orderBy(x, key)) / n
    return df.withColumn(out, F.when(~finite, 1.0).when(n == 1, 0.5).otherwise(rank))


def ecdf(df: DataFrame, x: str, out: str) -> DataFrame:
    return df.withColumn(out, F.cume_dist().over(Window.orderBy(x)))


def mid_rank(df: DataFrame, x: str, out: str, by: list[str] | None = None) -> DataFrame:
    """(smaller values + the middle of the equal ones) / n; 0.5 for less than two rows or one distinct value."""
    whole = Window.partitionBy(*(by or []))
    n = F.count("*").over(whole)
    value = (F.rank().over(whole.orderBy(x)) - 1 + (F.count("*").over(Window.partitionBy(*(by or []), x)) + 1) / 2) / n
    return df.withColumn(out, F.when((n < 2) | (F.min(x).over(whole) == F.max(x).over(whole)), 0.5).otherwise(value))


def rank01(df: DataFrame, x: str, key: str, out: str) -> DataFrame:
    n = F.count("*").over(Window.partitionBy())
    return df.withColumn(out, (F.row_number().over(Window.orderBy(x, key)) - 1) / F.greatest(n - 1, F.lit(1)))


def circular_mad(df: DataFrame, by: list[str], angle: str) -> DataFrame:
    """centre (circular mean) and mad (scaled median distance from it) of each group's angles."""
    centre = df.groupBy(*by).agg(F.atan2(F.avg(F.sin(angle)), F.avg(F.cos(angle))).alias("centre"))
    apart = F.col(angle) - F.col("centre")
    told = df.join(F.broadcast(centre), by).withColumn("apart", F.abs(F.atan2(F.sin(apart), F.cos(apart))))
    spread = quantiles(told, "apart", {"mad": 0.5}, by)
    return centre.join(spread, by).select(*by, "centre", (MAD_SCALE * F.col("mad")).alias("mad"))
