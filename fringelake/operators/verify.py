"""Tolerance-aware comparison of result tables, and the statistics that reports show."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fringelake.operators.robust import quantiles

#: Kinds of failure, in order of priority: pattern of the path, stages, kind (fixed values).
KINDS = (
    (r"^PATCH_[^/]*/(.*/)?pm1\.mat$", "stage2", "stage2_patch_boundary"),
    (r"^PATCH_[^/]*/(.*/)?select1\.mat$", "stage3", "stage3_patch_boundary"),
    (r"^PATCH_[^/]*/(.*/)?weed1\.mat$", "stage4", "stage4_patch_boundary"),
    (r"(^|/)(pm2|ifgstd2|phuw2|uw_phaseuw|uw_grid|uw_interp)\.mat$", "stage5_6", "unwrap_smoothing"),
    (r"(^|/)(scla2|scla_smooth2|mean_v|mv2|uw_space_time)\.mat$", "stage7_8", "unwrapped_noise_statistics"),
)
PRIORITY = {"stage2": 0, "stage3": 1, "stage4": 2, "stage5_6": 3, "stage7_8": 4, "unknown": 5}


def allclose(a, b, atol: float, rtol: float) -> Column:
    """|a - b| <= atol + rtol |b|; NaN equals NaN and null equals null."""
    both_nan = F.isnan(a) & F.isnan(b)
    return F.coalesce((F.abs(a - b) <= atol + rtol * F.abs(b)) | both_nan, a.isNull() & b.isNull())


def compare_numeric(run: DataFrame, golden: DataFrame, keys: list[str], x: str, atol: float, rtol: float) -> DataFrame:
    """One row: rows on either side alone, rows compared, rows out of tolerance, largest differences."""
    met = run.select(*keys, F.col(x).alias("a"), F.lit(1).alias("l")).join(golden.select(*keys, F.col(x).alias("b"), F.lit(1).alias("r")), keys, "full")
    both = F.col("l").isNotNull() & F.col("r").isNotNull()
    apart = F.when(both, F.abs(F.col("a") - F.col("b")))
    return met.agg(
        F.count_if(F.col("r").isNull()).alias("only_run"), F.count_if(F.col("l").isNull()).alias("only_golden"), F.count_if(both).alias("compared"),
        F.count_if(both & ~allclose(F.col("a"), F.col("b"), atol, rtol)).alias("failed"), F.max(apart).alias("max_abs"),
        F.max(apart / F.greatest(F.abs("b"), F.lit(1e-30))).alias("max_rel"),
    )


def modulo_difference(a, b, period: float = 2 * math.pi) -> Column:
    return F.pmod(a - b + period / 2, F.lit(period)) - period / 2


def exact_difference(run: DataFrame, golden: DataFrame) -> DataFrame:
    """side, n: rows (with repeats) that only one side has."""
    left, right = run.exceptAll(golden), golden.exceptAll(run)
    return left.select(F.lit("run").alias("side")).unionAll(right.select(F.lit("golden").alias("side"))).groupBy("side").agg(F.count("*").alias("n"))


def failure_kind(path) -> Column:
    out = F.lit("unclassified")
    for pattern, _, kind in reversed(KINDS):
        out = F.when(path.rlike(pattern), F.lit(kind)).otherwise(out)
    return out


def stage_scope(path) -> Column:
    out = F.lit("unknown")
    for pattern, scope, _ in reversed(KINDS):
        out = F.when(path.rlike(pattern), F.lit(scope)).otherwise(out)
    return out


def failure_summary(failures: DataFrame) -> DataFrame:
    """priority, scope, kind, n, first of the failed paths, the earliest stages first; `boundary` marks the kind that holds the
    failure to look at first."""
    scope = stage_scope(F.col("path"))
    rank = F.create_map(*(F.lit(v) for item in PRIORITY.items() for v in item))[scope]
    told = failures.select("path", scope.alias("scope"), failure_kind(F.col("path")).alias("kind"), rank.alias("priority"))
    groups = told.groupBy("priority", "scope", "kind").agg(F.count("*").alias("n"), F.min("path").alias("first"))
    least = told.agg(F.min("priority").alias("least"))
    return groups.crossJoin(F.broadcast(least)).withColumn("boundary", F.col("priority") == F.col("least")).drop("least")


def glob_pattern(glob: str) -> str:
    """A regular expression of a glob: * is any run of characters, ? any one, the rest itself."""
    return "^" + "".join(".*" if c == "*" else "." if c == "?" else re.escape(c) for c in glob) + "$"


def tolerance_of(paths: DataFrame, rules: list[tuple[str, str, str, float, float]]) -> DataFrame:
    """path, key, mode, atol, rtol: the rule of each path and key, from the first glob that matches the path; null mode where
    none has the key. rules: (glob, key, mode, atol, rtol), a short list that is broadcast."""
    spark, globs = paths.sparkSession, list(dict.fromkeys(r[0] for r in rules))
    index = F.lit(None).cast("int")
    for k in reversed(range(len(globs))):
        index = F.when(F.col("path").rlike(glob_pattern(globs[k])), F.lit(k)).otherwise(index)
    listed = spark.createDataFrame([(globs.index(g), key, mode, float(a), float(r)) for g, key, mode, a, r in rules], "spec int, key string, mode string, atol double, rtol double")
    return paths.withColumn("spec", index).join(F.broadcast(listed), ["spec", "key"], "left").drop("spec")


def compare_tables(pairs: dict[str, tuple[DataFrame, DataFrame]], rules: dict[str, tuple[list[str], str, float, float]]) -> DataFrame:
    """A row for each table of a run and its golden counterpart: schemas alike, required columns there, rows on one side alone,
    rows compared and out of tolerance, largest differences. rules: keys, value, atol, rtol of each table."""
    out = None
    for name, (run, golden) in pairs.items():
        keys, x, atol, rtol = rules[name]
        missing = sorted({*keys, x} - set(run.columns))
        told = golden.limit(0).select(F.lit(0)).agg(F.count("*").alias("z")).select(*(F.lit(None).cast("long").alias(c) for c in ("only_run", "only_golden", "compared", "failed")), *(F.lit(None).cast("double").alias(c) for c in ("max_abs", "max_rel")))
        if not missing:
            told = compare_numeric(run, golden, keys, x, atol, rtol)
        row = told.select(F.lit(name).alias("name"), F.lit(run.dtypes == golden.dtypes).alias("alike"), F.lit(",".join(missing)).alias("missing"), "*")
        out = row if out is None else out.unionByName(row)
    return out


def folder_tables(spark, root: str, globs: list[str]) -> list[str]:
    """Names of the tables in a folder of tables that a glob names, in order."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    names = sorted(s.getPath().getName() for s in found if s.isDirectory())
    return [n for n in names if not n.startswith("_") and any(re.match(glob_pattern(g), n) for g in globs)]


def compare_folders(spark, run: str, golden: str, globs: list[str], rules: list[tuple[str, list[str], str, float, float]]) -> DataFrame:
    """As ``compare_tables`` for every table of the golden folder that a glob names; a table that the run lacks is missing as a
    whole. rules: (glob, keys, value, atol, rtol), the first that names a table holds; a table without one is an error."""
    names, there = folder_tables(spark, golden, globs), set(folder_tables(spark, run, ["*"]))
    pairs, chosen = {}, {}
    for name in names:
        rule = next((r[1:] for r in rules if re.match(glob_pattern(r[0]), name)), None)
        if rule is None:
            raise ValueError(f"no rule for {name}")
        right = spark.read.parquet(f"{golden}/{name}")
        left = spark.read.parquet(f"{run}/{name}") if name in there else right.limit(0).select()
        pairs[name], chosen[name] = (left, right), rule
    if not pairs:
        raise ValueError(f"{golden} has no table that {globs} name")
    return compare_tables(pairs, chosen)


def inspect_folder(spark, root: str, globs: tuple[str, ...] = ("*",)) -> DataFrame:
    """table, column, type, n, n_null, low, high (as text) of every column of the tables of a folder."""
    out = None
    for name in folder_tables(spark, root, list(globs)):
        df = spark.read.parquet(f"{root}/{name}")
        stats = [F.struct(F.lit(c).alias("column"), F.lit(t).alias("type"), F.count("*").alias("n"), F.count_if(F.col(c).isNull()).alias("n_null"), F.min(c).cast("string").alias("low"), F.max(c).cast("string").alias("high")) for c, t in df.dtypes if not t.startswith(("map", "variant"))]
        if stats:
            told = df.agg(F.array(*stats).alias("s")).select(F.lit(name).alias("table"), F.explode("s").alias("s")).select("table", "s.*")
            out = told if out is None else out.unionByName(told)
    if out is None:
        raise ValueError(f"{root} has no tables")
    return out


def figure_histogram(df: DataFrame, x: str, bins: int = 60, low: float = 0.02, high: float = 0.98) -> DataFrame:
    """bin (from 1), n of the values between the limits that a map shows, two and 98 per cent; both ends included."""
    ends = quantiles(df, x, {"lo": low, "hi": high})
    inside = df.crossJoin(F.broadcast(ends)).filter(F.col(x).between(F.col("lo"), F.col("hi")))
    place = F.least(F.lit(bins), F.floor((F.col(x) - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins) + 1)
    return inside.groupBy(F.coalesce(place, F.lit(1)).cast("long").alias("bin")).agg(F.count("*").alias("n"))


def field_statistics(df: DataFrame, x: str, by: list[str] | None = None, percentiles=(0.02, 0.5, 0.98)) -> DataFrame:
    v = F.col(x)
    sums = df.groupBy(*(by or [])).agg(F.count(v).alias("n"), F.avg(v).alias("mean"), F.min(v).alias("min"), F.max(v).alias("max"), F.stddev_pop(v).alias("std"))
    told = quantiles(df, x, {f"p{round(100 * p):02d}": p for p in percentiles}, by)
    return sums.join(F.broadcast(told), by, "left") if by else sums.crossJoin(F.broadcast(told))


def without_outliers(df: DataFrame, x: str, kind: str = "iqr") -> DataFrame:
    """Rows within 1.5 quartile ranges of the quartiles, or within three deviations of the mean; bounds are one broadcast row."""
    if kind == "none":
        return df
    if kind == "iqr":
        bounds = quantiles(df, x, {"q1": 0.25, "q3": 0.75}).withColumn("range", F.col("q3") - F.col("q1"))
        bounds = bounds.select((F.col("q1") - 1.5 * F.col("range")).alias("lo"), (F.col("q3") + 1.5 * F.col("range")).alias("hi"), (F.col("range") == 0).alias("flat"))
    elif kind == "z-score":
        bounds = df.agg(F.avg(x).alias("m"), F.stddev_pop(x).alias("s")).select((F.col("m") - 3 * F.col("s")).alias("lo"), (F.col("m") + 3 * F.col("s")).alias("hi"), (F.col("s") == 0).alias("flat"))
    else:
        raise ValueError("outlier filters are none, iqr and z-score")
    return df.crossJoin(F.broadcast(bounds)).filter(F.col("flat") | F.col(x).between(F.col("lo"), F.col("hi"))).drop("lo", "hi", "flat")


def compare_fields(a, b) -> list[Column]:
    d = a - b
    return [F.avg(d).alias("bias"), F.sqrt(F.avg(d * d)).alias("rmse"), F.avg(F.abs(d)).alias("mae")]


def match_points(left: DataFrame, right: DataFrame, decimals: int) -> DataFrame:
    """Points that share rounded coordinates; of several on one side, the last by id."""
    key = [F.floor(F.col(c) * 10.0**decimals + 0.5).alias(f"k{c}") for c in ("lon", "lat")]
    one = lambda df, name: df.groupBy(*key).agg(F.max("pt").alias(name))
    return one(left, "pt_run").join(one(right, "pt_other"), ["klon", "klat"]).select("pt_run", "pt_other")
