"""Displacement series: differences, smoothing, velocities, trends, network inversion and corrections.

Small matrices (epochs by epochs, interferograms by epochs) are solved on the driver and joined as long tables that are
broadcast: their size is fixed by the network. What grows with the points is only joined to them and summed.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fringelake.operators.robust import MAD_SCALE, median, quantiles


def differences(ts: DataFrame, key: str, day: str, x: str) -> DataFrame:
    order = Window.partitionBy(key).orderBy(day)
    return ts.withColumn("d_v", F.col(x) - F.lag(x).over(order)).withColumn("d_day", F.col(day) - F.lag(day).over(order)).filter("d_v IS NOT NULL")


def cumulative(ts: DataFrame, key: str, day: str, x: str) -> DataFrame:
    """Displacement since the first epoch of each point."""
    first = ts.groupBy(key).agg(F.min_by(x, day).alias("first"))
    return ts.join(first, key).withColumn("cum", F.col(x) - F.col("first")).drop("first")


def endpoint_velocity(ts: DataFrame, key: str, day: str, x: str) -> DataFrame:
    told = ts.groupBy(key).agg(F.min_by(x, day).alias("v0"), F.max_by(x, day).alias("v1"), (F.max(day) - F.min(day)).alias("span"))
    return told.filter("span > 0").select(key, ((F.col("v1") - F.col("v0")) / F.col("span") * 365.25).alias("endpoint"))


def line_fit(x: Column, y: Column, w: Column | None = None) -> tuple[Column, Column]:
    """(intercept, slope) aggregates of a weighted straight line, by sums that combine on the map side."""
    w = F.lit(1.0) if w is None else w
    s, sx, sy = F.sum(w), F.sum(w * x), F.sum(w * y)
    sxx, sxy = F.sum(w * x * x), F.sum(w * x * y)
    slope = (s * sxy - sx * sy) / (s * sxx - sx * sx)
    return (sy - slope * sx) / s, slope


def velocity(ts: DataFrame, key: str, day: str, x: str, w: str | None = None, least: int = 3) -> DataFrame:
    """key, velocity a year, rms of the fit, n. Times count from the first day of the table, so that sums of squares of large
    day numbers do not swallow their differences."""
    began = ts.agg(F.min(day).alias("__began"))
    t = (F.col(day) - F.col("__began")) / 365.25
    near = ts.crossJoin(F.broadcast(began))
    intercept, slope = line_fit(t, F.col(x), F.col(w) if w else None)
    fit = near.groupBy(key).agg(intercept.alias("c"), slope.alias("velocity"), F.count("*").alias("n")).filter(F.col("n") >= least)
    rest = near.join(fit, key).withColumn("r", F.col(x) - F.col("c") - F.col("velocity") * t)
    return rest.groupBy(key).agg(F.first("velocity").alias("velocity"), F.sqrt(F.avg(F.col("r") * F.col("r"))).alias("rms"), F.first("n").alias("n"))


def gls_velocity(ts: DataFrame, days: list[float], covariance: np.ndarray) -> DataFrame:
    """ps_id, c, velocity, rms of x = c + velocity * years over all epochs (image_ix from 1, in the order of `days`), by
    generalised least squares: the two rows of the projector are a broadcast table with a row for each epoch."""
    t = (np.asarray(days, float) - days[0]) / 365.25
    p = projector(np.c_[np.ones(len(t)), t], covariance)
    epochs = ts.sparkSession.createDataFrame([(k + 1, float(t[k]), float(p[0, k]), float(p[1, k])) for k in range(len(t))], "image_ix long, t double, p0 double, p1 double")
    met = ts.join(F.broadcast(epochs), "image_ix")
    fit = met.groupBy("ps_id").agg(F.sum(F.col("p0") * F.col("x")).alias("c"), F.sum(F.col("p1") * F.col("x")).alias("velocity"))
    rest = met.join(fit, "ps_id").withColumn("r", F.col("x") - F.col("c") - F.col("velocity") * F.col("t"))
    return rest.groupBy("ps_id").agg(F.first("c").alias("c"), F.first("velocity").alias("velocity"), F.sqrt(F.avg(F.col("r") * F.col("r"))).alias("rms"))


def period_velocity(ts: DataFrame, key: str, period: Column, day: str, x: str, least: int, span: float) -> DataFrame:
    """key, period, velocity, n, span of periods with enough observations over enough days."""
    _, slope = line_fit(F.col(day) / 365.25, F.col(x))
    told = ts.groupBy(key, period.alias("period")).agg(slope.alias("velocity"), F.count("*").alias("n"), (F.max(day) - F.min(day)).alias("span"))
    return told.filter((F.col("n") >= least) & (F.col("span") >= span))


def slope_through_origin(df: DataFrame, by: list[str], x: str, y: str, w: str) -> DataFrame:
    """by, slope = sum wxy / sum wxx; infinite weights are the only ones that count where there are any; 0 if nothing does."""
    endless = F.max(F.col(w) == math.inf)
    told = df.join(df.groupBy(*by).agg(endless.alias("endless")), by)
    ok = ~F.isnan(x) & ~F.isnan(y) & (F.col(w) > 0)
    weight = F.when(~ok, 0.0).when(F.col("endless"), (F.col(w) == math.inf).cast("double")).otherwise(F.col(w))
    sums = told.groupBy(*by).agg(F.sum(weight * F.col(x) * F.col(y)).alias("xy"), F.sum(weight * F.col(x) * F.col(x)).alias("xx"))
    return sums.select(*by, F.when(F.col("xx") > 0, F.col("xy") / F.col("xx")).otherwise(0.0).alias("slope"))


def plane(df: DataFrame, by: list[str], value: str, least: int = 6) -> DataFrame:
    """by, a, b, c of value = a x/1000 + b y/1000 + c by Cramer's rule on normal-equation sums: one partial aggregation."""
    x, y, v = F.col("x") / 1000, F.col("y") / 1000, F.col(value)
    s = df.groupBy(*by).agg(
        F.count("*").cast("double").alias("n"), *(F.sum(e).alias(k) for k, e in (("x", x), ("y", y), ("xx", x * x), ("xy", x * y), ("yy", y * y), ("v", v), ("xv", x * v), ("yv", y * v)))
    ).filter(F.col("n") >= least)
    n, sx, sy, xx, xy, yy, sv, xv, yv = (F.col(c) for c in ("n", "x", "y", "xx", "xy", "yy", "v", "xv", "yv"))
    det = xx * (yy * n - sy * sy) - xy * (xy * n - sy * sx) + sx * (xy * sy - yy * sx)
    a = xv * (yy * n - sy * sy) - xy * (yv * n - sy * sv) + sx * (yv * sy - yy * sv)
    b = xx * (yv * n - sv * sy) - xv * (xy * n - sy * sx) + sx * (xy * sv - yv * sx)
    c = xx * (yy * sv - yv * sy) - xy * (xy * sv - yv * sx) + xv * (xy * sy - yy * sx)
    return s.select(*by, (a / det).alias("a"), (b / det).alias("b"), (c / det).alias("c"))


def deramped(df: DataFrame, by: list[str], value: str) -> DataFrame:
    told = df.join(F.broadcast(plane(df, by, value)), by)
    return told.withColumn("flat", F.col(value) - (F.col("a") * F.col("x") / 1000 + F.col("b") * F.col("y") / 1000 + F.col("c"))).drop("a", "b", "c")


def design_matrix(ifgs: list[tuple[int, int]], n_images: int) -> np.ndarray:
    """-1 at the first, +1 at the second acquisition of each interferogram; the first image is the reference."""
    g = np.zeros((len(ifgs), n_images))
    for k, (a, b) in enumerate(ifgs):
        g[k, a - 1], g[k, b - 1] = -1, 1
    return g[:, 1:]


def projector(g: np.ndarray, covariance: np.ndarray | None = None, least: float = 1e-3) -> np.ndarray:
    """(G' C^-1 G)^-1 G' C^-1; the covariance gets hundredths of unity on its diagonal until it is well conditioned."""
    if np.linalg.matrix_rank(g) < g.shape[1]:
        raise ValueError("the network does not determine every epoch")
    c = np.eye(len(g)) if covariance is None else covariance.copy()
    while 1 / np.linalg.cond(c, 1) < least:
        c += 0.01 * np.eye(len(g))
    w = np.linalg.solve(c, g).T
    return np.linalg.solve(w @ g, w)


def invert(phase: DataFrame, p: np.ndarray) -> DataFrame:
    """ps_id, image_ix, phi: the projector, a broadcast long table as large as the network, joined on interferograms and
    summed for each point and epoch."""
    spark = phase.sparkSession
    rows = [(j + 1, i + 2, float(p[i, j])) for i in range(p.shape[0]) for j in range(p.shape[1])]
    long = spark.createDataFrame(rows, "ifg_id long, image_ix long, p double")
    return phase.join(F.broadcast(long), "ifg_id").groupBy("ps_id", "image_ix").agg(F.sum(F.col("p") * F.col("phi")).alias("phi"))


def covariance(phase: DataFrame) -> DataFrame:
    """i, j, cov of interferograms i <= j over the points that have both. Phases meet once, as one array a point, and blocks of
    points are summed as products of matrices; what moves then is a row for each pair of the network and task."""
    import pandas as pd

    means = {r["ifg_id"]: r["m"] for r in phase.groupBy("ifg_id").agg(F.avg("phi").alias("m")).collect()}  # a row for each interferogram
    ids = sorted(means)
    middle, (i, j) = np.array([means[k] for k in ids], float), np.triu_indices(len(ids))

    def sums(batches):
        n, sx, sxy = (np.zeros((len(ids), len(ids))) for _ in range(3))
        for pdf in batches:
            for start in range(0, len(pdf), 2000):
                x = np.vstack(pdf["phi"].iloc[start : start + 2000]).astype(float) - middle
                there = np.isfinite(x).astype(float)
                x = np.nan_to_num(x)
                n += there.T @ there
                sx += x.T @ there
                sxy += x.T @ x
        yield pd.DataFrame({"a": i, "b": j, "n": n[i, j], "sx": sx[i, j], "sy": sx[j, i], "sxy": sxy[i, j]})

    rows = phase.groupBy("ps_id").agg(F.map_from_entries(F.collect_list(F.struct("ifg_id", "phi"))).alias("m"))
    arrays = rows.select(F.array(*(F.coalesce(F.try_element_at("m", F.lit(k).cast(phase.schema["ifg_id"].dataType)), F.lit(float("nan"))) for k in ids)).alias("phi"))
    parts = arrays.mapInPandas(sums, "a int, b int, n double, sx double, sy double, sxy double")
    told = parts.groupBy("a", "b").agg(*(F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxy"))).filter("n > 0")
    names = phase.sparkSession.createDataFrame(list(enumerate(ids)), "k int, ifg_id long")
    name = lambda c, out: names.select(F.col("k").alias(c), F.col("ifg_id").alias(out))
    cov = F.when(F.col("n") > 1, (F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n")) / (F.col("n") - 1))
    return told.join(F.broadcast(name("a", "i")), "a").join(F.broadcast(name("b", "j")), "b").select("i", "j", cov.alias("cov"))


def reference_centred(phase: DataFrame, reference: DataFrame) -> DataFrame:
    """Phases less the mean of the reference points in each column; the means are broadcast."""
    means = phase.join(reference, "ps_id", "left_semi").groupBy("ifg_id").agg(F.avg("phi").alias("m"))
    return phase.join(F.broadcast(means), "ifg_id").select("ps_id", "ifg_id", (F.col("phi") - F.col("m")).alias("phi"))


def scla(phase: DataFrame, ifgs: DataFrame) -> DataFrame:
    """ps_id, k, c of phi = c + k * bperp: the height-error model, by sums for each point."""
    met = phase.join(F.broadcast(ifgs.select("ifg_id", "bperp")), "ifg_id")
    c, k = line_fit(F.col("bperp"), F.col("phi"))
    return met.groupBy("ps_id").agg(k.alias("k"), c.alias("c"))


def temporal_highpass(ts: DataFrame, key: str, day: str, x: str, window: float, master: float | None = None) -> DataFrame:
    """Values less their Gaussian-weighted mean in time. A point's epochs meet once, as one array, in which each is weighed
    against all: squared in the epochs of a point, with no rows for their pairs. The master's day has no weight."""
    rest = [c for c in ts.columns if c != key]
    series_ = ts.groupBy(key).agg(F.collect_list(F.struct(*rest)).alias("s"))
    near = lambda a, b: F.exp(-(a[day] - b[day]) * (a[day] - b[day]) / (2 * window * window))
    w = near if master is None else lambda a, b: F.when(b[day] == master, 0.0).otherwise(near(a, b))
    add = lambda e: lambda t, o: F.struct((t["w"] + w(e, o)).alias("w"), (t["x"] + w(e, o) * o[x]).alias("x"))
    none = F.struct(F.lit(0.0).alias("w"), F.lit(0.0).alias("x"))
    low = lambda e: F.aggregate("s", none, add(e), lambda t: t["x"] / t["w"])
    told = series_.select(key, F.explode(F.transform("s", lambda e: F.struct(*(e[c].alias(c) for c in rest), low(e).alias("low")))).alias("e"))
    return told.select(key, "e.*").withColumn("high", F.col(x) - F.col("low"))


def topofit_trials(phase: DataFrame, ifgs: DataFrame, wraps: float) -> DataFrame:
    """ps_id, trial, k, coh: the trial slope of largest coherence, the smallest on ties, of positive and negative ones the
    negative. Phases meet once, as one array a point; trials are columns of a matrix, not rows."""
    import pandas as pd

    n = math.ceil(8 * wraps)
    base = {r["ifg_id"]: r["bperp"] for r in ifgs.select("ifg_id", "bperp").collect()}  # a row for each interferogram
    span, trials = max(base.values()) - min(base.values()), np.arange(-n, n + 1)
    slopes = trials / 8 * 2 * math.pi / span
    order = np.lexsort((trials, np.abs(trials)))  # the first of the largest counts

    def best(batches):
        for pdf in batches:
            rows = []
            for ps, s in zip(pdf["ps_id"], pdf["s"]):
                phi, b = np.array([e["phi"] for e in s], float), np.array([e["b"] for e in s], float)
                coh = np.abs(np.exp(1j * (phi[:, None] - b[:, None] * slopes)).sum(axis=0)) / len(phi)
                k = order[np.argmax(np.round(coh[order], 9))]
                rows.append((ps, int(trials[k]), float(slopes[k]), float(coh[k])))
            yield pd.DataFrame(rows, columns=["ps_id", "trial", "k", "coh"])

    met = phase.join(F.broadcast(ifgs.select("ifg_id", F.col("bperp").alias("b"))), "ifg_id")
    return met.groupBy("ps_id").agg(F.collect_list(F.struct("phi", "b")).alias("s")).mapInPandas(best, "ps_id long, trial long, k double, coh double")



def scla_with_time(phase: DataFrame, ifgs: DataFrame) -> DataFrame:
    """ps_id, k of phi = c + k * bperp + v * dt: the height-error model of a small-baseline network, with the velocity fitted
    along; moments about the means, combined on the map side."""
    met = phase.join(F.broadcast(ifgs.select("ifg_id", "bperp", "dt")), "ifg_id")
    s = met.groupBy("ps_id").agg(
        F.var_pop("bperp").alias("bb"), F.var_pop("dt").alias("tt"), F.covar_pop("bperp", "dt").alias("bt"), F.covar_pop("bperp", "phi").alias("bp"), F.covar_pop("dt", "phi").alias("tp")
    )
    det = F.col("bb") * F.col("tt") - F.col("bt") * F.col("bt")
    return s.select("ps_id", F.when(det > 0, (F.col("bp") * F.col("tt") - F.col("tp") * F.col("bt")) / det).alias("k"))


def scla_single_master(ts: DataFrame, master_day: float) -> DataFrame:
    """ps_id, k, c, v of series (ps_id, day, b, phi): k from the consecutive differences of phase over those of baseline, then
    offset at the master's day and rate a day of what k leaves."""
    order = Window.partitionBy("ps_id").orderBy("day")
    steps = ts.withColumn("db", F.col("b") - F.lag("b").over(order)).withColumn("dp", F.col("phi") - F.lag("phi").over(order)).filter("db IS NOT NULL")
    slope = steps.groupBy("ps_id").agg(F.regr_slope("dp", "db").alias("k"))
    rest = ts.join(slope, "ps_id").withColumn("y", F.col("phi") - F.col("k") * F.col("b")).withColumn("t", F.col("day") - master_day)
    return rest.groupBy("ps_id").agg(F.first("k").alias("k"), F.regr_intercept("y", "t").alias("c"), F.regr_slope("y", "t").alias("v"))


def scn_from(high: DataFrame, smooth: DataFrame, master: int) -> DataFrame:
    """ps_id, image_ix, scn: spatially smoothed values less those of the first point, nought at the master. The first point's
    values are a row for each epoch."""
    first = smooth.groupBy("image_ix").agg(F.min_by("v", "ps_id").alias("first"))
    told = smooth.join(F.broadcast(first), "image_ix")
    return told.select("ps_id", "image_ix", F.when(F.col("image_ix") == master, 0.0).otherwise(F.col("v") - F.col("first")).alias("scn"))


def corrected(ts: DataFrame, model: DataFrame, scn: DataFrame, reference: DataFrame, master: int) -> DataFrame:
    """ps_id, image_ix, phi: phases (ps_id, image_ix, b, phi) less k * b, c and spatial noise, nought at the master, less the
    reference points' mean of each epoch."""
    met = ts.join(model.select("ps_id", "k", "c"), "ps_id").join(scn, ["ps_id", "image_ix"])
    rest = F.col("phi") - F.col("k") * F.col("b") - F.col("c") - F.col("scn")
    told = met.select("ps_id", "image_ix", F.when(F.col("image_ix") == master, 0.0).otherwise(rest).alias("phi"))
    means = told.join(reference.select("ps_id"), "ps_id", "left_semi").groupBy("image_ix").agg(F.avg("phi").alias("m"))
    return told.join(F.broadcast(means), "image_ix").select("ps_id", "image_ix", (F.col("phi") - F.col("m")).alias("phi"))


def delay_phases(delays: DataFrame, incidence: DataFrame, reference: DataFrame, master: int, wavelength: float) -> DataFrame:
    """ps_id, image_ix, corr: zenith delays in metres along the line of sight, less the reference points' median of each epoch,
    as phase against the master's. Reference points are few; their medians are a row for each epoch."""
    los = delays.join(incidence, "ps_id").select("ps_id", "image_ix", (F.col("zenith") / F.cos("theta")).alias("d"))
    middle = los.join(reference.select("ps_id"), "ps_id", "left_semi").groupBy("image_ix").agg(F.percentile("d", F.lit(0.5)).alias("m"))
    level = los.join(F.broadcast(middle), "image_ix").select("ps_id", "image_ix", (F.col("d") - F.col("m")).alias("d"))
    at_master = level.filter(F.col("image_ix") == master).select("ps_id", F.col("d").alias("d0"))
    return level.join(at_master, "ps_id").select("ps_id", "image_ix", (4 * math.pi / wavelength * (F.col("d") - F.col("d0"))).alias("corr"))


def delay_sign(phases: DataFrame, corr: DataFrame, master: int) -> DataFrame:
    """One row: the medians over epochs of the robust scale of phases less and plus the correction, and the sign of the lower."""
    met = phases.join(corr, ["ps_id", "image_ix"]).filter(F.col("image_ix") != master)
    sides = met.select("image_ix", F.explode(F.create_map(F.lit("subtract"), F.col("phi") - F.col("corr"), F.lit("add"), F.col("phi") + F.col("corr"))).alias("sign", "x"))
    by = ["image_ix", "sign"]
    apart = sides.join(F.broadcast(quantiles(sides, "x", {"m": 0.5}, by)), by).select(*by, F.abs(F.col("x") - F.col("m")).alias("d"))
    scale = quantiles(apart, "d", {"s": 0.5}, by).withColumn("s", MAD_SCALE * F.col("s"))
    told = scale.groupBy("sign").agg(median("s").alias("s")).groupBy().agg(F.max_by("s", F.col("sign") == "subtract").alias("score_subtract"), F.max_by("s", F.col("sign") == "add").alias("score_add"))
    return told.withColumn("sign", F.when(F.col("score_subtract") <= F.col("score_add"), "subtract").otherwise("add"))


def with_delay(phases: DataFrame, corr: DataFrame, sign: DataFrame) -> DataFrame:
    """ps_id, image_ix, phi: phases corrected with the chosen sign, one broadcast row."""
    met = phases.join(corr, ["ps_id", "image_ix"]).crossJoin(F.broadcast(sign.select("sign")))
    return met.select("ps_id", "image_ix", F.when(F.col("sign") == "add", F.col("phi") + F.col("corr")).otherwise(F.col("phi") - F.col("corr")).alias("phi"))


def design_table(ifgs: list[tuple[int, int]], n_images: int) -> list[tuple[int, int, float]]:
    """(row, image, value) of the design matrix, the reference image's column left out."""
    return [(k + 1, image, value) for k, (a, b) in enumerate(ifgs) for image, value in ((a, -1.0), (b, 1.0)) if 1 < image <= n_images]


def fitted_series(fits: DataFrame, days: DataFrame) -> DataFrame:
    """Values of each fit (c, slope a day) at each day; the days are as few as the acquisitions and are broadcast."""
    return fits.crossJoin(F.broadcast(days)).withColumn("value", F.col("c") + F.col("slope") * F.col("day"))


def misfit(phase: DataFrame, epochs: DataFrame, ifgs: DataFrame) -> DataFrame:
    """ps_id, ifg_id, r: phases less the difference of the inverted epochs, the first image being nought."""
    side = lambda name: epochs.select("ps_id", F.col("image_ix").alias(name), F.col("phi").alias(f"x{name}"))
    met = phase.join(F.broadcast(ifgs.select("ifg_id", "a", "b")), "ifg_id").join(side("a"), ["ps_id", "a"], "left").join(side("b"), ["ps_id", "b"], "left")
    return met.select("ps_id", "ifg_id", (F.col("phi") - F.coalesce("xb", F.lit(0.0)) + F.coalesce("xa", F.lit(0.0))).alias("r"))
