"""Queries on series: differences, velocities, trends, inversion, corrections, and verification of results."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from fringelake.functions import geometry, phase
from fringelake.functions.phase import r6
from fringelake.operators import robust, series, verify
from fringelake.plans.fixtures import WAVELENGTH
from fringelake.plans.registry import query


@query("series_diff", "fx_ts", "SELECT pt, day, round(v - lag(v) OVER w, 6) + 0.0 AS d_v, CAST(day - lag(day) OVER w AS INTEGER) AS d_day FROM fx_ts WINDOW w AS (PARTITION BY pt ORDER BY day) QUALIFY lag(v) OVER w IS NOT NULL")
def _(fx, spark):
    return series.differences(fx.fx_ts, "pt", "day", "v").select("pt", "day", r6("d_v").alias("d_v"), "d_day")


@query("cumulative_displacement", "fx_ts", "SELECT pt, day, round(v - first_value(v) OVER (PARTITION BY pt ORDER BY day), 6) + 0.0 AS cum FROM fx_ts")
def _(fx, spark):
    return series.cumulative(fx.fx_ts, "pt", "day", "v").select("pt", "day", r6("cum").alias("cum"))


@query("endpoint_velocity", "fx_ts", "SELECT pt, round((arg_max(v, day) - arg_min(v, day)) / (max(day) - min(day)) * 365.25, 4) + 0.0 AS endpoint FROM fx_ts GROUP BY pt HAVING max(day) > min(day)")
def _(fx, spark):
    return series.endpoint_velocity(fx.fx_ts, "pt", "day", "v").select("pt", (F.round("endpoint", 4) + F.lit(0.0)).alias("endpoint"))


@query(
    "velocity_ols", "fx_ts",
    "WITH f AS (SELECT pt, regr_slope(v, day / 365.25) AS b, regr_intercept(v, day / 365.25) AS a, count(*) AS n FROM fx_ts GROUP BY pt HAVING count(*) >= 3)"
    " SELECT pt, round(any_value(b), 4) + 0.0 AS velocity, round(sqrt(avg(power(v - a - b * (day / 365.25), 2))), 4) + 0.0 AS rms, any_value(n) AS n FROM fx_ts JOIN f USING (pt) GROUP BY pt",
)
def _(fx, spark):
    return series.velocity(fx.fx_ts, "pt", "day", "v").select("pt", (F.round("velocity", 4) + F.lit(0.0)).alias("velocity"), (F.round("rms", 4) + F.lit(0.0)).alias("rms"), "n")


@query(
    "velocity_weighted", "fx_ts",
    "WITH s AS (SELECT pt, count(*) AS n, sum(w) AS s, sum(w * t) AS st, sum(w * v) AS sv, sum(w * t * t) AS tt, sum(w * t * v) AS tv FROM"
    " (SELECT pt, day / 365.25 AS t, v, 1 / (1 + day % 3) AS w FROM fx_ts) GROUP BY pt HAVING count(*) >= 3)"
    " SELECT pt, round((s * tv - st * sv) / (s * tt - st * st), 3) + 0.0 AS velocity FROM s",
)
def _(fx, spark):
    ts = fx.fx_ts.withColumn("w", 1 / (1 + F.col("day") % 3))
    return series.velocity(ts, "pt", "day", "v", "w").select("pt", (F.round("velocity", 3) + F.lit(0.0)).alias("velocity"))


@query(
    "annual_velocity", "fx_ts",
    "SELECT pt, CAST(floor(day / 10) AS BIGINT) AS period, round(regr_slope(v, day / 365.25), 3) + 0.0 AS velocity, count(*) AS n, CAST(max(day) - min(day) AS INTEGER) AS span"
    " FROM fx_ts GROUP BY 1, 2 HAVING count(*) >= 4 AND max(day) - min(day) >= 5",
)
def _(fx, spark):
    """Ten-day periods stand for years in a month of data."""
    told = series.period_velocity(fx.fx_ts, "pt", F.floor(F.col("day") / 10), "day", "v", 4, 5)
    return told.select("pt", "period", (F.round("velocity", 3) + F.lit(0.0)).alias("velocity"), "n", "span")


@query(
    "temporal_gaussian_highpass", "fx_ts",
    "WITH w AS (SELECT a.pt, a.day, a.v, sum(exp(-power(a.day - b.day, 2) / (2 * 49)) * b.v) / sum(exp(-power(a.day - b.day, 2) / (2 * 49))) AS low FROM fx_ts a JOIN fx_ts b USING (pt) GROUP BY a.pt, a.day, a.v)"
    " SELECT pt, day, round(v - low, 6) + 0.0 AS high FROM w",
)
def _(fx, spark):
    return series.temporal_highpass(fx.fx_ts, "pt", "day", "v", 7.0).select("pt", "day", r6("high").alias("high"))


RAMP = "pv AS (SELECT p.ps_id, ifg_id, p.x / 1000 AS x, p.y / 1000 AS y, phi AS v FROM fx_phase JOIN fx_ps p USING (ps_id))"


@query(
    "plane_deramp", "fx_ps fx_phase",
    f"WITH {RAMP}, s AS (SELECT ifg_id, count(*) AS n, avg(x) AS mx, avg(y) AS my, avg(v) AS mv, covar_pop(x, x) AS xx, covar_pop(x, y) AS xy, covar_pop(y, y) AS yy, covar_pop(x, v) AS xv, covar_pop(y, v) AS yv FROM pv GROUP BY ifg_id),"
    " f AS (SELECT ifg_id, (xv * yy - yv * xy) / (xx * yy - xy * xy) AS a, (yv * xx - xv * xy) / (xx * yy - xy * xy) AS b, mx, my, mv FROM s)"
    " SELECT ps_id, ifg_id, round(v - (a * (x - mx) + b * (y - my) + mv), 5) + 0.0 AS flat FROM pv JOIN f USING (ifg_id)",
)
def _(fx, spark):
    met = fx.fx_phase.join(fx.fx_ps.select("ps_id", "x", "y"), "ps_id")
    return series.deramped(met, ["ifg_id"], "phi").select("ps_id", "ifg_id", (F.round("flat", 5) + F.lit(0.0)).alias("flat"))


#: The network of the fixtures, as numbers: pairs of 19 epochs that are 1 to 4 steps apart, the first 64 in order.
PAIRS = [(a, b) for a in range(1, 20) for b in range(a + 1, min(19, a + 4) + 1)][:64]


def projector() -> np.ndarray:
    last = max(b for _, b in PAIRS)
    return series.projector(series.design_matrix(PAIRS, last))


def _projector_rows() -> str:
    p = projector()
    return ", ".join(f"({j + 1}, {i + 2}, {p[i, j]!r}::DOUBLE)" for i in range(p.shape[0]) for j in range(p.shape[1]))


@query(
    "gls_projection", "fx_phase",
    f"WITH pr(ifg_id, image_ix, p) AS (VALUES {_projector_rows().replace('np.float64(', '').replace(')::', '::')}) SELECT ps_id, CAST(image_ix AS BIGINT) AS image_ix, round(sum(p * phi), 6) + 0.0 AS phi FROM fx_phase JOIN pr USING (ifg_id) GROUP BY ps_id, image_ix",
)
def _(fx, spark):
    return series.invert(fx.fx_phase, projector()).withColumn("phi", r6("phi"))


@query("ifg_covariance", "fx_phase", "SELECT p.ifg_id AS i, q.ifg_id AS j, round(covar_samp(p.phi, q.phi), 6) + 0.0 AS cov FROM fx_phase p JOIN fx_phase q USING (ps_id) WHERE p.ifg_id <= q.ifg_id GROUP BY 1, 2")
def _(fx, spark):
    return series.covariance(fx.fx_phase).withColumn("cov", r6("cov"))


@query(
    "reference_centering", "fx_ps fx_phase",
    "WITH m AS (SELECT ifg_id, avg(phi) AS m FROM fx_phase JOIN fx_ps USING (ps_id) WHERE x < 200 AND y < 200 GROUP BY ifg_id) SELECT ps_id, ifg_id, round(phi - m, 6) + 0.0 AS phi FROM fx_phase JOIN m USING (ifg_id)",
)
def _(fx, spark):
    return series.reference_centred(fx.fx_phase, fx.fx_ps.filter("x < 200 AND y < 200").select("ps_id")).withColumn("phi", r6("phi"))


@query("scla_model", "fx_phase fx_ifgs", "SELECT ps_id, round(regr_slope(phi, bperp), 8) + 0.0 AS k, round(regr_intercept(phi, bperp), 6) + 0.0 AS c FROM fx_phase JOIN fx_ifgs USING (ifg_id) GROUP BY ps_id")
def _(fx, spark):
    return series.scla(fx.fx_phase, fx.fx_ifgs).select("ps_id", (F.round("k", 8) + F.lit(0.0)).alias("k"), r6("c").alias("c"))


@query(
    "corrected_phase", "fx_phase fx_ifgs",
    "WITH k AS (SELECT ps_id, regr_slope(phi, bperp) AS k, regr_intercept(phi, bperp) AS c FROM fx_phase JOIN fx_ifgs USING (ifg_id) GROUP BY ps_id),"
    " r AS (SELECT ps_id, ifg_id, phi - k * bperp - c AS r FROM fx_phase JOIN fx_ifgs USING (ifg_id) JOIN k USING (ps_id)) SELECT ps_id, ifg_id, round(r - avg(r) OVER (PARTITION BY ifg_id), 6) + 0.0 AS phi FROM r",
)
def _(fx, spark):
    model = series.scla(fx.fx_phase, fx.fx_ifgs)
    met = fx.fx_phase.join(F.broadcast(fx.fx_ifgs.select("ifg_id", "bperp")), "ifg_id").join(model, "ps_id")
    rest = met.select("ps_id", "ifg_id", (F.col("phi") - F.col("k") * F.col("bperp") - F.col("c")).alias("phi"))
    means = rest.groupBy("ifg_id").agg(F.avg("phi").alias("m"))
    return rest.join(F.broadcast(means), "ifg_id").select("ps_id", "ifg_id", r6(F.col("phi") - F.col("m")).alias("phi"))


@query("weighted_slope", "fx_phase fx_ifgs", "SELECT ps_id, round(sum(dt * bperp * phi) / sum(dt * bperp * bperp), 8) + 0.0 AS slope FROM fx_phase JOIN fx_ifgs USING (ifg_id) GROUP BY ps_id")
def _(fx, spark):
    met = fx.fx_phase.join(F.broadcast(fx.fx_ifgs), "ifg_id")
    return series.slope_through_origin(met, ["ps_id"], "bperp", "phi", "dt").select("ps_id", (F.round("slope", 8) + F.lit(0.0)).alias("slope"))


@query(
    "topofit_trials", "fx_phase fx_ifgs",
    "WITH sp AS (SELECT max(bperp) - min(bperp) AS span FROM fx_ifgs), t AS (SELECT k.range AS trial, k.range / 8 * 2 * pi() / span AS k FROM range(-8, 9) k, sp),"
    " c AS (SELECT ps_id, trial, sqrt(power(sum(cos(phi - k * bperp)), 2) + power(sum(sin(phi - k * bperp)), 2)) / count(*) AS coh FROM fx_phase JOIN fx_ifgs USING (ifg_id), t GROUP BY ps_id, trial)"
    " SELECT ps_id, trial, round(coh, 6) + 0.0 AS coh FROM (SELECT *, row_number() OVER (PARTITION BY ps_id ORDER BY round(coh, 9) DESC, abs(trial), trial DESC) AS p FROM c) WHERE p = 1",
)
def _(fx, spark):
    return series.topofit_trials(fx.fx_phase, fx.fx_ifgs, 1.0).select("ps_id", "trial", r6("coh").alias("coh"))


@query("vertical_projection", "fx_ts", "SELECT pt, day, round(v * (-0.05546576 * 1000 / (4 * pi())) / cos(radians(34 + pt % 7)), 6) + 0.0 AS up FROM fx_ts")
def _(fx, spark):
    los = phase.phase_to_mm(F.col("v"), WAVELENGTH)
    return fx.fx_ts.select("pt", "day", r6(los * geometry.vertical_factor(F.radians(34 + F.col("pt") % 7))).alias("up"))


@query("incidence_units", "fx_ps", "WITH q AS (SELECT quantile_cont(30 + hgt / 100, 0.95) <= pi() / 2 + 0.15 AS rad FROM fx_ps) SELECT ps_id, round(CASE WHEN rad THEN 30 + hgt / 100 ELSE radians(30 + hgt / 100) END, 6) + 0.0 AS incidence FROM fx_ps, q")
def _(fx, spark):
    told = fx.fx_ps.withColumn("inc", 30 + F.col("hgt") / 100)
    is_rad = robust.quantiles(told, "inc", {"q": 0.95}).select((F.col("q") <= math.pi / 2 + 0.15).alias("rad"))
    return told.crossJoin(F.broadcast(is_rad)).select("ps_id", r6(F.when(F.col("rad"), F.col("inc")).otherwise(F.radians("inc"))).alias("incidence"))


@query(
    "sign_choice", "fx_ps fx_phase",
    "WITH d AS (SELECT ifg_id, phi + 0.3 * hgt / 100 AS plus, phi - 0.3 * hgt / 100 AS minus FROM fx_phase JOIN fx_ps USING (ps_id)), m AS (SELECT ifg_id, median(plus) AS mp, median(minus) AS mm FROM d GROUP BY ifg_id),"
    " s AS (SELECT ifg_id, 1.4826 * median(abs(plus - mp)) AS sp, 1.4826 * median(abs(minus - mm)) AS sm FROM d JOIN m USING (ifg_id) GROUP BY ifg_id)"
    " SELECT CASE WHEN median(sm) <= median(sp) THEN 'subtract' ELSE 'add' END AS sign, round(median(sm), 6) + 0.0 AS subtract, round(median(sp), 6) + 0.0 AS add FROM s",
)
def _(fx, spark):
    met = fx.fx_phase.join(fx.fx_ps.select("ps_id", "hgt"), "ps_id")
    delay = 0.3 * F.col("hgt") / 100
    both = met.select("ifg_id", (F.col("phi") + delay).alias("plus"), (F.col("phi") - delay).alias("minus"))
    scales = []
    for c in ("plus", "minus"):
        told = robust.with_median_mad(both.select("ifg_id", c), c, ["ifg_id"])
        scales.append(told.groupBy("ifg_id").agg((robust.MAD_SCALE * F.first("mad")).alias(f"s_{c}")))
    s = scales[0].join(scales[1], "ifg_id").agg(robust.median("s_minus").alias("subtract"), robust.median("s_plus").alias("add"))
    return s.select(F.when(F.col("subtract") <= F.col("add"), "subtract").otherwise("add").alias("sign"), r6("subtract").alias("subtract"), r6("add").alias("add"))


# ---- verification and reports --------------------------------------------------------------------------------------------


@query(
    "allclose_diff", "fx_run fx_golden",
    "SELECT count(*) FILTER (g.key IS NULL) AS only_run, count(*) FILTER (r.key IS NULL) AS only_golden, count(*) FILTER (r.key IS NOT NULL AND g.key IS NOT NULL) AS compared,"
    " count(*) FILTER (abs(r.v - g.v) > 1.5e-5) AS failed, round(max(abs(r.v - g.v)), 9) AS max_abs FROM fx_run r FULL JOIN fx_golden g USING (key)",
)
def _(fx, spark):
    return verify.compare_numeric(fx.fx_run, fx.fx_golden, ["key"], "v", 1.5e-5, 0.0).select("only_run", "only_golden", "compared", "failed", F.round("max_abs", 9).alias("max_abs"))


@query("phase_modulo_diff", "fx_phase", "SELECT ifg_id, count(*) FILTER (abs(d) > 1) AS failed, round(max(abs(d)), 6) + 0.0 AS max_abs FROM (SELECT ifg_id, phi * 3 - phi - floor((phi * 3 - phi + pi()) / (2 * pi())) * 2 * pi() AS d FROM fx_phase) GROUP BY ifg_id")
def _(fx, spark):
    d = F.abs(verify.modulo_difference(F.col("phi") * 3, F.col("phi")))
    return fx.fx_phase.groupBy("ifg_id").agg(F.count_if(d > 1).alias("failed"), r6(F.max(d)).alias("max_abs"))


@query("exact_diff", "fx_run fx_golden", "SELECT side, count(*) AS n FROM (SELECT 'run' AS side, key, v FROM (SELECT * FROM fx_run EXCEPT ALL SELECT * FROM fx_golden) UNION ALL SELECT 'golden', key, v FROM (SELECT * FROM fx_golden EXCEPT ALL SELECT * FROM fx_run)) GROUP BY side")
def _(fx, spark):
    return verify.exact_difference(fx.fx_run, fx.fx_golden)


@query("failure_classes", "orders", "SELECT kind, count(*) AS n FROM (SELECT CASE o_orderkey % 5 WHEN 0 THEN 'unwrap_smoothing' WHEN 1 THEN 'stage3_patch_boundary' WHEN 2 THEN 'stage2_patch_boundary' WHEN 3 THEN 'unwrapped_noise_statistics' ELSE 'unclassified' END AS kind FROM orders) GROUP BY kind")
def _(fx, spark):
    path = F.element_at(F.array(*map(F.lit, ["phuw2.mat", "PATCH_3/select1.mat", "PATCH_1/pm1.mat", "mean_v.mat", "pm1.mat"])), (F.col("o_orderkey") % 5 + 1).cast("int"))
    return fx.orders.select(verify.failure_kind(path).alias("kind")).groupBy("kind").agg(F.count("*").alias("n"))


@query(
    "field_statistics", "lineitem",
    "SELECT l_returnflag, count(l_quantity) AS n, round(avg(l_quantity), 6) AS mean, min(l_quantity) AS min, max(l_quantity) AS max, round(stddev_pop(l_quantity), 6) AS std,"
    " round(quantile_cont(l_quantity, 0.02), 6) AS p02, round(quantile_cont(l_quantity, 0.5), 6) AS p50, round(quantile_cont(l_quantity, 0.98), 6) AS p98 FROM lineitem GROUP BY l_returnflag",
)
def _(fx, spark):
    told = verify.field_statistics(fx.lineitem, "l_quantity", ["l_returnflag"])
    return told.select("l_returnflag", "n", *(F.round(c, 6).alias(c) for c in ("mean", "min", "max", "std", "p02", "p50", "p98")))


@query(
    "outlier_filter", "customer",
    "WITH q AS (SELECT quantile_cont(c_acctbal, 0.25) AS a, quantile_cont(c_acctbal, 0.75) AS b FROM customer) SELECT c_custkey FROM customer, q"
    " WHERE c_acctbal BETWEEN a - 1.5 * (b - a) AND b + 1.5 * (b - a)",
)
def _(fx, spark):
    return verify.without_outliers(fx.customer, "c_acctbal").select("c_custkey")


@query("compare_fields", "lineitem", "SELECT l_returnflag, round(avg(l_discount - l_tax), 6) + 0.0 AS bias, round(sqrt(avg(power(l_discount - l_tax, 2))), 6) + 0.0 AS rmse, round(avg(abs(l_discount - l_tax)), 6) + 0.0 AS mae FROM lineitem GROUP BY l_returnflag")
def _(fx, spark):
    told = fx.lineitem.groupBy("l_returnflag").agg(*verify.compare_fields(F.col("l_discount"), F.col("l_tax")))
    return told.select("l_returnflag", *(r6(c).alias(c) for c in ("bias", "rmse", "mae")))


@query(
    "point_match", "fx_pts",
    "WITH a AS (SELECT floor(lon * 100 + 0.5) AS x, floor(lat * 100 + 0.5) AS y, max(pt) AS pt FROM fx_pts WHERE pt % 2 = 0 GROUP BY 1, 2), b AS (SELECT floor(lon * 100 + 0.5) AS x, floor(lat * 100 + 0.5) AS y, max(pt) AS pt FROM fx_pts WHERE pt % 2 = 1 GROUP BY 1, 2)"
    " SELECT a.pt AS pt_run, b.pt AS pt_other FROM a JOIN b USING (x, y)",
)
def _(fx, spark):
    return verify.match_points(fx.fx_pts.filter("pt % 2 = 0"), fx.fx_pts.filter("pt % 2 = 1"), 2)


@query("index_set_algebra", "fx_ifgs fx_net", "SELECT a AS node FROM fx_ifgs UNION SELECT b FROM fx_ifgs EXCEPT SELECT CAST(a AS BIGINT) FROM fx_net WHERE a < 5")
def _(fx, spark):
    ifgs = fx.fx_ifgs
    drop = fx.fx_net.filter("a < 5").select(F.col("a").cast("long").alias("node"))
    return ifgs.select(F.col("a").alias("node")).union(ifgs.select("b")).distinct().subtract(drop)


@query("top_velocity_report", "fx_ts", "SELECT pt, round(abs(regr_slope(v, day / 365.25)), 3) + 0.0 AS speed FROM fx_ts GROUP BY pt HAVING count(*) >= 3 ORDER BY speed DESC, pt LIMIT 15")
def _(fx, spark):
    v = series.velocity(fx.fx_ts, "pt", "day", "v").select("pt", (F.round(F.abs("velocity"), 3) + F.lit(0.0)).alias("speed"))
    return v.orderBy(F.desc("speed"), "pt").limit(15)
