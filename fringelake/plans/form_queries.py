"""Queries on forms of input and on corrections: text tables, units and frames, series models, delays and comparisons."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from fringelake.functions import geometry, phase
from fringelake.functions.phase import r6
from fringelake.operators import blocks, graph, points, series, verify
from fringelake.plans.point_queries import ARCS, GRID
from fringelake.plans.registry import query
from fringelake.sources import text

# ---- text tables ---------------------------------------------------------------------------------------------------------

DATE = "DATE '1970-01-01' + CAST(day - 719529 AS INTEGER)"


def stamps(fx):
    """image_ix, date, stamp of the acquisitions."""
    date = phase.from_datenum(F.col("day"))
    return fx.fx_images.select("image_ix", date.alias("date"), F.date_format(date, "yyyyMMdd").alias("stamp"))


def scene_lines(fx):
    return stamps(fx).select(F.format_string("rslc/%s.rslc   rslc/%s.rslc.par", "stamp", "stamp").alias("line"), F.col("image_ix").alias("at"))


def pair_lines(fx):
    return fx.fx_ifgs.select(F.format_string("%d  %d %d 1", "a", "b", "ifg_id").alias("line"), F.col("ifg_id").alias("at"))


SCENES = f"sc AS (SELECT image_ix, strftime({DATE}, '%Y%m%d') AS stamp, CAST({DATE} AS DATE) AS date FROM fx_images)"


@query("scene_list", "fx_images", f"WITH {SCENES} SELECT image_ix, 'rslc/' || stamp || '.rslc' AS first, 'rslc/' || stamp || '.rslc.par' AS second, CAST(date AS VARCHAR) AS date FROM sc")
def _(fx, spark):
    return text.scenes(scene_lines(fx)).withColumn("date", F.col("date").cast("string"))


@query("pair_list", "fx_ifgs", "SELECT ifg_id, a, b FROM fx_ifgs")
def _(fx, spark):
    return text.pairs(pair_lines(fx), 19)


@query("list_crosscheck", "fx_images fx_ifgs", "WITH u AS (SELECT DISTINCT unnest([a, b]) AS ix FROM fx_ifgs WHERE ifg_id <= 40) SELECT (SELECT count(*) FROM fx_images) AS scenes, 40::BIGINT AS pairs,"
    " (SELECT count(*) FROM fx_images WHERE image_ix NOT IN (SELECT ix FROM u)) AS unused, (SELECT count(*) FROM u WHERE ix NOT IN (SELECT image_ix FROM fx_images)) AS unknown")  # fmt: skip
def _(fx, spark):
    """A pair list that stops short of the scene list's end."""
    short = text.pairs(pair_lines(fx).filter("at <= 40"), 19)
    return text.crosscheck(text.scenes(scene_lines(fx)).select("image_ix"), short)


@query("acquisition_files", "fx_images", f"WITH {SCENES} SELECT image_ix, CAST(date AS VARCHAR) AS date, 'mli/' || stamp || '_vv.mli' AS path FROM sc")
def _(fx, spark):
    files = stamps(fx).select(F.format_string("mli/%s_vv.mli", "stamp").alias("path"))
    return text.dated_files(stamps(fx), files).withColumn("date", F.col("date").cast("string"))


@query("interferogram_files", "fx_images fx_ifgs", f"WITH {SCENES} SELECT ifg_id, 'diff/' || p.stamp || '_' || q.stamp || '.diff' AS path FROM fx_ifgs JOIN sc p ON p.image_ix = a JOIN sc q ON q.image_ix = b")
def _(fx, spark):
    one = lambda n: stamps(fx).select(F.col("image_ix").alias(n), F.col("stamp").alias(f"s{n}"))
    files = fx.fx_ifgs.join(one("a"), "a").join(one("b"), "b").select(F.format_string("diff/%s_%s.diff", "sa", "sb").alias("path"))
    return text.paired_files(fx.fx_ifgs, stamps(fx), files).withColumn("ifg_id", F.col("ifg_id").cast("long"))


@query("patch_discovery", "nation", "SELECT row_number() OVER (ORDER BY n_nationkey, n_name) AS place, 'PATCH_' || n_nationkey AS name FROM nation")
def _(fx, spark):
    return text.patch_order(fx.nation.select(F.concat(F.lit("PATCH_"), "n_nationkey").alias("name")))


@query("patch_discovery_listed", "nation", "SELECT row_number() OVER (ORDER BY n_name DESC) AS place, 'PATCH_' || n_nationkey AS name FROM nation WHERE n_regionkey <> 2")
def _(fx, spark):
    from pyspark.sql import Window

    names = fx.nation.select(F.concat(F.lit("PATCH_"), "n_nationkey").alias("name"), "n_name", "n_regionkey")
    listed = names.filter("n_regionkey <> 2").select("name", F.row_number().over(Window.orderBy(F.desc("n_name"))).alias("at"))
    return text.patch_order(names.select("name"), listed)


@query("edge_file", "fx_ps", "SELECT row_number() OVER (ORDER BY ps_id) - 1 AS edge_id, ps_id - 1 AS a, ps_id AS b FROM fx_ps WHERE col < 24 AND ps_id + 1 IN (SELECT ps_id FROM fx_ps)")
def _(fx, spark):
    from fringelake.operators import selection
    from fringelake.plans.point_queries import arcs

    found = selection.placed(arcs(fx), "edge_id")
    lines = found.select(F.format_string("%d  %d %d 0", F.col("place") + 1, "a", "b").alias("line"), (F.col("place") + 1).cast("long").alias("at"))
    head = found.agg(F.format_string("%d 1", F.count("*")).alias("line")).withColumn("at", F.lit(0).cast("long"))
    return text.edges(head.union(lines), fx.fx_ps.count())


# ---- units and frames ------------------------------------------------------------------------------------------------------


@query("power_amplitude", "fx_amp", "SELECT pixel, image, round(CASE WHEN pixel % 7 > 1 THEN sqrt(amp) END, 6) + 0.0 AS power, round(CASE WHEN pixel % 7 > 1 THEN amp END, 6) + 0.0 AS amplitude FROM fx_amp")
def _(fx, spark):
    """Samples below nought and at nought have no amplitude."""
    v = F.when(F.col("pixel") % 7 == 0, -F.col("amp")).when(F.col("pixel") % 7 == 1, 0.0).otherwise(F.col("amp"))
    show = lambda x: r6(F.when(~F.isnan(x), x))
    return fx.fx_amp.select("pixel", "image", show(phase.amplitude(v, True)).alias("power"), show(phase.amplitude(v, False)).alias("amplitude"))


@query("positive_pi_branch", "fx_phase", "SELECT ps_id, ifg_id, round(CASE WHEN abs(x + pi()) < 1e-6 AND ifg_id % 3 > 0 THEN pi() ELSE x END, 6) + 0.0 AS phi FROM (SELECT ps_id, ifg_id, CASE WHEN phi < -3 THEN -pi() + CASE WHEN ps_id % 2 = 0 THEN 1e-9 ELSE 0 END ELSE phi END AS x FROM fx_phase)")
def _(fx, spark):
    edge = -F.pi() + F.when(F.col("ps_id") % 2 == 0, 1e-9).otherwise(0.0)
    x = F.when(F.col("phi") < -3, edge).otherwise(F.col("phi"))
    return fx.fx_phase.select("ps_id", "ifg_id", r6(phase.positive_pi(x, F.col("ifg_id") % 3)).alias("phi"))


UNITS = ["mm", " Millimeters ", "cm", "centimetre", "m", "Meters", "rad", "milli meter"]


@query("unit_scale", "part", "SELECT p_partkey, [0.001, 0.001, 0.01, 0.01, 1.0, 1.0, NULL, 0.001][CAST(p_partkey % 8 + 1 AS BIGINT)]::DOUBLE AS scale FROM part")
def _(fx, spark):
    unit = F.element_at(F.array(*map(F.lit, UNITS)), (F.col("p_partkey") % 8 + 1).cast("int"))
    return fx.part.select("p_partkey", phase.unit_scale(unit).alias("scale"))


@query("text_flags", "part", "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'none' ELSE lower(trim(p_brand)) END AS flag FROM part")
def _(fx, spark):
    raw = F.when(F.col("p_partkey") % 6 == 0, F.lit("  ")).when(F.col("p_partkey") % 6 == 3, F.lit(None)).otherwise(F.concat(F.lit("  "), F.upper("p_brand"), F.lit(" ")))
    return fx.part.select("p_partkey", phase.text_flag(raw, "none").alias("flag"))


@query("multilook_factors", "part", "SELECT p_partkey, CASE WHEN p_partkey % 5 > 0 THEN 1 + p_partkey % 5 END AS looks FROM part")
def _(fx, spark):
    k = 1 + F.col("p_partkey") % 5
    original = 1000 + F.col("p_partkey")
    multilooked = F.when(k == 1, F.floor(original * 0.37)).otherwise(F.when(F.col("p_partkey") % 2 == 0, F.floor(original / k)).otherwise(F.ceil(original / k)))
    return fx.part.select("p_partkey", geometry.looks(original, multilooked).alias("looks"))


FLAT = (
    "o AS (SELECT (min(lon) + max(lon)) / 2 AS lon0, (min(lat) + max(lat)) / 2 AS lat0 FROM fx_ps), e AS (SELECT 0.0033528106647474805::DOUBLE * (2 - 0.0033528106647474805::DOUBLE) AS e2),"
    " f AS (SELECT ps_id, radians(lon - lon0) * 6378137.0::DOUBLE / sqrt(1 - e2 * power(sin(radians(lat0)), 2)) * cos(radians(lat0)) AS x, radians(lat - lat0) * 6378137.0::DOUBLE * (1 - e2) / power(1 - e2 * power(sin(radians(lat0)), 2), 1.5) AS y FROM fx_ps, o, e),"
    " t AS (SELECT ps_id, x, y, x * cos(radians({turn})) + y * sin(radians({turn})) AS tx, y * cos(radians({turn})) - x * sin(radians({turn})) AS ty FROM f),"
    " k AS (SELECT max(tx) - min(tx) < max(x) - min(x) AND max(ty) - min(ty) < max(y) - min(y) AS turned FROM t)"
    " SELECT ps_id, round(CASE WHEN turned THEN tx ELSE x END, 3) + 0.0 AS x, round(CASE WHEN turned THEN ty ELSE y END, 3) + 0.0 AS y FROM t, k"
)


@query("flat_xy", "fx_ps", "WITH " + FLAT.format(turn=180 - 192))
def _(fx, spark):
    return geometry.local_frame(fx.fx_ps.select("ps_id", "lon", "lat"), 192.0).drop("lon", "lat")


@query("flat_xy_turned", "fx_ps", "WITH " + FLAT.format(turn=180 - 135).replace("FROM fx_ps, o, e)", "FROM fx_ps, o, e WHERE abs((lat - 35) / 0.00036 - (lon + 120) / 0.0004) < 6.5)").replace("FROM fx_ps), e AS", "FROM fx_ps WHERE abs((lat - 35) / 0.00036 - (lon + 120) / 0.0004) < 6.5), e AS"))
def _(fx, spark):
    """A strip along the diagonal, whose frame turns with the heading."""
    strip = fx.fx_ps.filter("abs((lat - 35) / 0.00036 - (lon + 120) / 0.0004) < 6.5").select("ps_id", "lon", "lat")
    return geometry.local_frame(strip, 135.0).drop("lon", "lat")


@query("master_axis", "fx_images", "WITH d AS (SELECT day FROM fx_images UNION SELECT 739300.0::DOUBLE) SELECT row_number() OVER (ORDER BY day) AS image_ix, day, day = 739300 AS is_master FROM d")
def _(fx, spark):
    return phase.axis_with_master(fx.fx_images, 739300.0)


@query("look_vector_incidence", "fx_ps",
    "WITH t AS (SELECT ps_id, row * 0.95::DOUBLE AS r, col * 0.95::DOUBLE AS c FROM fx_ps), k AS (SELECT ps_id, floor(r) + i AS row, floor(c) + j AS col, CASE i WHEN 1 THEN r - floor(r) ELSE 1 - (r - floor(r)) END"
    " * CASE j WHEN 1 THEN c - floor(c) ELSE 1 - (c - floor(c)) END AS w FROM t, range(2) a(i), range(2) b(j)), m AS (SELECT k.ps_id, sum(w * (0.9 + g.d_a / 5)) / sum(w) AS lv FROM k JOIN fx_ps g USING (row, col) WHERE w > 0 GROUP BY k.ps_id)"
    " SELECT ps_id, round(pi() / 2 - lv, 6) + 0.0 AS incidence, round(sin(lv), 6) + 0.0 AS cosine FROM m")  # fmt: skip
def _(fx, spark):
    raster = fx.fx_ps.select("row", "col", (0.9 + F.col("d_a") / 5).alias("value"))
    at = fx.fx_ps.select(F.col("ps_id").alias("pt"), (F.col("row") * 0.95).alias("r"), (F.col("col") * 0.95).alias("c"))
    return points.incidence(at, raster).select(F.col("pt").alias("ps_id"), r6("incidence").alias("incidence"), r6("cosine").alias("cosine"))


# ---- unwrapped phases and models -----------------------------------------------------------------------------------------------


def turned_grid(fx):
    """An unwrapped grid whose turns are known: the cells' angles and a turn for each step along the diagonal."""
    from fringelake.plans.point_queries import grid

    return grid(fx).select("gi", "gj", "ifg_id", (F.atan2("im", "re") + 2 * F.pi() * F.pmod(F.col("gi") + F.col("gj"), F.lit(5))).alias("uw"))


@query("grid_restore", "fx_ps fx_phase",
    f"WITH {GRID}, u AS (SELECT gi, gj, ifg_id, atan2(im, re) + 2 * pi() * ((gi + gj) % 5) AS uw FROM gr) SELECT ps_id, ifg_id, round(uw + atan2(sin(phi - uw), cos(phi - uw)), 5) + 0.0 AS uw FROM gc JOIN fx_phase USING (ps_id) JOIN u USING (gi, gj, ifg_id)")
def _(fx, spark):
    cells = points.grid_cells(fx.fx_ps, 100.0)
    return blocks.restore_points(fx.fx_phase, cells, turned_grid(fx)).withColumn("uw", F.round("uw", 5) + F.lit(0.0))


@query("design_matrix", "fx_ifgs", "SELECT ifg_id AS row, image, value FROM (SELECT ifg_id, a AS image, -1.0::DOUBLE AS value FROM fx_ifgs UNION ALL SELECT ifg_id, b, 1.0 FROM fx_ifgs) WHERE image > 1")
def _(fx, spark):
    pairs = [(r["a"], r["b"]) for r in fx.fx_ifgs.orderBy("ifg_id").collect()]  # a row for each interferogram
    return spark.createDataFrame(series.design_table(pairs, 19), "row long, image long, value double")


@query("scla_with_time", "fx_phase fx_ifgs",
    "WITH s AS (SELECT ps_id, var_pop(bperp) AS bb, var_pop(dt) AS tt, covar_pop(bperp, dt) AS bt, covar_pop(bperp, phi) AS bp, covar_pop(dt, phi) AS tp FROM fx_phase JOIN fx_ifgs USING (ifg_id) GROUP BY ps_id)"
    " SELECT ps_id, round((bp * tt - tp * bt) / (bb * tt - bt * bt), 6) + 0.0 AS k FROM s")  # fmt: skip
def _(fx, spark):
    return series.scla_with_time(fx.fx_phase, fx.fx_ifgs).select("ps_id", r6("k").alias("k"))


#: Series of 19 epochs: the phases of the first 18 interferograms as those of images 2 to 19, nought at the first.
TS = (
    "ts AS (SELECT ps_id, image_ix, day, CASE WHEN image_ix = 1 THEN 0 ELSE bperp END AS b, CASE WHEN image_ix = 1 THEN 0 ELSE phi END AS phi FROM fx_phase JOIN fx_ifgs USING (ifg_id)"
    " JOIN fx_images ON image_ix = CASE WHEN ifg_id <= 18 THEN ifg_id + 1 WHEN ifg_id = 64 THEN 1 END)"
)


def series_of(fx):
    image = F.when(F.col("ifg_id") <= 18, F.col("ifg_id") + 1).when(F.col("ifg_id") == 64, F.lit(1).cast("long"))
    met = fx.fx_phase.join(F.broadcast(fx.fx_ifgs.select("ifg_id", "bperp")), "ifg_id").withColumn("image_ix", image).join(F.broadcast(fx.fx_images), "image_ix")
    at_first = lambda c: F.when(F.col("image_ix") == 1, 0.0).otherwise(F.col(c))
    return met.select("ps_id", "image_ix", "day", at_first("bperp").alias("b"), at_first("phi").alias("phi"))


SM = (
    TS + ", d AS (SELECT ps_id, b - lag(b) OVER w AS db, phi - lag(phi) OVER w AS dp FROM ts WINDOW w AS (PARTITION BY ps_id ORDER BY day)), kk AS (SELECT ps_id, regr_slope(dp, db) AS k FROM d GROUP BY ps_id),"
    " md AS (SELECT ps_id, any_value(k) AS k, regr_intercept(phi - k * b, day - 739300) AS c, regr_slope(phi - k * b, day - 739300) AS v FROM ts JOIN kk USING (ps_id) GROUP BY ps_id)"
)


@query("scla_single_master", "fx_phase fx_ifgs fx_images", f"WITH {SM} SELECT ps_id, round(k, 6) + 0.0 AS k, round(c, 6) + 0.0 AS c FROM md")
def _(fx, spark):
    return series.scla_single_master(series_of(fx), 739300.0).select("ps_id", r6("k").alias("k"), r6("c").alias("c"))


@query("scla_mean_velocity", "fx_phase fx_ifgs fx_images", f"WITH {SM} SELECT ps_id, round(v * 365.25, 6) + 0.0 AS v FROM md")
def _(fx, spark):
    return series.scla_single_master(series_of(fx), 739300.0).select("ps_id", r6(F.col("v") * 365.25).alias("v"))


GF = (
    "w AS (SELECT p.ps_id, q.ps_id AS other, exp(-(power(p.x - q.x, 2) + power(p.y - q.y, 2)) / (2 * 30 * 30)) AS w FROM fx_ps p JOIN fx_ps q"
    " ON abs(p.x - q.x) < 120 AND abs(p.y - q.y) < 120 AND sqrt(power(p.x - q.x, 2) + power(p.y - q.y, 2)) < 120),"
    " sm AS (SELECT w.ps_id, image_ix, sum(w * phi) / sum(w) AS v FROM w JOIN ts ON ts.ps_id = w.other GROUP BY w.ps_id, image_ix),"
    " sn AS (SELECT ps_id, image_ix, CASE WHEN image_ix = 7 THEN 0 ELSE v - arg_min(v, ps_id) OVER (PARTITION BY image_ix) END AS scn FROM sm)"
)


def spatial_noise(fx):
    ts = series_of(fx)
    smooth = points.gaussian_filter(fx.fx_ps, ts.select("ps_id", F.col("image_ix").alias("ifg_id"), "phi"), 30.0)
    return series.scn_from(ts, smooth.withColumnRenamed("ifg_id", "image_ix"), 7)


@query("scn_first_point", "fx_ps fx_phase fx_ifgs fx_images", f"WITH {TS}, {GF} SELECT ps_id, image_ix, round(scn, 6) + 0.0 AS scn FROM sn")
def _(fx, spark):
    return spatial_noise(fx).withColumn("scn", r6("scn"))


@query("corrected_series", "fx_ps fx_phase fx_ifgs fx_images",
    f"WITH {SM}, {GF}, r AS (SELECT ps_id, image_ix, CASE WHEN image_ix = 7 THEN 0 ELSE phi - k * b - c - scn END AS p FROM ts JOIN md USING (ps_id) JOIN sn USING (ps_id, image_ix)),"
    " m AS (SELECT image_ix, avg(p) AS m FROM r WHERE ps_id <= 50 GROUP BY image_ix) SELECT ps_id, image_ix, round(p - m, 5) + 0.0 AS phi FROM r JOIN m USING (image_ix)")  # fmt: skip
def _(fx, spark):
    ts = series_of(fx)
    model = series.scla_single_master(ts, 739300.0)
    return series.corrected(ts, model, spatial_noise(fx), fx.fx_ps.filter("ps_id <= 50"), 7).withColumn("phi", F.round("phi", 5) + F.lit(0.0))


@query("gls_velocity", "fx_phase fx_ifgs fx_images",
    f"WITH {TS}, w AS (SELECT *, 1 / (1 + image_ix / 10.0::DOUBLE) AS w, (day - 739252) / 365.25::DOUBLE AS t FROM ts), s AS (SELECT ps_id, sum(w) AS s, sum(w * t) AS st, sum(w * t * t) AS stt, sum(w * phi) AS sp, sum(w * t * phi) AS stp FROM w GROUP BY ps_id),"
    " f AS (SELECT ps_id, (s * stp - st * sp) / (s * stt - st * st) AS v, (stt * sp - st * stp) / (s * stt - st * st) AS c FROM s) SELECT ps_id, round(any_value(c), 6) + 0.0 AS c, round(any_value(v), 6) + 0.0 AS velocity,"
    " round(sqrt(avg(power(phi - c - v * t, 2))), 6) + 0.0 AS rms FROM w JOIN f USING (ps_id) GROUP BY ps_id")  # fmt: skip
def _(fx, spark):
    days = [r["day"] for r in fx.fx_images.orderBy("image_ix").collect()]  # a row for each acquisition
    told = series.gls_velocity(series_of(fx).withColumnRenamed("phi", "x"), days, np.diag(1 + np.arange(1, 20) / 10))
    return told.select("ps_id", r6("c").alias("c"), r6("velocity").alias("velocity"), r6("rms").alias("rms"))


@query("calendar_velocity", "fx_phase fx_ifgs fx_images", f"WITH {TS} SELECT ps_id, year({DATE}) AS year, round(regr_slope(phi, day / 365.25::DOUBLE), 5) + 0.0 AS velocity, count(*) AS n FROM ts GROUP BY 1, 2 HAVING count(*) >= 6 AND max(day) - min(day) >= 180")
def _(fx, spark):
    ts = series_of(fx).withColumn("year", F.year(phase.from_datenum(F.col("day")))).withColumn("day", F.col("day") - 739252)
    told = series.period_velocity(ts, "ps_id", F.col("year"), "day", "phi", 6, 180)
    return told.select("ps_id", F.col("period").cast("long").alias("year"), (F.round("velocity", 5) + F.lit(0.0)).alias("velocity"), "n")


@query("fitted_velocity_series", "fx_phase fx_ifgs fx_images", f"WITH {SM} SELECT ps_id, image_ix, round(c + v * (day - 739300), 6) + 0.0 AS value FROM md, fx_images")
def _(fx, spark):
    fits = series.scla_single_master(series_of(fx), 739300.0).select("ps_id", "c", F.col("v").alias("slope"))
    days = fx.fx_images.select("image_ix", (F.col("day") - 739300).alias("day"))
    return series.fitted_series(fits, days).select("ps_id", "image_ix", r6("value").alias("value"))


@query("model_envelope", "fx_ps fx_phase fx_ifgs",
    f"WITH {ARCS}, m AS (SELECT ps_id, regr_slope(phi, bperp) AS k, regr_intercept(phi, bperp) AS c FROM fx_phase JOIN fx_ifgs USING (ifg_id) GROUP BY ps_id), u AS (SELECT a, b FROM arcs UNION SELECT b, a FROM arcs),"
    " e AS (SELECT u.a, min(k) AS k0, max(k) AS k1, min(c) AS c0, max(c) AS c1 FROM u JOIN m ON m.ps_id = u.b GROUP BY u.a)"
    " SELECT ps_id, round(greatest(coalesce(k0, k), least(coalesce(k1, k), k)), 6) + 0.0 AS k, round(greatest(coalesce(c0, c), least(coalesce(c1, c), c)), 6) + 0.0 AS c FROM m LEFT JOIN e ON e.a = ps_id")  # fmt: skip
def _(fx, spark):
    """Slope and offset of the height-error model, both held within the neighbours'."""
    from fringelake.plans.point_queries import arcs

    model, links = graph.written(series.scla(fx.fx_phase, fx.fx_ifgs)), graph.written(arcs(fx))
    held = graph.clamp_to_neighbours(model.select("ps_id", "k"), links, "k").join(graph.clamp_to_neighbours(model.select("ps_id", "c"), links, "c"), "ps_id")
    return held.select("ps_id", r6("k").alias("k"), r6("c").alias("c"))


@query("highpass_without_master", "fx_phase fx_ifgs fx_images",
    f"WITH {TS}, w AS (SELECT p.ps_id, p.image_ix, p.phi, sum(exp(-power(p.day - q.day, 2) / (2 * 900)) * q.phi) FILTER (q.image_ix <> 7) / sum(exp(-power(p.day - q.day, 2) / (2 * 900))) FILTER (q.image_ix <> 7) AS low"
    " FROM ts p JOIN ts q USING (ps_id) GROUP BY p.ps_id, p.image_ix, p.phi) SELECT ps_id, image_ix, round(phi - low, 6) + 0.0 AS high FROM w")  # fmt: skip
def _(fx, spark):
    return series.temporal_highpass(series_of(fx), "ps_id", "day", "phi", 30.0, 739252.0 + 72).select("ps_id", "image_ix", r6("high").alias("high"))


# ---- delays ------------------------------------------------------------------------------------------------------------------

DELAY = (
    TS + ", z AS (SELECT ps_id, image_ix, (0.01 * sin(ps_id * 0.05) * ((image_ix * 7) % 11) + 0.002 * image_ix) / cos(0.6 + 0.001 * (ps_id % 25)) AS d FROM ts),"
    " zm AS (SELECT image_ix, median(d) AS m FROM z WHERE ps_id <= 50 GROUP BY image_ix), zl AS (SELECT ps_id, image_ix, d - m AS d FROM z JOIN zm USING (image_ix)),"
    " co AS (SELECT p.ps_id, p.image_ix, 4 * pi() / 0.05546576 * (p.d - q.d) AS corr FROM zl p JOIN zl q ON q.ps_id = p.ps_id AND q.image_ix = 7)"
)
SIGN = (
    DELAY + ", sd AS (SELECT image_ix, sign, CASE sign WHEN 'add' THEN phi + corr ELSE phi - corr END AS x FROM ts JOIN co USING (ps_id, image_ix), (SELECT unnest(['add', 'subtract']) AS sign) WHERE image_ix <> 7),"
    " m1 AS (SELECT image_ix, sign, median(x) AS m FROM sd GROUP BY image_ix, sign), m2 AS (SELECT image_ix, sign, 1.4826 * median(abs(x - m)) AS s FROM sd JOIN m1 USING (image_ix, sign) GROUP BY image_ix, sign),"
    " sg AS (SELECT median(s) FILTER (sign = 'subtract') AS score_subtract, median(s) FILTER (sign = 'add') AS score_add FROM m2)"
)


def delays(fx):
    ts = series_of(fx)
    zenith = 0.01 * F.sin(F.col("ps_id") * 0.05) * F.pmod(F.col("image_ix") * 7, F.lit(11)) + 0.002 * F.col("image_ix")
    incidence = fx.fx_ps.select("ps_id", (0.6 + 0.001 * F.pmod("ps_id", F.lit(25))).alias("theta"))
    return ts, series.delay_phases(ts.select("ps_id", "image_ix", zenith.alias("zenith")), incidence, fx.fx_ps.filter("ps_id <= 50"), 7, 0.05546576)


@query("delay_phases", "fx_phase fx_ifgs fx_images", f"WITH {DELAY} SELECT ps_id, image_ix, round(corr, 5) + 0.0 AS corr FROM co")
def _(fx, spark):
    return delays(fx)[1].withColumn("corr", F.round("corr", 5) + F.lit(0.0))


@query("delay_sign", "fx_phase fx_ifgs fx_images", f"WITH {SIGN} SELECT round(score_subtract, 6) + 0.0 AS score_subtract, round(score_add, 6) + 0.0 AS score_add, CASE WHEN score_subtract <= score_add THEN 'subtract' ELSE 'add' END AS sign FROM sg")
def _(fx, spark):
    ts, corr = delays(fx)
    return series.delay_sign(ts, corr, 7).select(r6("score_subtract").alias("score_subtract"), r6("score_add").alias("score_add"), "sign")


@query("delay_corrected", "fx_phase fx_ifgs fx_images", f"WITH {SIGN} SELECT ps_id, image_ix, round(CASE WHEN score_subtract <= score_add THEN phi - corr ELSE phi + corr END, 5) + 0.0 AS phi FROM ts JOIN co USING (ps_id, image_ix), sg")
def _(fx, spark):
    ts, corr = delays(fx)
    return series.with_delay(ts, corr, series.delay_sign(ts, corr, 7)).withColumn("phi", F.round("phi", 5) + F.lit(0.0))


# ---- comparison ------------------------------------------------------------------------------------------------------------------

PATHS = "p AS (SELECT ps_id, CASE WHEN ps_id % 4 > 0 THEN 'PATCH_' || patch_id || '/' ELSE '' END || ['pm1', 'select1', 'weed1', 'phuw2', 'scla2', 'other', 'pm2'][CAST(ps_id % 7 + 1 AS BIGINT)] || '.mat' AS path FROM fx_ps)"


def paths(fx):
    name = F.element_at(F.array(*map(F.lit, ["pm1", "select1", "weed1", "phuw2", "scla2", "other", "pm2"])), (F.col("ps_id") % 7 + 1).cast("int"))
    folder = F.when(F.col("ps_id") % 4 > 0, F.concat(F.lit("PATCH_"), "patch_id", F.lit("/"))).otherwise("")
    return fx.fx_ps.select("ps_id", F.concat(folder, name, F.lit(".mat")).alias("path"))


@query("failure_summary", "fx_ps",
    f"WITH {PATHS}, k AS (SELECT path, CASE WHEN path LIKE 'PATCH%/pm1.mat' THEN 0 WHEN path LIKE 'PATCH%/select1.mat' THEN 1 WHEN path LIKE 'PATCH%/weed1.mat' THEN 2 WHEN path LIKE '%phuw2.mat' OR path LIKE '%pm2.mat' THEN 3 WHEN path LIKE '%scla2.mat' THEN 4 ELSE 5 END AS priority FROM p)"
    " SELECT priority, ['stage2', 'stage3', 'stage4', 'stage5_6', 'stage7_8', 'unknown'][priority + 1] AS scope,"
    " ['stage2_patch_boundary', 'stage3_patch_boundary', 'stage4_patch_boundary', 'unwrap_smoothing', 'unwrapped_noise_statistics', 'unclassified'][priority + 1] AS kind,"
    " count(*) AS n, min(path) AS first, priority = (SELECT min(priority) FROM k) AS boundary FROM k GROUP BY priority")  # fmt: skip
def _(fx, spark):
    return verify.failure_summary(paths(fx))


RULES = [("PATCH_*/pm1.mat", "coh", "numeric", 1e-6, 1e-5), ("PATCH_*/*.mat", "coh", "exact", 0.0, 0.0), ("*", "coh", "numeric", 1e-3, 0.0), ("*", "phi", "phase", 1e-4, 0.0)]


@query("tolerance_rules", "fx_ps",
    f"WITH {PATHS}, k AS (SELECT *, CASE ps_id % 2 WHEN 0 THEN 'coh' ELSE 'phi' END AS key, path LIKE 'PATCH%' AS inside, path LIKE 'PATCH%/pm1.mat' AS pm FROM p) SELECT ps_id, path, key,"
    " CASE WHEN key = 'coh' THEN CASE WHEN pm THEN 'numeric' WHEN inside THEN 'exact' ELSE 'numeric' END WHEN inside THEN NULL ELSE 'phase' END AS mode,"
    " CASE WHEN key = 'coh' THEN CASE WHEN pm THEN 1e-6 WHEN inside THEN 0 ELSE 1e-3 END WHEN inside THEN NULL ELSE 1e-4 END::DOUBLE AS atol FROM k")  # fmt: skip
def _(fx, spark):
    keyed = paths(fx).withColumn("key", F.when(F.col("ps_id") % 2 == 0, "coh").otherwise("phi"))
    return verify.tolerance_of(keyed, RULES).select("ps_id", "path", "key", "mode", "atol")


@query("compare_run_with_golden", "orders customer",
    "SELECT 'customers' AS name, true AS alike, '' AS missing, 0::BIGINT AS only_run, 0::BIGINT AS only_golden, count(*) AS compared, count(*) FILTER (c_custkey % 50 = 0) AS failed, CASE WHEN count(*) FILTER (c_custkey % 50 = 0) > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS max_abs FROM customer"
    " UNION ALL SELECT 'orders', true, '', count(*) FILTER (o_orderkey % 1000 = 7), count(*) FILTER (o_orderkey % 1000 = 8), count(*) FILTER (o_orderkey % 1000 NOT IN (7, 8)), 0, 0.0 FROM orders")  # fmt: skip
def _(fx, spark):
    orders = fx.orders.select("o_orderkey", F.col("o_totalprice").cast("double").alias("v"))
    customers = fx.customer.select("c_custkey", F.col("c_acctbal").cast("double").alias("v"))
    moved = customers.withColumn("v", F.when(F.col("c_custkey") % 50 == 0, F.col("v") + 1.0).otherwise(F.col("v")))
    pairs = {"orders": (orders.filter("o_orderkey % 1000 <> 8"), orders.filter("o_orderkey % 1000 <> 7")), "customers": (moved, customers)}
    told = verify.compare_tables(pairs, {"orders": (["o_orderkey"], "v", 1e-9, 0.0), "customers": (["c_custkey"], "v", 1e-6, 0.0)})
    return told.select("name", "alike", "missing", "only_run", "only_golden", "compared", "failed", r6("max_abs").alias("max_abs"))


@query("sparse_exact_diff", "fx_ps", "SELECT 'golden' AS side, count(*) AS n FROM fx_ps WHERE ps_id % 20 = 3 UNION ALL SELECT 'run', count(*) FROM fx_ps WHERE ps_id % 20 IN (3, 4)")
def _(fx, spark):
    """Rows whole, values and all: one row in twenty changed, one in twenty on one side alone."""
    run = fx.fx_ps.select("ps_id", "row", "col", "hgt")
    changed = run.filter("ps_id % 20 <> 4").withColumn("hgt", F.when(F.col("ps_id") % 20 == 3, F.col("hgt") + 1).otherwise(F.col("hgt")))
    return verify.exact_difference(run, changed)


@query("figure_histogram", "fx_ps", "WITH e AS (SELECT quantile_cont(coh, 0.02) AS lo, quantile_cont(coh, 0.98) AS hi FROM fx_ps) SELECT CAST(least(60, floor((coh - lo) / (hi - lo) * 60) + 1) AS BIGINT) AS bin, count(*) AS n FROM fx_ps, e WHERE coh BETWEEN lo AND hi GROUP BY 1")
def _(fx, spark):
    return verify.figure_histogram(fx.fx_ps, "coh")


@query("figure_series", "fx_phase fx_ifgs fx_images", f"WITH {TS} SELECT image_ix, round(quantile_cont(phi, 0.25), 6) + 0.0 AS q1, round(median(phi), 6) + 0.0 AS middle, round(quantile_cont(phi, 0.75), 6) + 0.0 AS q3 FROM ts GROUP BY image_ix")
def _(fx, spark):
    quarter = lambda q: r6(F.percentile("phi", F.lit(q)))
    return series_of(fx).groupBy("image_ix").agg(quarter(0.25).alias("q1"), quarter(0.5).alias("middle"), quarter(0.75).alias("q3"))
