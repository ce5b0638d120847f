"""Queries on scatterer points: screening, selection, patches, neighbours, grids and rasters."""

from __future__ import annotations

from pyspark.sql import functions as F

from fringelake.functions import geometry, phase
from fringelake.functions.phase import r6
from fringelake.operators import graph, points, robust
from fringelake.plans.registry import query
from fringelake.sources.raster import sample_raster

SCALE = "sc AS (SELECT image, avg(amp) FILTER (amp > 0) AS scale FROM fx_amp GROUP BY image), v AS (SELECT pixel, image, amp / scale AS v FROM fx_amp JOIN sc USING (image))"


@query("amplitude_calibration", "fx_amp", "SELECT image, round(avg(amp) FILTER (amp > 0), 6) + 0.0 AS scale FROM fx_amp GROUP BY image")
def _(fx, spark):
    return points.amplitude_scales(fx.fx_amp).select("image", r6("scale").alias("scale"))


@query(
    "amplitude_dispersion", "fx_amp",
    f"WITH {SCALE}, s AS (SELECT pixel, count(*) AS n, sum(v) AS s, sum(v * v) AS q FROM v WHERE v > 0 GROUP BY pixel HAVING count(*) >= 8)"
    " SELECT pixel, n, round(s / n, 6) + 0.0 AS mean, round(sqrt(greatest(0, (q - s * s / n) / (n - 1))) / (s / n), 6) + 0.0 AS d_a FROM s"
    " WHERE sqrt(greatest(0, (q - s * s / n) / (n - 1))) / (s / n) <= 0.5",
)
def _(fx, spark):
    return points.amplitude_dispersion(fx.fx_amp, 0.5, 0.4, 20).select("pixel", "n", r6("mean").alias("mean"), r6("d_a").alias("d_a"))


@query(
    "pairwise_dispersion", "fx_amp fx_ifgs",
    f"WITH {SCALE}, p AS (SELECT m.pixel, m.v AS m, s.v AS s FROM v m JOIN fx_ifgs ON m.image = a JOIN v s ON s.image = b AND s.pixel = m.pixel)"
    " SELECT pixel, count(*) AS n_pairs, round(sqrt(avg((m - s) * (m - s))) / avg((m + s) / 2), 6) + 0.0 AS d_a FROM p GROUP BY pixel"
    " HAVING sqrt(avg((m - s) * (m - s))) / avg((m + s) / 2) < 0.6",
)
def _(fx, spark):
    return points.pairwise_dispersion(fx.fx_amp, fx.fx_ifgs, 0.6).select("pixel", "n_pairs", r6("d_a").alias("d_a"))


@query(
    "best_look_per_cell", "fx_ps",
    "SELECT CAST(floor(row / 2) AS BIGINT) AS cell_row, CAST(floor(col / 3) AS BIGINT) AS cell_col, arg_min(row, (d_a, row, col)) AS row,"
    " arg_min(col, (d_a, row, col)) AS col, round(min(d_a), 6) + 0.0 AS d_a FROM fx_ps GROUP BY 1, 2",
)
def _(fx, spark):
    return points.best_look(fx.fx_ps, 3, 2).withColumn("d_a", r6("d_a"))


@query("cell_balanced_topk", "fx_ps", "SELECT ps_id, row_number() OVER (PARTITION BY floor(row / 5), floor(col / 5) ORDER BY d_a, row, col) AS rank FROM fx_ps QUALIFY rank <= 4")
def _(fx, spark):
    return points.cell_balanced(fx.fx_ps, 5, 5, 4).select("ps_id", F.col("rank").cast("long").alias("rank"))


@query(
    "global_fair_cap", "fx_ps",
    "WITH r AS (SELECT *, row_number() OVER (PARTITION BY floor(row / 5), floor(col / 5) ORDER BY d_a, row, col) AS rank FROM fx_ps)"
    " SELECT ps_id, rank FROM (SELECT * FROM r ORDER BY rank, d_a, row, col LIMIT 100)",
)
def _(fx, spark):
    return points.fair_cap(fx.fx_ps, 5, 5, 100).select("ps_id", F.col("rank").cast("long").alias("rank"))


@query(
    "balanced_anchors", "fx_ps",
    "SELECT ps_id, place FROM (SELECT ps_id, row_number() OVER (PARTITION BY floor(x / 200), floor(y / 200) ORDER BY coh DESC, ps_id) AS place FROM fx_ps) WHERE place <= 3",
)
def _(fx, spark):
    return points.anchors(fx.fx_ps, 200, 3).select("ps_id", F.col("place").cast("long").alias("place"))


BOUNDS = (
    "g AS (SELECT i * 2 + j + 1 AS patch, i * 10 AS core_r0, i * 10 + 10 AS core_r1, CASE j WHEN 0 THEN 0 ELSE 12 END AS core_c0, CASE j WHEN 0 THEN 12 ELSE 25 END AS core_c1"
    " FROM range(2) a(i), range(2) b(j)), w AS (SELECT *, greatest(0, core_r0 - 2) AS r0, least(20, core_r1 + 2) AS r1, greatest(0, core_c0 - 2) AS c0, least(25, core_c1 + 2) AS c1 FROM g),"
    " k AS (SELECT ps_id, row, col, patch, row >= core_r0 AND row < core_r1 AND col >= core_c0 AND col < core_c1 AS in_core FROM fx_ps JOIN w"
    " ON row >= r0 AND row < r1 AND col >= c0 AND col < c1)"
)


def assigned(fx, spark):
    """Two by two patches over the extent of the points. The SQL's extent is fixed at 20 by 25, that of 500 points."""
    rows, cols = fx.fx_ps.agg(F.coalesce(F.max("row") + 1, F.lit(0)), F.coalesce(F.max("col") + 1, F.lit(0))).first()
    return points.assign_patches(fx.fx_ps, points.patch_bounds(spark, rows, cols, 2, 2, 2))


@query("patch_assign_overlap", "fx_ps", f"WITH {BOUNDS} SELECT ps_id, patch, in_core FROM k")
def _(fx, spark):
    return assigned(fx, spark).select("ps_id", "patch", "in_core")


@query(
    "patch_overlap_merge", "fx_ps",
    f"WITH {BOUNDS} SELECT row, col, patch, ps_id FROM (SELECT *, row_number() OVER (PARTITION BY row, col ORDER BY in_core DESC, CASE WHEN in_core THEN -patch ELSE patch END) AS p FROM k) WHERE p = 1",
)
def _(fx, spark):
    return points.merge_patches(assigned(fx, spark)).select("row", "col", "patch", "ps_id")


@query(
    "dedup_keep_best", "fx_ps",
    "SELECT gx, gy, ps_id, round(coh, 6) + 0.0 AS coh FROM (SELECT floor(x / 80) AS gx, floor(y / 80) AS gy, ps_id, coh, row_number() OVER (PARTITION BY floor(x / 80), floor(y / 80) ORDER BY coh DESC, ps_id) AS p FROM fx_ps) WHERE p = 1",
)
def _(fx, spark):
    cells = fx.fx_ps.select(F.floor(F.col("x") / 80).cast("double").alias("gx"), F.floor(F.col("y") / 80).cast("double").alias("gy"), "ps_id", "coh")
    return points.keep_best(cells, ["gx", "gy"]).withColumn("coh", r6("coh"))


@query(
    "adjacent_groups", "fx_ps",
    "WITH RECURSIVE f AS (SELECT i.ps_id AS a, min(j.ps_id) AS b FROM fx_ps i JOIN fx_ps j"
    " ON abs(i.row - j.row) <= 1 AND abs(i.col - j.col) <= 1 AND i.ps_id <> j.ps_id GROUP BY i.ps_id), l AS (SELECT a, b FROM f UNION SELECT b, a FROM f),"
    " r AS (SELECT ps_id AS node, ps_id AS seen FROM fx_ps UNION SELECT r.node, l.b FROM r JOIN l ON l.a = r.seen),"
    " g AS (SELECT node AS ps_id, min(seen) AS grp FROM r GROUP BY node), b AS (SELECT ps_id, grp, row_number() OVER (PARTITION BY grp ORDER BY coh DESC, ps_id) = 1 AS keep FROM g JOIN fx_ps USING (ps_id))"
    ' SELECT ps_id, grp AS "group", keep FROM b',
)
def _(fx, spark):
    return points.adjacent_groups(fx.fx_ps)


ARCS = "arcs AS (SELECT ps_id AS edge_id, ps_id AS a, ps_id + 1 AS b FROM fx_ps WHERE col < 24 AND ps_id + 1 IN (SELECT ps_id FROM fx_ps))"
DIFF = ARCS + ", ad AS (SELECT edge_id, a, b, p.ifg_id, atan2(sin(q.phi - p.phi), cos(q.phi - p.phi)) AS dphi FROM arcs JOIN fx_phase p ON p.ps_id = a JOIN fx_phase q ON q.ps_id = b AND q.ifg_id = p.ifg_id)"


def arcs(fx):
    ps = fx.fx_ps
    return ps.filter("col < 24").select(F.col("ps_id").alias("edge_id"), F.col("ps_id").alias("a"), (F.col("ps_id") + 1).alias("b")).join(ps.select(F.col("ps_id").alias("b")), "b", "left_semi")


@query("edge_phase_diff", "fx_ps fx_phase", f"WITH {DIFF} SELECT edge_id, count(*) AS n, round(sqrt(avg(dphi * dphi)), 6) + 0.0 AS rms, round(avg(dphi), 6) + 0.0 AS mean FROM ad GROUP BY edge_id")
def _(fx, spark):
    d = graph.arc_differences(arcs(fx), fx.fx_phase)
    return d.groupBy("edge_id").agg(F.count("*").alias("n"), r6(F.sqrt(F.avg(F.col("dphi") * F.col("dphi")))).alias("rms"), r6(F.avg("dphi")).alias("mean"))


@query("edge_noise", "fx_ps fx_phase", f"WITH {DIFF} SELECT edge_id, ifg_id, round(0.5 * (dphi - avg(dphi) OVER (PARTITION BY edge_id)), 6) + 0.0 AS noise FROM ad")
def _(fx, spark):
    return graph.edge_noise(graph.arc_differences(arcs(fx), fx.fx_phase)).withColumn("noise", r6("noise"))


@query(
    "edge_min_noise", "fx_ps fx_phase",
    f"WITH {DIFF}, e AS (SELECT edge_id, any_value(a) AS a, any_value(b) AS b, stddev_samp(dphi) AS std, max(abs(dphi)) AS mx FROM ad GROUP BY edge_id),"
    ' n AS (SELECT unnest([a, b]) AS node, std, mx FROM e) SELECT node, round(min(std), 6) + 0.0 AS std, round(min(mx), 6) + 0.0 AS "max" FROM n GROUP BY node',
)
def _(fx, spark):
    d = graph.arc_differences(arcs(fx), fx.fx_phase)
    stats = d.groupBy("edge_id").agg(F.first("a").alias("a"), F.first("b").alias("b"), F.stddev_samp("dphi").alias("std"), F.max(F.abs("dphi")).alias("max"))
    return graph.node_minimum(stats).select("node", r6("std").alias("std"), r6("max").alias("max"))


@query(
    "neighbor_envelope_clamp", "fx_ps",
    f"WITH {ARCS}, u AS (SELECT a, b FROM arcs UNION SELECT b, a FROM arcs), m AS (SELECT u.a, min(p.coh) AS lo, max(p.coh) AS hi FROM u JOIN fx_ps p ON p.ps_id = u.b GROUP BY u.a)"
    " SELECT ps_id, round(greatest(coalesce(lo, coh), least(coalesce(hi, coh), coh)), 6) + 0.0 AS coh FROM fx_ps LEFT JOIN m ON m.a = ps_id",
)
def _(fx, spark):
    return graph.clamp_to_neighbours(fx.fx_ps.select("ps_id", "coh"), arcs(fx), "coh").withColumn("coh", r6("coh"))


CELLS = (
    "lo AS (SELECT min(x) AS x0, min(y) AS y0, max(x) AS x1, max(y) AS y1 FROM fx_ps), gc AS (SELECT ps_id,"
    " CAST(least(greatest(1, ceil((y - y0 + 1e-6) / 100)), greatest(1, greatest(1, ceil((y1 - y0 + 1e-6) / 100)) - 1)) AS BIGINT) AS gi,"
    " CAST(least(greatest(1, ceil((x - x0 + 1e-6) / 100)), greatest(1, greatest(1, ceil((x1 - x0 + 1e-6) / 100)) - 1)) AS BIGINT) AS gj FROM fx_ps, lo)"
)
GRID = CELLS + ", gr AS (SELECT gi, gj, ifg_id, sum(cos(phi)) AS re, sum(sin(phi)) AS im, count(*) AS n FROM gc JOIN fx_phase USING (ps_id) GROUP BY gi, gj, ifg_id)"


def grid(fx):
    return points.grid_accumulate(points.grid_cells(fx.fx_ps, 100.0), fx.fx_phase)


@query("grid_accumulate", "fx_ps fx_phase", f"WITH {GRID} SELECT gi, gj, ifg_id, round(re, 6) + 0.0 AS re, round(im, 6) + 0.0 AS im, n FROM gr")
def _(fx, spark):
    return grid(fx).withColumn("re", r6("re")).withColumn("im", r6("im"))


@query(
    "grid_neighbor_gradient", "fx_ps fx_phase",
    f"WITH {GRID}, a AS (SELECT gi, gj, ifg_id, atan2(im, re) AS v FROM gr), d AS (SELECT p.ifg_id, q.v - p.v AS d FROM a p JOIN a q ON p.ifg_id = q.ifg_id"
    " AND ((q.gi = p.gi + 1 AND q.gj = p.gj) OR (q.gi = p.gi AND q.gj = p.gj + 1)))"
    " SELECT ifg_id, round(avg(d * d), 6) + 0.0 AS msd, count(*) AS n FROM d WHERE d <> 0 GROUP BY ifg_id",
)
def _(fx, spark):
    angles = grid(fx).select("gi", "gj", "ifg_id", F.atan2("im", "re").alias("v"))
    return points.grid_msd(points.grid_neighbours(angles, "v", ["ifg_id"]), ["ifg_id"]).withColumn("msd", r6("msd"))


@query("coherence_resultant", "fx_phase", "SELECT ps_id, round(sqrt(power(sum(cos(phi)), 2) + power(sum(sin(phi)), 2)) / count(*), 6) + 0.0 AS coh, round(atan2(sum(sin(phi)), sum(cos(phi))), 6) + 0.0 AS angle FROM fx_phase GROUP BY ps_id")
def _(fx, spark):
    re, im = F.sum(F.cos("phi")), F.sum(F.sin("phi"))
    return fx.fx_phase.groupBy("ps_id").agg(r6(F.hypot(re, im) / F.count("*")).alias("coh"), r6(F.atan2(im, re)).alias("angle"))


HIST = "hs AS (SELECT r.range AS bin, coalesce(n, 0) AS n FROM range(100) r LEFT JOIN (SELECT CAST(greatest(0, least(99, ceil((coh - 0.01) / 0.01))) AS BIGINT) AS bin, count(*) AS n FROM fx_ps GROUP BY 1) h ON h.bin = r.range)"


@query("hist_with_centers", "fx_ps", f"WITH {HIST} SELECT bin, n FROM hs")
def _(fx, spark):
    return points.histogram(fx.fx_ps, "coh", 0.005, 0.01, 100)


@query("reverse_cumulative_random", "fx_ps", f"WITH {HIST} SELECT bin, CAST(sum(n) OVER (ORDER BY bin DESC) AS BIGINT) AS above FROM hs")
def _(fx, spark):
    from pyspark.sql import Window

    return points.histogram(fx.fx_ps, "coh", 0.005, 0.01, 100).select("bin", F.sum("n").over(Window.orderBy(F.desc("bin"))).alias("above"))


@query("radius_mask", "fx_pts", "SELECT pt FROM fx_pts WHERE sqrt(power(radians(lon + 119.5) * 6371008.8 * cos(radians(35.5)), 2) + power(radians(lat - 35.5) * 6371008.8, 2)) <= 20000")
def _(fx, spark):
    return fx.fx_pts.filter(points.radius_mask(fx.fx_pts, -119.5, 35.5, 20000)).select("pt")


@query(
    "reference_region_score", "fx_ps",
    "WITH c AS (SELECT CAST(floor(x / 200) AS BIGINT) AS cx, CAST(floor(y / 200) AS BIGINT) AS cy, count(*) AS n, quantile_cont(coh, 0.5) AS c50, quantile_cont(coh, 0.1) AS c10 FROM fx_ps GROUP BY 1, 2 HAVING count(*) >= 5),"
    " k AS (SELECT *, cx * 1000 + cy AS id FROM c), r AS (SELECT cx, cy, n, (row_number() OVER (ORDER BY c50, id) - 1) / (count(*) OVER () - 1) AS r50, (row_number() OVER (ORDER BY c10, id) - 1) / (count(*) OVER () - 1) AS r10 FROM k)"
    " SELECT cx, cy, n, round(0.7 * r50 + 0.3 * r10, 6) + 0.0 AS score FROM r",
)
def _(fx, spark):
    cells = fx.fx_ps.groupBy(F.floor(F.col("x") / 200).alias("cx"), F.floor(F.col("y") / 200).alias("cy")).agg(
        F.count("*").alias("n"), F.percentile("coh", F.lit(0.5)).alias("c50"), F.percentile("coh", F.lit(0.1)).alias("c10")
    )
    told = cells.filter("n >= 5").withColumn("id", F.col("cx") * 1000 + F.col("cy"))
    ranked = robust.rank01(robust.rank01(told, "c50", "id", "r50"), "c10", "id", "r10")
    return ranked.select("cx", "cy", "n", r6(0.7 * F.col("r50") + 0.3 * F.col("r10")).alias("score"))


@query(
    "gaussian_spatial_filter", "fx_ps fx_phase",
    "WITH w AS (SELECT p.ps_id, q.ps_id AS other, exp(-(power(p.x - q.x, 2) + power(p.y - q.y, 2)) / (2 * 30 * 30)) AS w FROM fx_ps p JOIN fx_ps q"
    " ON abs(p.x - q.x) < 120 AND abs(p.y - q.y) < 120 AND sqrt(power(p.x - q.x, 2) + power(p.y - q.y, 2)) < 120)"
    " SELECT w.ps_id, ifg_id, round(sum(w * phi) / sum(w), 6) + 0.0 AS v FROM w JOIN fx_phase f ON f.ps_id = w.other GROUP BY w.ps_id, ifg_id",
)
def _(fx, spark):
    return points.gaussian_filter(fx.fx_ps, fx.fx_phase, 30.0).withColumn("v", r6("v"))


@query(
    "nearest_node", "fx_ps",
    "WITH s AS (SELECT * FROM fx_ps WHERE ps_id % 17 = 0), d AS (SELECT p.ps_id, s.ps_id AS other, sqrt(power(p.x - s.x, 2) + power(p.y - s.y, 2)) AS d FROM fx_ps p, s)"
    " SELECT ps_id, other, round(d, 6) + 0.0 AS d FROM (SELECT *, row_number() OVER (PARTITION BY ps_id ORDER BY d, other) AS p FROM d) WHERE p = 1",
)
def _(fx, spark):
    return points.nearest(fx.fx_ps, fx.fx_ps.filter("ps_id % 17 = 0"), 150.0).withColumn("d", r6("d"))


@query("raster_bin_mean", "fx_pts", "SELECT CAST(floor((lat - 35) * 20) AS BIGINT) AS row, CAST(floor((lon + 120) * 20) AS BIGINT) AS col, round(avg(value), 8) + 0.0 AS mean, count(*) AS n FROM fx_pts GROUP BY 1, 2")
def _(fx, spark):
    return points.raster_mean(fx.fx_pts, (F.col("lon") + 120) * 20, (F.col("lat") - 35) * 20, 1.0, "value").withColumn("mean", F.round("mean", 8) + F.lit(0.0))


@query(
    "bilinear_sample", "fx_ps",
    "WITH g AS (SELECT row, col, coh AS value FROM fx_ps WHERE ps_id % 11 <> 0), t AS (SELECT ps_id AS pt, row + 0.25 AS r, col + 0.4 AS c FROM fx_ps),"
    " k AS (SELECT pt, floor(r) + i AS row, floor(c) + j AS col, CASE i WHEN 1 THEN r - floor(r) ELSE 1 - (r - floor(r)) END * CASE j WHEN 1 THEN c - floor(c) ELSE 1 - (c - floor(c)) END AS w FROM t, range(2) a(i), range(2) b(j)),"
    " m AS (SELECT pt, sum(w) AS w, sum(w * value) / sum(w) AS v, arg_max(value, (w, row, col)) AS near FROM k JOIN g USING (row, col) GROUP BY pt)"
    " SELECT pt, round(CASE WHEN w > 0.25 THEN v ELSE near END, 6) + 0.0 AS v FROM m",
)
def _(fx, spark):
    raster = fx.fx_ps.filter("ps_id % 11 <> 0").select("row", "col", F.col("coh").alias("value"))
    at = fx.fx_ps.select(F.col("ps_id").alias("pt"), (F.col("row") + 0.25).alias("r"), (F.col("col") + 0.4).alias("c"))
    return points.bilinear(at, raster).withColumn("v", r6("v"))


@query(
    "point_sampling", "fx_ps",
    "SELECT p.ps_id, round(r.hgt, 6) + 0.0 AS v FROM fx_ps p JOIN fx_ps r ON r.row = p.row AND r.col = 24 - p.col",
)
def _(fx, spark):
    raster = fx.fx_ps.select("row", (24 - F.col("col")).alias("col"), F.col("hgt").alias("v"))
    return sample_raster(raster.withColumnRenamed("v", "value"), fx.fx_ps.select("ps_id", "row", "col")).select("ps_id", r6("value").alias("v"))


@query("even_sampling", "fx_ps", "WITH o AS (SELECT ps_id, row_number() OVER (ORDER BY ps_id) - 1 AS place, count(*) OVER () AS n FROM fx_ps) SELECT ps_id, place FROM o WHERE place IN (SELECT round_even(k * (n - 1) / 40.0, 0) FROM range(41) t(k))")
def _(fx, spark):
    return points.even_sample(fx.fx_ps, "ps_id", 41).select("ps_id", F.col("place").cast("long").alias("place"))


@query(
    "valid_geometry", "fx_ps",
    "SELECT ps_id FROM fx_ps WHERE ps_id % 11 > 4",
)
def _(fx, spark):
    """Longitudes and latitudes out of range, the null island, heights that are no number and missing places go."""
    k = F.col("ps_id") % 11
    spoilt = fx.fx_ps.select(
        "ps_id", F.when(k == 0, 181.0).when(k == 1, 1e-9).when(k == 2, F.lit(None)).otherwise(F.col("lon")).alias("lon"),
        F.when(k == 3, -90.5).when(k == 1, -1e-9).otherwise(F.col("lat")).alias("lat"), F.when(k == 4, F.lit(float("nan"))).otherwise(F.col("hgt")).alias("hgt"),
    )
    return points.valid_coordinates(spoilt).select("ps_id")


@query("phase_validity", "fx_phase", "SELECT ps_id, round(1 - count(*) FILTER (abs(phi) > 3) / count(*), 6) + 0.0 AS valid FROM fx_phase GROUP BY ps_id HAVING count(*) FILTER (abs(phi) > 3) <= 5")
def _(fx, spark):
    marked = fx.fx_phase.withColumn("phi", F.when(F.abs("phi") <= 3, F.col("phi")))
    return points.enough_phases(marked, 5).withColumn("valid", r6("valid"))


@query("gamma_threshold_filter", "fx_ps", "SELECT ps_id FROM fx_ps WHERE coh > 0.05 + 0.15 * d_a AND NOT hgt < 1e-6")
def _(fx, spark):
    return fx.fx_ps.filter((F.col("coh") > 0.05 + 0.15 * F.col("d_a")) & ~(F.col("hgt") < 1e-6)).select("ps_id")


# ---- geometry ----------------------------------------------------------------------------------------------------------

ORBIT, EARTH, NEAR, STEP = 7_070_000.0, 6_371_000.0, 830_000.0, 7.8


@query(
    "radar_geometry", "fx_ps",
    "WITH s AS (SELECT ps_id, 830000.0 + (col * 10 + 4.5) * 7.8 AS s FROM fx_ps) SELECT ps_id, round(s, 3) + 0.0 AS slant, round(acos((7070000.0::DOUBLE * 7070000.0 + s * s - 6371000.0::DOUBLE * 6371000.0) / (2 * 7070000.0 * s)), 6) + 0.0 AS look,"
    " round(acos((7070000.0::DOUBLE * 7070000.0 - 6371000.0::DOUBLE * 6371000.0 - s * s) / (2 * 6371000.0 * s)), 6) + 0.0 AS incidence FROM s",
)
def _(fx, spark):
    s = geometry.slant_range(geometry.original_index(F.col("col"), 10), NEAR, STEP)
    return fx.fx_ps.select("ps_id", (F.round(s, 3) + F.lit(0.0)).alias("slant"), r6(geometry.look_angle(s, ORBIT, EARTH)).alias("look"), r6(geometry.incidence_angle(s, ORBIT, EARTH)).alias("incidence"))


def perpendiculars(fx, ifgs):
    s = geometry.slant_range(geometry.original_index(F.col("col"), 10), NEAR, STEP)
    met = fx.fx_ps.select("ps_id", "row", geometry.look_angle(s, ORBIT, EARTH).alias("look")).crossJoin(F.broadcast(ifgs))
    cross = geometry.baseline_at(F.col("bperp"), F.lit(0.1), F.col("row"), 10, 1680)
    return met.select("ps_id", "ifg_id", r6(geometry.perpendicular(cross, F.col("bperp") / 3, F.col("look"))).alias("b"))


@query(
    "bperp_geometry", "fx_ps fx_ifgs",
    "WITH s AS (SELECT ps_id, row, 830000.0 + (col * 10 + 4.5) * 7.8 AS s FROM fx_ps), l AS (SELECT ps_id, row, acos((7070000.0::DOUBLE * 7070000.0 + s * s - 6371000.0::DOUBLE * 6371000.0) / (2 * 7070000.0 * s)) AS look FROM s)"
    " SELECT ps_id, ifg_id, round((bperp + 0.1 * (row - 10) / 1680) * cos(look) - (bperp / 3) * sin(look), 6) + 0.0 AS b FROM l, fx_ifgs",
)
def _(fx, spark):
    return perpendiculars(fx, fx.fx_ifgs)


@query(
    "local_xy", "fx_ps",
    "WITH o AS (SELECT (min(lon) + max(lon)) / 2 AS lon0, (min(lat) + max(lat)) / 2 AS lat0 FROM fx_ps), e AS (SELECT ps_id, radians(lat) AS phi, radians(lon - lon0) AS dl, radians(lat0) AS phi0 FROM fx_ps, o),"
    " k AS (SELECT 0.0820944379497::DOUBLE * 0.0820944379497 AS e2), m AS (SELECT *, 6378137.0::DOUBLE / sqrt(1 - e2 * power(sin(phi), 2)) AS n,"
    " 6378137.0::DOUBLE * ((1 - e2 / 4 - 3 * e2 * e2 / 64 - 5 * e2 * e2 * e2 / 256) * phi - (3 * e2 / 8 + 3 * e2 * e2 / 32 + 45 * e2 * e2 * e2 / 1024) * sin(2 * phi) + (15 * e2 * e2 / 256 + 45 * e2 * e2 * e2 / 1024) * sin(4 * phi) - 35 * e2 * e2 * e2 / 3072 * sin(6 * phi)) AS arc,"
    " 6378137.0::DOUBLE * ((1 - e2 / 4 - 3 * e2 * e2 / 64 - 5 * e2 * e2 * e2 / 256) * phi0 - (3 * e2 / 8 + 3 * e2 * e2 / 32 + 45 * e2 * e2 * e2 / 1024) * sin(2 * phi0) + (15 * e2 * e2 / 256 + 45 * e2 * e2 * e2 / 1024) * sin(4 * phi0) - 35 * e2 * e2 * e2 / 3072 * sin(6 * phi0)) AS arc0 FROM e, k)"
    " SELECT ps_id, round(n * cot(phi) * sin(dl * sin(phi)), 3) + 0.0 AS x, round(arc - arc0 + n * cot(phi) * (1 - cos(dl * sin(phi))), 3) + 0.0 AS y FROM m",
)
def _(fx, spark):
    centre = fx.fx_ps.agg(((F.min("lon") + F.max("lon")) / 2).alias("lon0"), ((F.min("lat") + F.max("lat")) / 2).alias("lat0"))
    x, y = geometry.polyconic(F.col("lon"), F.col("lat"), F.col("lon0"), F.col("lat0"))
    return fx.fx_ps.crossJoin(F.broadcast(centre)).select("ps_id", (F.round(x, 3) + F.lit(0.0)).alias("x"), (F.round(y, 3) + F.lit(0.0)).alias("y"))


@query("utm_zone", "fx_pts", "SELECT pt, CAST(greatest(1, least(60, floor((lon + 180) / 6) + 1)) + CASE WHEN lat >= 0 THEN 32600 ELSE 32700 END AS INTEGER) AS epsg FROM fx_pts")
def _(fx, spark):
    return fx.fx_pts.select("pt", geometry.utm_epsg(F.col("lon"), F.col("lat")).alias("epsg"))


@query("utm_coordinates")
def _(fx, spark):
    """Checked against published coordinates in the tests."""
    zone = geometry.utm_epsg(F.col("lon"), F.col("lat"))
    x, y = geometry.transverse_mercator(F.col("lon"), F.col("lat"), geometry.central_meridian(zone))
    return fx.fx_pts.select("pt", zone.alias("epsg"), F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


@query("unit_phasor", "fx_amp", "SELECT pixel, image, round(amp / sqrt(amp * amp + image * image), 6) + 0.0 AS re, round(image / sqrt(amp * amp + image * image), 6) + 0.0 AS im FROM fx_amp WHERE amp > 0")
def _(fx, spark):
    re, im = phase.unit(F.col("amp"), F.col("image").cast("double"))
    return fx.fx_amp.filter("amp > 0").select("pixel", "image", r6(re).alias("re"), r6(im).alias("im"))


@query("ramp_removal", "fx_phase fx_ifgs", "SELECT ps_id, ifg_id, round(cos(phi) * cos(0.01 * bperp) + sin(phi) * sin(0.01 * bperp), 6) + 0.0 AS re, round(sin(phi) * cos(0.01 * bperp) - cos(phi) * sin(0.01 * bperp), 6) + 0.0 AS im FROM fx_phase JOIN fx_ifgs USING (ifg_id)")
def _(fx, spark):
    re, im = phase.rotate(F.cos("phi"), F.sin("phi"), 0.01 * F.col("bperp"))
    return fx.fx_phase.join(F.broadcast(fx.fx_ifgs), "ifg_id").select("ps_id", "ifg_id", r6(re).alias("re"), r6(im).alias("im"))


@query("datenum_roundtrip", "orders", "SELECT o_orderkey, CAST(datediff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) + 719529 AS INTEGER) AS datenum, CAST(o_orderdate AS DATE)::VARCHAR AS back FROM orders")
def _(fx, spark):
    day = phase.datenum(F.to_date("o_orderdate"))
    return fx.orders.select("o_orderkey", day.alias("datenum"), phase.from_datenum(day).cast("string").alias("back"))


@query("quantized_xy", "fx_ps", "SELECT ps_id, round(CAST(sign(x + 0.0004) * floor(abs((x + 0.0004) * 1000) + 0.5) / 1000 AS FLOAT), 4) + 0.0 AS x FROM fx_ps")
def _(fx, spark):
    return fx.fx_ps.select("ps_id", (F.round(phase.millimetres(F.col("x") + 0.0004).cast("double"), 4) + F.lit(0.0)).alias("x"))


# ---- dense kernels -------------------------------------------------------------------------------------------------------


def baselines(fx) -> list[float]:
    return [r["bperp"] for r in fx.fx_ifgs.orderBy("ifg_id").collect()]  # a row for each interferogram


@query("topofit_refined")
def _(fx, spark):
    """Tested against planted slopes."""
    from fringelake.operators import blocks

    return blocks.estimate_coherence(fx.fx_phase, baselines(fx), 1.0)


@query("grid_goldstein_filter")
def _(fx, spark):
    from fringelake.operators import blocks

    return blocks.filter_grid(grid(fx).select("gi", "gj", "ifg_id", "re", "im"), "goldstein")


@query("grid_adaptive_filter")
def _(fx, spark):
    from fringelake.operators import blocks

    return blocks.filter_grid(grid(fx).select("gi", "gj", "ifg_id", "re", "im"), "adaptive")


@query("grid_unwrap")
def _(fx, spark):
    from fringelake.operators import blocks

    return blocks.unwrap_grid(grid(fx).select("gi", "gj", "ifg_id", "re", "im"))


@query("unwrapped_points")
def _(fx, spark):
    from fringelake.operators import blocks

    cells = points.grid_cells(fx.fx_ps, 100.0)
    return blocks.restore_points(fx.fx_phase, cells, blocks.unwrap_grid(grid(fx).select("gi", "gj", "ifg_id", "re", "im")))


@query("delaunay_arcs")
def _(fx, spark):
    from fringelake.operators import blocks

    return blocks.delaunay_arcs(fx.fx_ps.withColumn("patch_id", F.floor(F.col("row") / 10)))


@query("arc_smoothing")
def _(fx, spark):
    from fringelake.operators import blocks

    days = fx.fx_ifgs.select("ifg_id", (F.col("ifg_id") * 12.0).alias("day"))
    return blocks.arc_smoothing(graph.arc_differences(arcs(fx), fx.fx_phase), days, 36.0)


@query("robust_deramp")
def _(fx, spark):
    from fringelake.operators import blocks

    return blocks.robust_deramp(fx.fx_phase.join(fx.fx_ps.select("ps_id", "x", "y", "coh"), "ps_id"))


@query("random_coherence_histogram")
def _(fx, spark):
    from fringelake.operators import blocks

    return blocks.random_histogram(spark, baselines(fx), 1.0)


@query(
    "label_edge_rasters", "fx_ps",
    "WITH " + CELLS.replace("/ 100)", "/ 30)") + ", oc AS (SELECT DISTINCT gi, gj FROM gc), nd AS (SELECT gi, gj, row_number() OVER (ORDER BY gj, gi) AS node FROM oc), ex AS (SELECT max(gi) AS r, max(gj) AS c FROM oc),"
    " al AS (SELECT i.range AS gi, j.range AS gj FROM range(1, (SELECT r + 1 FROM ex)) i, range(1, (SELECT c + 1 FROM ex)) j),"
    " z AS (SELECT gi, gj, node AS z FROM (SELECT al.gi, al.gj, node, row_number() OVER (PARTITION BY al.gi, al.gj ORDER BY sqrt(power(al.gi - nd.gi, 2) + power(al.gj - nd.gj, 2)), node) AS p FROM al, nd) WHERE p = 1),"
    " pr AS (SELECT p.gi, p.gj, 'c' AS kind, p.z AS z0, q.z AS z1 FROM z p JOIN z q ON q.gi = p.gi AND q.gj = p.gj + 1 UNION ALL SELECT p.gi, p.gj, 'r', p.z, q.z FROM z p JOIN z q ON q.gi = p.gi + 1 AND q.gj = p.gj),"
    " ed AS (SELECT lo, hi, row_number() OVER (ORDER BY lo, hi) AS n FROM (SELECT DISTINCT least(z0, z1) AS lo, greatest(z0, z1) AS hi FROM pr WHERE z0 <> z1)),"
    " sg AS (SELECT gi, gj, kind, CASE WHEN z0 = z1 THEN 0 WHEN z1 > z0 THEN n ELSE -n END AS ix FROM pr LEFT JOIN ed ON lo = least(z0, z1) AND hi = greatest(z0, z1))"
    " SELECT z.gi, z.gj, z.z, c.ix AS colix, r.ix AS rowix FROM z LEFT JOIN sg c ON c.gi = z.gi AND c.gj = z.gj AND c.kind = 'c' LEFT JOIN sg r ON r.gi = z.gi AND r.gj = z.gj AND r.kind = 'r'",
)
def _(fx, spark):
    return points.label_edges(points.label_raster(points.grid_cells(fx.fx_ps, 30.0)))


@query("arc_space_time")
def _(fx, spark):
    """Tested against planted series."""
    from fringelake.operators import blocks

    ifgs = fx.fx_ifgs.orderBy("ifg_id").collect()  # a row for each interferogram
    days = [r["day"] for r in fx.fx_images.orderBy("image_ix").collect()]  # a row for each acquisition
    pairs = [(r["a"] - 1, r["b"] - 1) for r in ifgs]
    return blocks.arc_space_time(graph.arc_differences(arcs(fx), fx.fx_phase), pairs, days, [r["bperp"] for r in ifgs], 60.0, "3D_QUICK", 1.0)
