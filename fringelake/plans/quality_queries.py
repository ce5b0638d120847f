"""Queries of the network quality control."""

from __future__ import annotations

from pyspark.sql import functions as F

from fringelake.functions.phase import r6
from fringelake.operators import graph, network, points, robust
from fringelake.plans.point_queries import GRID, grid
from fringelake.plans.registry import query

#: DuckDB macros are not available to the driver, so shared steps are written out as common table expressions.
NOISE = "s AS (SELECT ifg_id, degrees(sqrt(avg(phi * phi))) AS x FROM fx_phase GROUP BY ifg_id)"
Z = (
    NOISE + ", m AS (SELECT median(x) AS med, max(x) - min(x) AS spread, count(*) AS n FROM s), d AS (SELECT median(abs(x - med)) AS mad FROM s, m),"
    " z AS (SELECT ifg_id, x, greatest(0, (x - med) / CASE WHEN 1.4826 * mad > 1e-12 THEN 1.4826 * mad ELSE spread / greatest(10, sqrt(n)) END) AS z FROM s, m, d)"
)
TEMPORAL = (
    "t AS (SELECT s.ifg_id, x, a, b, dt FROM s JOIN fx_ifgs USING (ifg_id)),"
    " q AS (SELECT list_sort(list_distinct(quantile_cont(dt, [0, 0.125, 0.25, 0.375, 0.5, 0.625, 0.75, 0.875, 1]))) AS edges FROM t),"
    " tb AS (SELECT t.*, len(list_filter(edges[2:len(edges) - 1], lambda e: e <= dt)) AS bin FROM t, q),"
    " tm AS (SELECT bin, median(x) AS med, count(*) AS n, max(x) - min(x) AS spread FROM tb GROUP BY bin),"
    " td AS (SELECT bin, median(abs(x - med)) AS mad FROM tb JOIN tm USING (bin) GROUP BY bin),"
    " tz AS (SELECT ifg_id, bin, CASE WHEN n >= 8 THEN greatest(0, (x - med) / CASE WHEN 1.4826 * mad > 1e-12 THEN 1.4826 * mad"
    " ELSE spread / greatest(10, sqrt(n)) END) ELSE 0 END AS context_z FROM tb JOIN tm USING (bin) JOIN td USING (bin))"
)
ENDPOINT = (
    "e AS (SELECT ifg_id, unnest([a, b]) AS image FROM fx_ifgs), pe AS (SELECT DISTINCT e.ifg_id, f.ifg_id AS peer FROM e JOIN e f USING (image) WHERE e.ifg_id <> f.ifg_id),"
    " pv AS (SELECT pe.ifg_id, s.x AS theirs FROM pe JOIN s ON s.ifg_id = pe.peer), pm AS (SELECT ifg_id, median(theirs) AS med, count(*) AS n FROM pv GROUP BY ifg_id),"
    " pd AS (SELECT ifg_id, 1.4826 * median(abs(theirs - med)) AS mad FROM pv JOIN pm USING (ifg_id) GROUP BY ifg_id),"
    " ez AS (SELECT s.ifg_id, CASE WHEN n >= 6 THEN greatest(0, (x - med) / mad) ELSE 0 END AS endpoint_z FROM s JOIN pm USING (ifg_id) JOIN pd USING (ifg_id))"
)


def noise(fx):
    """A row for each interferogram, written once: contexts and ranks read it many times, the phases only once."""
    return graph.written(network.phase_noise(fx.fx_phase).withColumnRenamed("std_deg", "x").coalesce(1))


@query("ifg_phase_noise", "fx_phase", f"WITH {NOISE} SELECT ifg_id, round(x, 6) + 0.0 AS std_deg FROM s")
def _(fx, spark):
    return noise(fx).select("ifg_id", r6("x").alias("std_deg"))


@query("ifg_robust_z", "fx_phase", f"WITH {Z} SELECT ifg_id, round(z, 6) + 0.0 AS z FROM z")
def _(fx, spark):
    return robust.robust_high_z(noise(fx), "x", "z").select("ifg_id", r6("z").alias("z"))


@query("ifg_percentile_rank", "fx_phase", f"WITH {NOISE} SELECT ifg_id, round(row_number() OVER (ORDER BY x, ifg_id) / count(*) OVER (), 6) + 0.0 AS rank FROM s")
def _(fx, spark):
    return robust.percentile_rank(noise(fx), "x", "ifg_id", "rank").select("ifg_id", r6("rank").alias("rank"))


@query("ifg_ecdf", "fx_phase", f"WITH {NOISE} SELECT ifg_id, round(cume_dist() OVER (ORDER BY floor(x)), 6) + 0.0 AS ecdf FROM s")
def _(fx, spark):
    return robust.ecdf(noise(fx).withColumn("x", F.floor("x")), "x", "ecdf").select("ifg_id", r6("ecdf").alias("ecdf"))


@query("ifg_midrank", "fx_phase", f"WITH {NOISE} SELECT ifg_id, round((rank() OVER (ORDER BY floor(x)) - 1 + (count(*) OVER (PARTITION BY floor(x)) + 1) / 2) / count(*) OVER (), 6) + 0.0 AS pct FROM s")
def _(fx, spark):
    return robust.mid_rank(noise(fx).withColumn("x", F.floor("x")), "x", "pct").select("ifg_id", r6("pct").alias("pct"))


@query("rank01", "fx_phase", f"WITH {NOISE} SELECT ifg_id, round((row_number() OVER (ORDER BY x, ifg_id) - 1) / (count(*) OVER () - 1), 6) + 0.0 AS rank FROM s")
def _(fx, spark):
    return robust.rank01(noise(fx), "x", "ifg_id", "rank").select("ifg_id", r6("rank").alias("rank"))


def with_network(fx):
    return graph.written(noise(fx).join(fx.fx_ifgs, "ifg_id").coalesce(1))


@query("ifg_temporal_context_z", "fx_phase fx_ifgs", f"WITH {NOISE}, {TEMPORAL} SELECT ifg_id, CAST(bin AS INTEGER) AS bin, round(context_z, 6) + 0.0 AS context_z FROM tz")
def _(fx, spark):
    return network.temporal_context(with_network(fx), "x", "dt", "context_z").select("ifg_id", "bin", r6("context_z").alias("context_z"))


@query("ifg_endpoint_context_z", "fx_phase fx_ifgs", f"WITH {NOISE}, {ENDPOINT} SELECT ifg_id, round(endpoint_z, 6) + 0.0 AS endpoint_z FROM ez")
def _(fx, spark):
    return network.endpoint_context(with_network(fx), "x", "endpoint_z").select("ifg_id", r6("endpoint_z").alias("endpoint_z"))


def evidence(fx):
    return network.evidence_table(with_network(fx), "x", "dt")


EVIDENCE = (
    f"{Z}, {TEMPORAL}, {ENDPOINT}, r AS (SELECT ifg_id, row_number() OVER (ORDER BY x, ifg_id) / count(*) OVER () AS rank FROM s),"
    " ev AS (SELECT ifg_id, z, context_z, endpoint_z, rank, CAST(z >= 4 AS INTEGER) + CAST(context_z >= 3.5 AS INTEGER) + CAST(endpoint_z >= 3.5 AS INTEGER)"
    " + CAST(rank >= 0.99 AS INTEGER) AS n_evidence, 0.45 * least(z, 8) / 8 + 0.25 * least(context_z, 8) / 8 + 0.20 * least(endpoint_z, 8) / 8 + 0.10 * rank AS score"
    " FROM z JOIN tz USING (ifg_id) JOIN ez USING (ifg_id) JOIN r USING (ifg_id))"
)


@query("ifg_evidence_score", "fx_phase fx_ifgs", f"WITH {EVIDENCE} SELECT ifg_id, n_evidence, n_evidence >= 2 AND z >= 3 AS candidate, round(score, 6) + 0.0 AS score FROM ev")
def _(fx, spark):
    return evidence(fx).select("ifg_id", "n_evidence", "candidate", r6("score").alias("score"))


@query("ifg_score_order", "fx_phase fx_ifgs", f"WITH {EVIDENCE} SELECT row_number() OVER (ORDER BY score DESC, ifg_id) AS place, ifg_id FROM ev ORDER BY place LIMIT 20")
def _(fx, spark):
    """A top-20 report."""
    top = evidence(fx).orderBy(F.desc("score"), "ifg_id").limit(20)
    from pyspark.sql import Window

    return top.select(F.row_number().over(Window.orderBy(F.desc("score"), "ifg_id")).cast("long").alias("place"), "ifg_id")


@query("ifg_greedy_removal")
def _(fx, spark):
    """Sequential by nature; the network has 64 rows."""
    rows = [r.asDict() for r in evidence(fx).select("ifg_id", "a", "b", (F.col("score") > 0.3).alias("candidate"), "score").collect()]
    dropped = network.greedy_removal(rows, 0.10)
    return spark.createDataFrame([(r["ifg_id"], r["ifg_id"] in dropped) for r in rows], "ifg_id long, dropped boolean")


CLOSURE = (
    "tri AS (SELECT p.ifg_id AS ab, q.ifg_id AS bc, r.ifg_id AS ac FROM fx_ifgs p JOIN fx_ifgs q ON p.b = q.a JOIN fx_ifgs r ON r.a = p.a AND r.b = q.b),"
    " ang AS (SELECT ab, bc, ac, x.phi + y.phi - w.phi AS s FROM tri JOIN fx_phase x ON x.ifg_id = ab JOIN fx_phase y ON y.ifg_id = bc AND y.ps_id = x.ps_id"
    " JOIN fx_phase w ON w.ifg_id = ac AND w.ps_id = x.ps_id), cl AS (SELECT ab, bc, ac, count(*) AS n, sqrt(avg(power(atan2(sin(s), cos(s)), 2))) AS rms,"
    " 1 - sqrt(power(avg(cos(s)), 2) + power(avg(sin(s)), 2)) AS incoherence FROM ang GROUP BY ab, bc, ac)"
)


@query("triangle_closure", "fx_phase fx_ifgs", f"WITH {CLOSURE} SELECT ab, bc, ac, n, round(rms, 6) + 0.0 AS rms, round(incoherence, 6) + 0.0 AS incoherence FROM cl")
def _(fx, spark):
    found = network.closure(fx.fx_phase, network.triangles(fx.fx_ifgs))
    return found.select("ab", "bc", "ac", "n", r6("rms").alias("rms"), r6("incoherence").alias("incoherence"))


@query("closure_by_ifg", "fx_phase fx_ifgs", f"WITH {CLOSURE}, sd AS (SELECT unnest([ab, bc, ac]) AS ifg_id, rms, incoherence FROM cl) SELECT ifg_id, round(median(rms), 6) + 0.0 AS rms, round(median(incoherence), 6) + 0.0 AS incoherence, count(*) AS n_loops FROM sd GROUP BY ifg_id")
def _(fx, spark):
    found = network.closure_by_edge(network.closure(fx.fx_phase, network.triangles(fx.fx_ifgs)))
    return found.select("ifg_id", r6("rms").alias("rms"), r6("incoherence").alias("incoherence"), "n_loops")


@query(
    "residual_metrics", "fx_phase",
    "WITH m AS (SELECT ifg_id, median(phi) AS med FROM fx_phase GROUP BY ifg_id), d AS (SELECT ifg_id, phi - med AS d FROM fx_phase JOIN m USING (ifg_id))"
    " SELECT ifg_id, round(sqrt(avg(d * d)), 6) + 0.0 AS rms, round(1.4826 * median(abs(d)), 6) + 0.0 AS mad, round(quantile_cont(abs(d), 0.95), 6) + 0.0 AS p95,"
    " round(avg(CAST(abs(d) > pi() AS INTEGER)), 6) + 0.0 AS jumps, count(*) AS n FROM d GROUP BY ifg_id HAVING count(*) >= 100",
)
def _(fx, spark):
    found = network.residual_metrics(fx.fx_phase, x="phi")
    return found.select("ifg_id", *(r6(c).alias(c) for c in ("rms", "mad", "p95", "jumps")), "n")


#: Grids of two by two cells as the low-pass of the grid; every thirteenth cell of an interferogram is invalid.
METRICS = (
    GRID + ", lp AS (SELECT gi, gj, ifg_id, re, im, CASE WHEN (gi * 5 + gj * 3 + ifg_id) % 13 > 0 THEN sum(re) OVER w ELSE 0 END AS lre, CASE WHEN (gi * 5 + gj * 3 + ifg_id) % 13 > 0 THEN sum(im) OVER w ELSE 0 END AS lim FROM gr"
    " WINDOW w AS (PARTITION BY ifg_id, floor((gi - 1) / 2), floor((gj - 1) / 2))), rs AS (SELECT ifg_id, gi, gj, CASE WHEN sqrt(re * re + im * im) > 0 AND sqrt(lre * lre + lim * lim) > 0 THEN atan2(im * lre - re * lim, re * lre + im * lim) END AS r FROM lp),"
    " mn AS (SELECT ifg_id, 1 - count(r) / count(*) AS invalid_fraction, sqrt(avg(r * r)) AS residual_rms, 1 - sqrt(power(avg(cos(r)), 2) + power(avg(sin(r)), 2)) AS residual_incoherence, atan2(avg(sin(r)), avg(cos(r))) AS centre FROM rs GROUP BY ifg_id),"
    " ap AS (SELECT ifg_id, abs(atan2(sin(r - centre), cos(r - centre))) AS a FROM rs JOIN mn USING (ifg_id) WHERE r IS NOT NULL),"
    " sp AS (SELECT ifg_id, 1.4826 * median(a) AS residual_mad, avg(CAST(a > pi() / 2 AS INTEGER)) AS extreme_fraction FROM ap GROUP BY ifg_id),"
    " gs AS (SELECT p.ifg_id, atan2(sin(q.r - p.r), cos(q.r - p.r)) AS d FROM rs p JOIN rs q ON p.ifg_id = q.ifg_id AND ((q.gi = p.gi + 1 AND q.gj = p.gj) OR (q.gi = p.gi AND q.gj = p.gj + 1)) WHERE p.r IS NOT NULL AND q.r IS NOT NULL),"
    " gc0 AS (SELECT ifg_id, atan2(avg(sin(d)), avg(cos(d))) AS c FROM gs GROUP BY ifg_id HAVING count(*) >= 8), gm AS (SELECT ifg_id, 1.4826 * median(abs(atan2(sin(d - c), cos(d - c)))) AS gradient_mad FROM gs JOIN gc0 USING (ifg_id) GROUP BY ifg_id),"
    " gmet AS (SELECT * FROM mn JOIN sp USING (ifg_id) LEFT JOIN gm USING (ifg_id))"
)


def grid_metrics(fx):
    from pyspark.sql import Window

    block = Window.partitionBy("ifg_id", F.floor((F.col("gi") - 1) / 2), F.floor((F.col("gj") - 1) / 2))
    valid = F.pmod(F.col("gi") * 5 + F.col("gj") * 3 + F.col("ifg_id"), F.lit(13)) > 0
    low = lambda c: F.when(valid, F.sum(c).over(block)).otherwise(0.0)
    return network.grid_residuals(grid(fx).withColumn("lre", low("re")).withColumn("lim", low("im")))


@query("grid_residual_metrics", "fx_ps fx_phase", f"WITH {METRICS} SELECT ifg_id, {', '.join(f'round({c}, 6) + 0.0 AS {c}' for c in ('residual_rms', 'residual_mad', 'residual_incoherence', 'extreme_fraction', 'invalid_fraction', 'gradient_mad'))} FROM gmet")
def _(fx, spark):
    told = grid_metrics(fx)
    return told.select("ifg_id", *(r6(c).alias(c) for c in told.columns if c != "ifg_id"))


FAMILY = (
    METRICS + ", " + CLOSURE + ", cs AS (SELECT unnest([ab, bc, ac]) AS ifg_id, rms, incoherence FROM cl), cm AS (SELECT ifg_id, median(rms) AS closure_rms, median(incoherence) AS closure_incoherence FROM cs GROUP BY ifg_id),"
    " ns AS (SELECT ifg_id, degrees(sqrt(avg(phi * phi))) AS ifg_std FROM fx_phase GROUP BY ifg_id), al AS (SELECT ifg_id, closure_rms, closure_incoherence, residual_rms, residual_mad, residual_incoherence, extreme_fraction, gradient_mad, CAST(invalid_fraction AS DOUBLE) AS invalid_fraction, ifg_std FROM gmet JOIN cm USING (ifg_id) JOIN ns USING (ifg_id)),"
    " lg AS (UNPIVOT al ON closure_rms, closure_incoherence, residual_rms, residual_mad, residual_incoherence, extreme_fraction, gradient_mad, invalid_fraction, ifg_std INTO NAME f VALUE x),"
    " m AS (SELECT f, median(x) AS med, stddev_pop(x) AS sd, max(x) - min(x) AS spread, count(*) AS n, min(x) = max(x) AS flat FROM lg GROUP BY f), d AS (SELECT f, median(abs(x - med)) AS mad FROM lg JOIN m USING (f) GROUP BY f),"
    " z AS (SELECT ifg_id, f, greatest(0, (x - med) / CASE WHEN 1.4826 * mad > 1e-12 THEN 1.4826 * mad ELSE greatest(sd, spread / sqrt(n), 1e-12) END) AS z,"
    " CASE WHEN flat THEN 0.5 ELSE (rank() OVER (PARTITION BY f ORDER BY x) - 1 + (count(*) OVER (PARTITION BY f, x) + 1) / 2) / n END AS pct FROM lg JOIN m USING (f) JOIN d USING (f)),"
    " fm AS (SELECT ifg_id, CASE WHEN f LIKE 'closure%' THEN 'closure' WHEN f LIKE 'residual%' OR f = 'extreme_fraction' THEN 'residual' WHEN f = 'gradient_mad' THEN 'gradient' WHEN f = 'invalid_fraction' THEN 'validity' ELSE 'noise' END AS fam, max(z) AS z, max(pct) AS pct FROM z GROUP BY 1, 2),"
    " fe AS (SELECT ifg_id, sum(CAST(pct >= 0.9 AS INTEGER)) AS n_bad, sum(CAST(z >= 4.5 AS INTEGER)) AS n_extreme, sum(least(z, 8) * CASE fam WHEN 'closure' THEN 0.3 WHEN 'residual' THEN 0.3 WHEN 'gradient' THEN 0.2 ELSE 0.1 END) AS score FROM fm GROUP BY ifg_id)"
)


def families(fx):
    """The grid control's evidence, from closures, residuals, gradients, validity and noise as they are computed."""
    closed = network.closure_by_edge(network.closure(fx.fx_phase, network.triangles(fx.fx_ifgs)))
    noise_ = network.phase_noise(fx.fx_phase).withColumnRenamed("std_deg", "ifg_std")
    joined = grid_metrics(fx).join(closed.select("ifg_id", F.col("rms").alias("closure_rms"), F.col("incoherence").alias("closure_incoherence")), "ifg_id").join(noise_, "ifg_id")
    return graph.written(network.family_evidence(graph.written(joined.coalesce(1))).coalesce(1))


@query("family_evidence", "fx_ps fx_phase fx_ifgs", f"WITH {FAMILY} SELECT ifg_id, CAST(n_bad AS BIGINT) AS n_bad, CAST(n_extreme AS BIGINT) AS n_extreme, round(score, 5) + 0.0 AS score FROM fe")
def _(fx, spark):
    return families(fx).withColumn("score", F.round("score", 5) + F.lit(0.0))


def scored(fx):
    return families(fx).join(fx.fx_ifgs.select("ifg_id", "a", "b"), "ifg_id")


GRIDZ = "CASE WHEN 1.4826 * mad > 1e-12 THEN 1.4826 * mad ELSE greatest(sd, spread / sqrt(n), 1e-12) END"
CANDIDATES = (
    FAMILY + ", sc AS (SELECT fe.*, a, b FROM fe JOIN fx_ifgs USING (ifg_id)), sm0 AS (SELECT median(score) AS med, stddev_pop(score) AS sd, max(score) - min(score) AS spread, count(*) AS n FROM sc), sd0 AS (SELECT median(abs(score - med)) AS mad FROM sc, sm0),"
    f" sz AS (SELECT sc.*, greatest(0, (score - med) / {GRIDZ}) AS score_z, (rank() OVER (ORDER BY score) - 1 + (count(*) OVER (PARTITION BY score) + 1) / 2) / n AS score_pct FROM sc, sm0, sd0),"
    " ba AS (SELECT *, (score_pct >= 1 - {tail} AND score_z >= {z} AND n_bad >= 2) OR n_extreme >= 2 AS base FROM sz), nd AS (SELECT unnest([a, b]) AS node, score, base FROM ba),"
    " nm AS (SELECT node, count(*) AS degree, median(score) AS middle, count(*) >= 3 AND avg(CAST(base AS INTEGER)) >= 0.5 AS clustered FROM nd GROUP BY node),"
    " ex AS (SELECT ba.*, score - (p.middle + q.middle) / 2 AS excess, p.clustered OR q.clustered AS clustered, least(p.degree, q.degree) AS degree FROM ba JOIN nm p ON p.node = a JOIN nm q ON q.node = b),"
    " em AS (SELECT median(excess) AS med, stddev_pop(excess) AS sd, max(excess) - min(excess) AS spread, count(*) AS n FROM ex), ed AS (SELECT median(abs(excess - med)) AS mad FROM ex, em),"
    f" cz AS (SELECT ex.*, greatest(0, (excess - med) / {GRIDZ}) AS excess_z FROM ex, em, ed)"
    " SELECT ifg_id, base, round(score_z, 4) + 0.0 AS score_z, round(excess_z, 4) + 0.0 AS excess_z, clustered, base AND (excess_z >= CASE WHEN clustered THEN {far} ELSE {near} END OR (degree < 3 AND score_z >= 4 AND n_extreme >= 2)) AS candidate FROM cz"
)


def candidates(fx, **limits):
    told = network.grid_candidates(scored(fx), **limits)
    return told.select("ifg_id", "base", (F.round("score_z", 4) + F.lit(0.0)).alias("score_z"), (F.round("excess_z", 4) + F.lit(0.0)).alias("excess_z"), "clustered", "candidate")


def filled_in(text, **values):
    for name, value in values.items():
        text = text.replace("{" + name + "}", str(value))
    return text


@query("grid_candidates", "fx_ps fx_phase fx_ifgs", "WITH " + filled_in(CANDIDATES, tail=0.02, z=2.5, near=2.5, far=3.5))
def _(fx, spark):
    return candidates(fx)


@query("grid_candidates_lenient", "fx_ps fx_phase fx_ifgs", "WITH " + filled_in(CANDIDATES, tail=0.3, z=0.5, near=0.2, far=0.8))
def _(fx, spark):
    """Limits low enough that each part of the rule decides some rows."""
    return candidates(fx, tail=0.3, z=0.5, excess=0.2, clustered=0.8)


FINAL = (
    FAMILY + ", rm0 AS (SELECT ifg_id, median(phi) AS med FROM fx_phase GROUP BY ifg_id), rd AS (SELECT ifg_id, phi - med AS d FROM fx_phase JOIN rm0 USING (ifg_id)),"
    " rt AS (SELECT ifg_id, sqrt(avg(d * d)) AS rms, 1.4826 * median(abs(d)) AS mad, avg(CAST(abs(d) > pi() AS INTEGER)) AS jumps FROM rd GROUP BY ifg_id),"
    " rl AS (UNPIVOT rt ON rms, mad, jumps INTO NAME f VALUE x), rm AS (SELECT f, median(x) AS med, stddev_pop(x) AS sd FROM rl GROUP BY f), rx AS (SELECT f, median(abs(x - med)) AS mad FROM rl JOIN rm USING (f) GROUP BY f),"
    " rz AS (SELECT ifg_id, f, greatest(0, (x - med) / CASE WHEN 1.4826 * mad > 1e-12 THEN 1.4826 * mad WHEN sd > 1e-12 THEN sd ELSE 1 END) AS z FROM rl JOIN rm USING (f) JOIN rx USING (f)),"
    " nz AS (SELECT ifg_id, median(z) AS network_z FROM rz GROUP BY ifg_id), gd AS (SELECT p.ifg_id, q.v - p.v AS d FROM (SELECT gi, gj, ifg_id, atan2(im, re) AS v FROM gr) p JOIN (SELECT gi, gj, ifg_id, atan2(im, re) AS v FROM gr) q ON p.ifg_id = q.ifg_id AND ((q.gi = p.gi + 1 AND q.gj = p.gj) OR (q.gi = p.gi AND q.gj = p.gj + 1))),"
    " ms AS (SELECT ifg_id, avg(d * d) AS msd FROM gd WHERE d <> 0 GROUP BY ifg_id), fl AS (SELECT ifg_id, network_z, cume_dist() OVER (ORDER BY round(network_z, 9)) AS network_pct, cume_dist() OVER (ORDER BY round(msd, 9)) AS msd_pct, n_bad >= 1 AS grid_family, n_bad >= 2 AS grid_strong FROM nz JOIN ms USING (ifg_id) JOIN fe USING (ifg_id))"
)


def final_table(fx):
    """Network and MSD percentiles of each interferogram beside the grid control's verdicts."""
    angles = grid(fx).select("gi", "gj", "ifg_id", F.atan2("im", "re").alias("v"))
    msd = points.grid_msd(points.grid_neighbours(angles, "v", ["ifg_id"]), ["ifg_id"])
    return network.final_percentiles(graph.written(network.residual_metrics(fx.fx_phase, x="phi").coalesce(1)), msd, families(fx))


@query("final_flags", "fx_ps fx_phase fx_ifgs",
    f"WITH {FINAL} SELECT ifg_id, round(network_z, 5) + 0.0 AS network_z, round(network_pct, 6) + 0.0 AS network_pct, round(msd_pct, 6) + 0.0 AS msd_pct, concat_ws(',', CASE WHEN network_pct >= 0.99 THEN 'network_extreme' END, CASE WHEN network_pct >= 0.975 AND grid_family THEN 'network_strong+grid' END,"
    " CASE WHEN network_pct >= 0.975 AND msd_pct >= 0.975 THEN 'network_strong+unwrap' END, CASE WHEN msd_pct >= 0.99 AND grid_strong THEN 'unwrap_extreme+grid_strong' END) AS reasons FROM fl")  # fmt: skip
def _(fx, spark):
    told = network.final_flags(final_table(fx))
    return told.select("ifg_id", (F.round("network_z", 5) + F.lit(0.0)).alias("network_z"), r6("network_pct").alias("network_pct"), r6("msd_pct").alias("msd_pct"), "reasons")


@query(
    "node_context", "fx_net",
    "WITH e AS (SELECT a, b, stat, stat > 0.0293 AS cand FROM fx_net), i AS (SELECT *, unnest([a, b]) AS node FROM e),"
    " n AS (SELECT node, count(*) AS degree, median(stat) AS middle, count(*) >= 3 AND avg(CAST(cand AS INTEGER)) >= 0.5 AS clustered FROM i GROUP BY node)"
    " SELECT e.a, e.b, p.degree AS degree_a, q.degree AS degree_b, round(stat - (p.middle + q.middle) / 2, 6) + 0.0 AS excess, p.clustered OR q.clustered AS clustered"
    " FROM e JOIN n p ON p.node = e.a JOIN n q ON q.node = e.b",
)
def _(fx, spark):
    told = network.node_context(fx.fx_net.withColumn("cand", F.col("stat") > 0.0293), "stat", "cand")
    return told.select("a", "b", "degree_a", "degree_b", r6("excess").alias("excess"), "clustered")


@query(
    "network_reachability", "fx_ifgs",
    "WITH RECURSIVE l AS (SELECT a AS p, b AS q FROM fx_ifgs UNION SELECT b, a FROM fx_ifgs), r AS (SELECT CAST(1 AS BIGINT) AS node UNION"
    " SELECT l.q FROM r JOIN l ON l.p = r.node) SELECT DISTINCT node FROM r",
)
def _(fx, spark):
    return network.connected_to(fx.fx_ifgs, 1)


@query(
    "circular_mad", "fx_phase",
    "WITH c AS (SELECT ifg_id, atan2(avg(sin(phi)), avg(cos(phi))) AS centre FROM fx_phase GROUP BY ifg_id), d AS (SELECT ifg_id, centre,"
    " abs(atan2(sin(phi - centre), cos(phi - centre))) AS apart FROM fx_phase JOIN c USING (ifg_id))"
    " SELECT ifg_id, round(any_value(centre), 6) + 0.0 AS centre, round(1.4826 * median(apart), 6) + 0.0 AS mad FROM d GROUP BY ifg_id",
)
def _(fx, spark):
    return robust.circular_mad(fx.fx_phase, ["ifg_id"], "phi").select("ifg_id", r6("centre").alias("centre"), r6("mad").alias("mad"))


@query(
    "peer_interferograms", "fx_ifgs",
    "WITH e AS (SELECT ifg_id, unnest([a, b]) AS image FROM fx_ifgs) SELECT DISTINCT e.ifg_id, f.ifg_id AS peer FROM e JOIN e f USING (image) WHERE e.ifg_id <> f.ifg_id",
)
def _(fx, spark):
    return network.peers(fx.fx_ifgs)


@query(
    "drop_list_anti_join", "fx_ifgs",
    "SELECT row_number() OVER (ORDER BY ifg_id) AS solve_ix, ifg_id FROM fx_ifgs WHERE ifg_id NOT IN (3, 17, 40)",
)
def _(fx, spark):
    return network.kept_index(fx.fx_ifgs, [3, 17, 40])
