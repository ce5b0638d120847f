"""The run from wrapped phases to velocities: nine stages over the tables of a dataset folder.

Input tables: ``ps`` (ps_id, patch_id, row, col, x, y, lon, lat, d_a, hgt), ``phase`` (ps_id, ifg_id, phi), ``images``
(image_ix, day) and ``ifgs`` (ifg_id, a, b, bperp). Every stage reads tables and writes tables, so a run can start and end
at any stage, a lost executor costs a stage at most, and a stage whose settings have not changed is kept.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fringelake.functions import kernels, phase
from fringelake.operators import blocks, graph, network, points, selection, series
from fringelake.plans.config import Report, Settings


@dataclass
class Dataset:
    """A folder of tables."""

    spark: SparkSession
    root: str

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}")

    def write(self, name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{self.root}/{name}")
        return self.read(name)

    def has(self, name: str) -> bool:
        try:
            self.read(name)
        except Exception as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return False
        return True

    def network(self) -> list[dict]:
        """The interferograms, a few thousand rows at most, in order."""
        return [r.asDict() for r in self.read("ifgs").orderBy("ifg_id").collect()]


def load(data: Dataset, s: Settings) -> str:
    valid = points.enough_phases(data.read("phase"), 0).select("ps_id")
    data.write("ps1", points.valid_coordinates(data.read("ps")).join(valid, "ps_id", "left_semi"))
    return "ps1"


def _grid(cells: DataFrame, turned: DataFrame) -> DataFrame:
    return points.grid_accumulate(cells, turned, "weight").select("gi", "gj", "ifg_id", "re", "im")


def _filtered(cells: DataFrame, turned: DataFrame, ph: DataFrame, s: Settings) -> DataFrame:
    """Each point's phase less the filtered phase of its cell, which the phases without the slopes found so far make up."""
    grid = _grid(cells, turned)
    smooth = blocks.filter_grid(grid, "adaptive", cutoff=s.low_pass, pixel=s.grid_size, size=s.filter_size * 3 // 4, pad=s.filter_size // 4)
    met = ph.join(cells.select("ps_id", "gi", "gj"), "ps_id").join(smooth, ["gi", "gj", "ifg_id"])
    return met.select("ps_id", "ifg_id", phase.wrap(F.col("phi") - F.atan2("im", "re")).alias("phi"))


def random_counts(data: Dataset, s: Settings) -> np.ndarray:
    """The coherence histogram of random phases, by hundredths."""
    rows = blocks.random_histogram(data.spark, [e["bperp"] for e in data.network()], s.wraps, s.random_rows).collect()  # 100 rows
    counts = np.zeros(100)
    for r in rows:
        counts[r["bin"]] = r["n"]
    return counts


def coherence(data: Dataset, s: Settings) -> str:
    """Rounds of: filter the weighted phases on the grid, fit slope and coherence of the rest, take the slope out, weigh points
    by the probability that their coherence is not by chance. The rounds end when the root mean square change of coherence
    changes by less than `settled`, after `iterations` at the latest."""
    ps, ph = data.read("ps1"), data.read("phase")
    ifgs = F.broadcast(data.read("ifgs").select("ifg_id", "bperp"))
    b, random = [e["bperp"] for e in data.network()], random_counts(data, s)
    low, last = 31, int(np.flatnonzero(random)[-1]) + 1 if random.any() else 0
    cells = graph.written(points.grid_cells(ps, s.grid_size))
    turned, weights, before, change = ph, cells.select("ps_id", (1 / F.col("d_a")).alias("weight")), None, 0.0
    for step in range(s.iterations):
        fitted = graph.written(blocks.estimate_coherence(_filtered(cells.join(weights, "ps_id"), turned, ph, s), b, s.wraps))
        if step + 1 == s.iterations:
            break
        if before is not None:
            moved = fitted.join(before.select("ps_id", F.col("coh").alias("was")), "ps_id").filter("NOT isnan(coh) AND NOT isnan(was)")
            now = moved.agg(F.sqrt(F.avg((F.col("coh") - F.col("was")) * (F.col("coh") - F.col("was"))))).first()[0] or 0.0
            if abs(now - change) < s.settled:
                break
            change = now
        before = fitted
        seen = np.zeros(100)
        for r in points.histogram(fitted.filter("coh <> 0 AND NOT isnan(coh)"), "coh", 0.005, 0.01, 100).collect():
            seen[r["bin"]] = r["n"]
        scaled = random * (seen[:low].sum() / random[:low].sum() if random[:low].sum() else 1.0)
        weights = blocks.square_weights(fitted, kernels.chance_curve(scaled, seen, low, last))
        met = ph.join(fitted.select("ps_id", "k"), "ps_id").join(ifgs, "ifg_id")
        turned = met.select("ps_id", "ifg_id", phase.wrap(F.col("phi") - F.col("k") * F.col("bperp")).alias("phi"))
    data.write("weights1", cells.join(weights, "ps_id").select("ps_id", "gi", "gj", "weight"))
    data.write("turned1", turned)
    data.write("pm1", fitted)
    return "pm1"


def select(data: Dataset, s: Settings) -> str:
    """Points above the coherence that keeps the share of random ones below the setting, by a line over dispersion."""
    pm = data.read("pm1").join(data.read("ps1").select("ps_id", "d_a"), "ps_id")
    chance = random_counts(data, s)
    edges = points.dispersion_edges(pm)
    if len(edges) == 2:
        pm = pm.withColumn("d_a", F.lit(1.0))
    index = sum(((F.col("d_a") > e).cast("int") for e in edges[1:]), F.lit(0))
    counted = pm.filter("coh <> 0 AND NOT isnan(coh)").withColumn("da_bin", index)
    counted = counted.withColumn("bin", F.greatest(F.lit(0), F.least(F.ceil(F.col("coh") * 100) - 1, F.lit(99))))
    counts = counted.groupBy("da_bin", "bin").agg(F.count("*").alias("n"), F.sum("d_a").alias("d")).collect()  # 100 rows a bin at most
    means, thresholds = [], []
    for k in range(len(edges) - 1):
        rows = [r for r in counts if r["da_bin"] == k]
        if rows:
            seen = np.zeros(100)
            for r in rows:
                seen[int(r["bin"])] += r["n"]
            means.append(sum(r["d"] for r in rows) / sum(r["n"] for r in rows))
            thresholds.append(kernels.threshold_from_random(seen, chance, s.percent_random))
    slope, intercept = kernels.threshold_line(np.array(means), np.array(thresholds))
    limit = pm.withColumn("limit", F.greatest(F.lit(0.0), slope * F.col("d_a") + intercept))
    kept = limit.filter("coh > limit").select("ps_id", "k", "c", "coh", "limit")
    b = [e["bperp"] for e in data.network()]
    if s.reject_deviation > 0 or s.reestimate:
        # The surroundings of each point, its own cell left out, filter its phases once more.
        rest = blocks.without_own_cell(data.read("phase").join(kept.select("ps_id"), "ps_id", "left_semi"), data.read("weights1"), _grid(data.read("weights1"), data.read("turned1")), s.filter_size, s.low_pass, s.grid_size)
        again = graph.written(blocks.estimate_coherence(graph.written(rest), b, s.wraps))
        if s.reject_deviation > 0:
            kept = blocks.steady(kept, residuals(rest, again, data.read("ifgs")), s.reject_deviation)
        if s.reestimate:
            kept = selection.consistent(kept, again, max(b) - min(b))
    data.write("select1", kept.select("ps_id", "coh"))
    return "select1"


def residuals(rest: DataFrame, fitted: DataFrame, ifgs: DataFrame) -> DataFrame:
    """ps_id, ifg_id, phi of the fitted points less slope and offset."""
    met = rest.join(fitted.select("ps_id", "k", "c"), "ps_id").join(F.broadcast(ifgs.select("ifg_id", "bperp")), "ifg_id")
    return met.select("ps_id", "ifg_id", phase.wrap(F.col("phi") - F.col("k") * F.col("bperp") - F.col("c")).alias("phi"))


def weed(data: Dataset, s: Settings) -> str:
    """One point of each adjacent group and place, and only quiet ones."""
    ps = data.read("ps1").join(data.read("select1"), "ps_id").filter("NOT hgt < 1e-6")
    kept = ps.join(points.adjacent_groups(ps.select("ps_id", "row", "col", "coh")).filter("keep").select("ps_id"), "ps_id", "left_semi")
    kept = kept.join(points.keep_best(kept.select("x", "y", "ps_id", "coh"), ["x", "y"]).select("ps_id"), "ps_id", "left_semi")
    data.write("kept1", kept)
    kept = data.read("kept1")
    arcs = blocks.delaunay_arcs(kept.select("patch_id", "ps_id", "x", "y")).withColumn("edge_id", F.xxhash64("a", "b"))
    ifgs, images = data.read("ifgs"), data.read("images")
    days = ifgs.join(images.select(F.col("image_ix").alias("a"), F.col("day").alias("da")), "a").select("ifg_id", F.col("da").cast("double").alias("day"))
    quiet = graph.node_minimum(blocks.arc_smoothing(graph.arc_differences(arcs, data.read("phase")), days, s.weed_window))
    data.write("weed1", selection.quiet(kept.join(quiet, kept.ps_id == quiet.node, "left"), s.weed_std, s.weed_max).drop("node", "std", "max"))
    return "weed1"


def promote(data: Dataset, s: Settings) -> str:
    """Patches as one: the point of highest coherence for each pixel; and the noise of each interferogram."""
    weeded = data.read("weed1")
    best = points.keep_best(weeded.select("row", "col", "ps_id", "coh"), ["row", "col"])
    ps = data.write("ps2", weeded.join(best.select("ps_id"), "ps_id", "left_semi"))
    ph = data.read("phase").join(ps.select("ps_id"), "ps_id", "left_semi")
    pm = data.read("pm1").select("ps_id", "k", "c")
    met = ph.join(pm, "ps_id").join(F.broadcast(data.read("ifgs").select("ifg_id", "bperp")), "ifg_id")
    rest = met.select("ifg_id", phase.wrap(F.col("phi") - F.col("k") * F.col("bperp") - F.col("c")).alias("phi"))
    data.write("ifg_noise", network.phase_noise(rest))
    return "ps2"


def unwrap(data: Dataset, s: Settings) -> str:
    """Grid, filter, unwrap, restore; drop noisy interferograms while the network holds; invert to epochs. What the first
    inversion leaves, the roughness of the unwrapped grids and the grid control's evidence decide which interferograms the
    second one does without."""
    ps = data.read("ps2")
    ph = data.read("phase").join(ps.select("ps_id"), "ps_id", "left_semi")
    cells = points.grid_cells(ps, s.grid_size)
    filtered = data.write("uw_filtered", blocks.filter_grid(points.grid_accumulate(cells, ph).select("gi", "gj", "ifg_id", "re", "im"), "goldstein", size=s.filter_size))
    uw = data.write("uw_grid", blocks.unwrap_grid(filtered.select("gi", "gj", "ifg_id", "re", "im")))
    restored = data.write("phuw_sb", blocks.restore_points(ph, cells, uw).withColumnRenamed("uw", "phi"))
    noise = data.read("ifg_noise")
    dated = noise.withColumnRenamed("std_deg", "x").join(data.read("ifgs").withColumn("dt", F.col("b") - F.col("a")), "ifg_id")
    audit = data.write("ifg_audit", network.evidence_table(graph.written(dated), "x", "dt"))
    edges = data.network()
    dropped = list(s.drop) or network.greedy_removal([r.asDict() for r in audit.collect()], s.qc_share)  # a row for each interferogram
    if s.drop:
        network.manual_removal(edges, dropped)
    reference = ps.filter(selection.in_reference(centre=(s.reference_lon, s.reference_lat) if s.reference_lon is not None else None, radius=s.reference_radius))
    centred = graph.written(series.reference_centred(restored, reference.select("ps_id")))
    data.write("phuw", _inverted(data, centred, dropped))
    if not s.drop:
        final = data.write("final_audit", _final_audit(data, ph, filtered, uw, centred, noise))
        more = final_removal(edges, dropped, [r.asDict() for r in final.orderBy(*network.final_order()).collect()], s.qc_share)  # a row for each
        if more:
            data.write("phuw", _inverted(data, centred, [*dropped, *more]))
    return "phuw"


def _inverted(data: Dataset, centred: DataFrame, dropped: list[int]) -> DataFrame:
    edges = data.network()
    left = [e for e in edges if e["ifg_id"] not in dropped]
    p = series.projector(series.design_matrix([(e["a"], e["b"]) for e in left], max(e["b"] for e in edges)))
    order = data.spark.createDataFrame([(e["ifg_id"], k + 1) for k, e in enumerate(left)], "ifg_id long, solve_ix long")
    return series.invert(centred.join(F.broadcast(order), "ifg_id").select("ps_id", F.col("solve_ix").alias("ifg_id"), "phi"), p)


def _final_audit(data: Dataset, ph: DataFrame, filtered: DataFrame, uw: DataFrame, centred: DataFrame, noise: DataFrame) -> DataFrame:
    """The last control's percentiles and flags, with the grid control's families."""
    ifgs = data.read("ifgs")
    closed = network.closure_by_edge(network.closure(ph, network.triangles(ifgs)))
    metrics = network.grid_residuals(filtered).join(noise.select("ifg_id", F.col("std_deg").alias("ifg_std")), "ifg_id")
    metrics = metrics.join(closed.select("ifg_id", F.col("rms").alias("closure_rms"), F.col("incoherence").alias("closure_incoherence")), "ifg_id", "left")
    families = graph.written(network.family_evidence(graph.written(metrics.coalesce(1))).coalesce(1))
    data.write("grid_audit", network.grid_candidates(families.join(ifgs.select("ifg_id", "a", "b"), "ifg_id")))
    misfit = graph.written(network.residual_metrics(series.misfit(centred, data.read("phuw"), ifgs)).coalesce(1))
    msd = points.grid_msd(points.grid_neighbours(uw.withColumnRenamed("uw", "v"), "v", ["ifg_id"]), ["ifg_id"])
    return network.final_flags(network.final_percentiles(misfit, msd, families))


def final_removal(edges: list[dict], dropped: list[int], audit: list[dict], share: float) -> list[int]:
    """The flagged interferograms, the worst first, as far as the cap that the first control left allows and the network holds."""
    place = {r["ifg_id"]: -k for k, r in enumerate(audit) if r["drop"]}
    left = [e | {"candidate": e["ifg_id"] in place, "score": place.get(e["ifg_id"], 0)} for e in edges if e["ifg_id"] not in dropped]
    most = max(1, int(share * len(edges))) - len(dropped)
    return network.greedy_removal(left, share)[:most] if most > 0 and place else []


def look_angle_error(data: Dataset, s: Settings) -> str:
    """Slope of the unwrapped phase over perpendicular baselines with the velocity fitted along, and what is left at nought, both
    held within the neighbours'."""
    ifgs = data.read("ifgs")
    days = data.read("images").select("image_ix", "day")
    day = lambda name: days.select(F.col("image_ix").alias(name), F.col("day").alias(f"d{name}"))
    spans = ifgs.join(day("a"), "a").join(day("b"), "b").select("ifg_id", "bperp", (F.col("db") - F.col("da")).alias("dt"))
    slope = graph.written(series.scla_with_time(data.read("phuw_sb"), spans))
    offset = series.scla(data.read("phuw_sb"), ifgs).select("ps_id", "c")
    arcs = graph.written(blocks.delaunay_arcs(data.read("ps2")))
    held = graph.clamp_to_neighbours(slope.select("ps_id", "k"), arcs, "k").join(graph.clamp_to_neighbours(graph.written(offset), arcs, "c"), "ps_id")
    data.write("scla", held)
    return "scla"


def _epoch_baselines(data: Dataset) -> DataFrame:
    edges = data.network()
    last = max(e["b"] for e in edges)
    g = series.design_matrix([(e["a"], e["b"]) for e in edges], last)
    b = np.linalg.lstsq(g, np.array([e["bperp"] for e in edges]), rcond=None)[0]
    return data.spark.createDataFrame([(k + 2, float(v)) for k, v in enumerate(b)], "image_ix long, b double")


def spatial_noise(data: Dataset, s: Settings) -> str:
    """What is left after slope and temporal smoothing, low-passed in space."""
    met = data.read("phuw").join(data.read("scla").select("ps_id", "k"), "ps_id").join(F.broadcast(_epoch_baselines(data)), "image_ix")
    ts = met.join(F.broadcast(data.read("images")), "image_ix").select("ps_id", "image_ix", "day", (F.col("phi") - F.col("k") * F.col("b")).alias("phi"))
    corrected = data.write("phcorr", ts)
    high = series.temporal_highpass(corrected, "ps_id", "day", "phi", s.scn_window).select("ps_id", F.col("image_ix").alias("ifg_id"), F.col("high").alias("phi"))
    low = points.gaussian_filter(data.read("ps2"), graph.written(high), s.scn_wavelength)
    data.write("scn", low.select("ps_id", F.col("ifg_id").alias("image_ix"), F.col("v").alias("scn")))
    return "scn"


def outputs(data: Dataset, s: Settings) -> str:
    """Series in millimetres and velocities in millimetres a year."""
    met = data.read("phcorr").join(data.read("scn"), ["ps_id", "image_ix"])
    ts = met.select("ps_id", "image_ix", "day", phase.phase_to_mm(F.col("phi") - F.col("scn"), s.wavelength).alias("los_mm"))
    ts = data.write("series", series.cumulative(ts, "ps_id", "day", "los_mm").withColumnRenamed("cum", "cumulative_mm"))
    found = series.velocity(ts, "ps_id", "day", "los_mm").join(series.endpoint_velocity(ts, "ps_id", "day", "los_mm"), "ps_id")
    data.write("velocity", found.join(data.read("ps2").select("ps_id", "lon", "lat", "coh"), "ps_id"))
    return "velocity"


STAGES: list[Callable[[Dataset, Settings], str]] = [load, coherence, select, weed, promote, unwrap, look_angle_error, spatial_noise, outputs]


#: What each stage reads and writes.
INPUTS = {
    "load": ("ps phase", "ps1"), "coherence": ("ps1 phase ifgs", "pm1 weights1 turned1"), "select": ("pm1 ps1 phase ifgs weights1 turned1", "select1"),
    "weed": ("ps1 select1 phase ifgs images", "kept1 weed1"), "promote": ("weed1 phase pm1 ifgs", "ps2 ifg_noise"),
    "unwrap": ("ps2 phase ifgs ifg_noise", "uw_filtered uw_grid phuw_sb ifg_audit final_audit grid_audit phuw"), "look_angle_error": ("phuw_sb ifgs images ps2", "scla"),
    "spatial_noise": ("phuw scla ifgs images ps2", "phcorr scn"), "outputs": ("phcorr scn ps2", "series velocity"),
}


def stage_inputs(spark: SparkSession) -> DataFrame:
    """stage, name, role (reads or writes), table of every stage."""
    rows = [(k + 1, f.__name__, role, t) for k, f in enumerate(STAGES) for role, tables in zip(("reads", "writes"), INPUTS[f.__name__]) for t in tables.split()]
    return spark.createDataFrame(rows, "stage int, name string, role string, table string")


def replay(spark: SparkSession, root: str, reference: str, stage: int) -> list[str]:
    """Takes what a stage writes from a reference folder instead of computing it; a table that is not there is an error."""
    data, other = Dataset(spark, root), Dataset(spark, reference)
    tables = INPUTS[STAGES[stage - 1].__name__][1].split()
    needed = [t for t in tables if t not in ("final_audit", "grid_audit")]  # not written where the list of drops is given
    missing = [t for t in needed if not other.has(t)]
    if missing:
        raise ValueError(f"{reference} lacks {missing}")
    taken = [t for t in tables if other.has(t)]
    for table in taken:
        data.write(table, other.read(table))
    return taken


def preflight(data: Dataset) -> None:
    """Shapes that the stages rely on; an error names what is wrong."""
    edges = data.network()
    if len(edges) < 4:
        raise ValueError("a network needs four interferograms at least")
    if not network.connected([(e["a"], e["b"]) for e in edges], {n for e in edges for n in (e["a"], e["b"])}):
        raise ValueError("the network is not connected")
    for name, columns in {"ps": "ps_id patch_id row col x y lon lat d_a hgt", "phase": "ps_id ifg_id phi", "images": "image_ix day"}.items():
        missing = set(columns.split()) - set(data.read(name).columns)
        if missing:
            raise ValueError(f"{name} lacks {sorted(missing)}")


def plan(start: int, end: int) -> list[tuple[int, str]]:
    return [(k, STAGES[k - 1].__name__) for k in range(start, end + 1)]


def run(spark: SparkSession, root: str, settings: Settings | None = None, start: int = 1, end: int = 9, keep: bool = True, dry: bool = False) -> Report:
    """Runs stages start to end. With `keep`, a stage that ran with these settings, after the last change before it, is kept."""
    s, data, report = settings or Settings(), Dataset(spark, root), Report()
    if not 1 <= start <= end <= len(STAGES):
        raise ValueError("stages are 1 to 9")
    if dry:
        for k, _ in plan(start, end):
            report.add(k, "planned")
        return report
    preflight(data)
    marks = data.read("_marks").collect() if data.has("_marks") else []  # nine rows at most
    done, fresh = {r["stage"]: (r["fingerprint"], r["main"]) for r in marks}, False
    for k in range(start, end + 1):
        if keep and not fresh and done.get(k, ("",))[0] == s.fingerprint() and data.has(done[k][1]):
            report.add(k, "kept")
            continue
        main = STAGES[k - 1](data, s)
        fresh = True
        done = {j: v for j, v in done.items() if j < k} | {k: (s.fingerprint(), main)}
        spark.createDataFrame([(j, *v) for j, v in sorted(done.items())], "stage int, fingerprint string, main string").coalesce(1).write.mode("overwrite").parquet(f"{root}/_marks")
        report.add(k, "done", data.read(main).count())
    return report


def audit_is_current(spark: SparkSession, root: str, settings: Settings) -> bool:
    """Whether the controls of stage 6 ran with these settings and their audits are there; a run with `keep` does it again if
    not."""
    data = Dataset(spark, root)
    marks = {r["stage"]: r["fingerprint"] for r in data.read("_marks").collect()} if data.has("_marks") else {}  # nine rows at most
    audits = ["ifg_audit"] if settings.drop else ["ifg_audit", "grid_audit", "final_audit"]
    return marks.get(6) == settings.fingerprint() and all(map(data.has, audits))


def status(spark: SparkSession, root: str) -> DataFrame:
    """The stages that a dataset has been through."""
    data = Dataset(spark, root)
    return data.read("_marks") if data.has("_marks") else spark.createDataFrame([], "stage int, fingerprint string, main string")
