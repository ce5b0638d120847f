"""The acquisition network: contexts, evidence and families of interferograms, triangles, connectivity, greedy removal.

Tables here have a row for each interferogram or acquisition, a few thousand at most, so windows without partitions and
driver-side graph walks are bounded; what they are computed from (phases) is reduced by partial aggregation before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fringelake.operators.graph import written
from fringelake.operators.points import grid_neighbours
from fringelake.operators.robust import MAD_SCALE, circular_mad, ecdf, median, mid_rank, percentile_rank, quantiles, robust_high_z

#: Evidence thresholds and weights of the first selection.
Z_STRONG, Z_CONTEXT, RANK_STRONG = 4.0, 3.5, 0.99
WEIGHTS = (0.45, 0.25, 0.20, 0.10)
#: Weights of the families of grid metrics; a family is bad or extreme from these values on.
FAMILIES = {"closure": 0.30, "residual": 0.30, "gradient": 0.20, "validity": 0.10, "noise": 0.10}
FAMILY_BAD, FAMILY_EXTREME, FAMILY_TOP = 0.90, 4.5, 8.0


def phase_noise(phase: DataFrame, phi: str = "phi") -> DataFrame:
    """ifg_id, std_deg: root mean square phase in degrees; a map-side combined sum."""
    return phase.groupBy("ifg_id").agg(F.degrees(F.sqrt(F.avg(F.col(phi) * F.col(phi)))).alias("std_deg"))


def temporal_context(ifgs: DataFrame, x: str, dt: str, out: str, bins: int = 8, least: int = 8, least_all: int = 16) -> DataFrame:
    """Robust z of x among interferograms of like temporal baseline: bins between unique quantiles, the last one closed; 0 in
    bins of fewer than `least` rows, or with fewer than `least_all` rows in all."""
    edges = ifgs.agg(F.array_sort(F.array_distinct(F.percentile(dt, F.array(*(F.lit(k / bins) for k in range(bins + 1)))))).alias("edges"), F.count("*").alias("n_all"))
    inner = F.expr(f"size(filter(slice(edges, 2, greatest(size(edges) - 2, 0)), e -> e <= {dt}))")
    binned = ifgs.crossJoin(F.broadcast(edges)).withColumn("bin", inner).drop("edges")
    sized = binned.withColumn("n_bin", F.count("*").over(Window.partitionBy("bin")))
    told = robust_high_z(sized, x, out, ["bin"])
    return told.withColumn(out, F.when((F.col("n_bin") >= least) & (F.col("n_all") >= least_all), F.col(out)).otherwise(0.0)).drop("n_bin", "n_all")


def peers(ifgs: DataFrame) -> DataFrame:
    """(ifg_id, peer): interferograms that share an acquisition; one equi-join over the acquisitions."""
    ends = ifgs.select("ifg_id", F.explode(F.array("a", "b")).alias("image"))
    return ends.join(ends.withColumnRenamed("ifg_id", "peer"), "image").filter("ifg_id <> peer").select("ifg_id", "peer").distinct()


def endpoint_context(ifgs: DataFrame, x: str, out: str, least: int = 6) -> DataFrame:
    """Robust z of x against the peers' values; 0 with fewer than `least` peers; where their deviation is nought, their
    population deviation counts, or else 1e-6."""
    values = peers(ifgs).join(ifgs.select(F.col("ifg_id").alias("peer"), F.col(x).alias("theirs")), "peer")
    middle = values.groupBy("ifg_id").agg(median("theirs").alias("med"), F.count("*").alias("n_peers"), F.stddev_pop("theirs").alias("std"))
    spread = values.join(middle, "ifg_id").groupBy("ifg_id").agg((MAD_SCALE * median(F.abs(F.col("theirs") - F.col("med")))).alias("mad"))
    told = ifgs.join(middle, "ifg_id", "left").join(spread, "ifg_id", "left")
    scale = F.when(F.col("mad") > 1e-12, F.col("mad")).when(F.col("std") > 1e-12, F.col("std")).otherwise(1e-6)
    z = F.greatest(F.lit(0.0), (F.col(x) - F.col("med")) / scale)
    return told.withColumn(out, F.when(F.col("n_peers") >= least, z).otherwise(0.0)).drop("med", "mad", "std", "n_peers")


def evidence_table(ifgs: DataFrame, x: str, dt: str) -> DataFrame:
    """ifgs with z, rank, context_z, endpoint_z and the evidence of them; each is computed from ifgs and joined by id."""
    z = percentile_rank(robust_high_z(ifgs, x, "z"), x, "ifg_id", "rank")
    context = temporal_context(ifgs, x, dt, "context_z").select("ifg_id", "context_z")
    endpoint = endpoint_context(ifgs, x, "endpoint_z").select("ifg_id", "endpoint_z")
    return evidence(z.join(context, "ifg_id").join(endpoint, "ifg_id"))


def evidence(df: DataFrame, z: str = "z", context: str = "context_z", endpoint: str = "endpoint_z", rank: str = "rank") -> DataFrame:
    """n_evidence, candidate and score of each interferogram."""
    flags = [F.col(z) >= Z_STRONG, F.col(context) >= Z_CONTEXT, F.col(endpoint) >= Z_CONTEXT, F.col(rank) >= RANK_STRONG]
    n = sum((f.cast("int") for f in flags[1:]), flags[0].cast("int"))
    capped = [F.least(F.col(c), F.lit(8.0)) / 8 for c in (z, context, endpoint)]
    score = sum((w * v for w, v in zip(WEIGHTS[1:], [*capped[1:], F.col(rank)])), WEIGHTS[0] * capped[0])
    return df.withColumn("n_evidence", n).withColumn("candidate", (n >= 2) & (F.col(z) >= 3)).withColumn("score", score)


def family_score(df: DataFrame, weights: dict[str, float] = FAMILIES) -> DataFrame:
    """n_bad, n_extreme and score from the columns z_<family> and pct_<family>."""
    bad = sum(((F.col(f"pct_{f}") >= FAMILY_BAD).cast("int") for f in weights), F.lit(0))
    extreme = sum(((F.col(f"z_{f}") >= FAMILY_EXTREME).cast("int") for f in weights), F.lit(0))
    score = sum((w * F.least(F.col(f"z_{f}"), F.lit(FAMILY_TOP)) for f, w in weights.items()), F.lit(0.0)) / sum(weights.values())
    return df.withColumn("n_bad", bad).withColumn("n_extreme", extreme).withColumn("score", score)


def node_context(edges: DataFrame, score: str, candidate: str) -> DataFrame:
    """For each edge: the excess of its score over the mean of its nodes' median scores, and whether a node is clustered
    (three edges or more, half of them candidates)."""
    ends = edges.select("a", "b", score, F.col(candidate).cast("double").alias("c"), F.explode(F.array("a", "b")).alias("node"))
    nodes = ends.groupBy("node").agg(F.count("*").alias("degree"), median(score).alias("middle"), F.avg("c").alias("share"))
    nodes = nodes.withColumn("clustered", (F.col("degree") >= 3) & (F.col("share") >= 0.5))
    left, right = (nodes.select(F.col("node").alias(e), *(F.col(c).alias(f"{c}_{e}") for c in ("degree", "middle", "clustered"))) for e in "ab")
    told = edges.join(left, "a").join(right, "b")
    return told.withColumn("excess", F.col(score) - (F.col("middle_a") + F.col("middle_b")) / 2).withColumn("clustered", F.col("clustered_a") | F.col("clustered_b"))


def triangles(ifgs: DataFrame) -> DataFrame:
    """(ab, bc, ac): interferograms that close a loop, each loop once; two equi-joins."""
    ab = ifgs.select(F.col("ifg_id").alias("ab"), F.col("a"), F.col("b"))
    bc = ifgs.select(F.col("ifg_id").alias("bc"), F.col("a").alias("b"), F.col("b").alias("c"))
    ac = ifgs.select(F.col("ifg_id").alias("ac"), F.col("a"), F.col("b").alias("c"))
    return ab.join(bc, "b").join(ac, ["a", "c"]).select("ab", "bc", "ac")


def closure(phase: DataFrame, loops: DataFrame, least: int = 8) -> DataFrame:
    """For each loop: n, RMS closure angle and incoherence 1 - |mean phasor|. Phases meet once, as one array a point; loops (a few
    per interferogram) are summed over blocks of points, and the sums are as few as the loops."""
    import numpy as np
    import pandas as pd

    sides = np.array([(r["ab"], r["bc"], r["ac"]) for r in loops.collect()], int).reshape(-1, 3)  # a few rows per interferogram
    ids = [r["ifg_id"] for r in phase.select("ifg_id").distinct().orderBy("ifg_id").collect()]  # a row for each interferogram
    at = {k: n for n, k in enumerate(ids)}
    sides = sides[[all(k in at for k in loop) for loop in sides.tolist()]] if len(sides) else sides
    ab, bc, ac = (np.array([at[k] for k in sides[:, n].tolist()], int) for n in range(3))

    def sums(batches):
        total = np.zeros((4, len(sides)))
        for pdf in batches:
            for start in range(0, len(pdf), 1000):
                phi = np.vstack(pdf["phi"].iloc[start : start + 1000]).astype(float)
                e = phi[:, ab] + phi[:, bc] - phi[:, ac]
                there = np.isfinite(e)
                e = np.where(there, e, 0.0)
                c, s = np.cos(e), np.sin(e)
                wrapped = np.arctan2(s, c)
                total += [there.sum(axis=0), (wrapped * wrapped * there).sum(axis=0), (c * there).sum(axis=0), (s * there).sum(axis=0)]
        yield pd.DataFrame({"ab": sides[:, 0], "bc": sides[:, 1], "ac": sides[:, 2], "n": total[0], "ee": total[1], "c": total[2], "s": total[3]})

    rows = phase.groupBy("ps_id").agg(F.map_from_entries(F.collect_list(F.struct("ifg_id", "phi"))).alias("m"))
    arrays = rows.select(F.array(*(F.coalesce(F.try_element_at("m", F.lit(k).cast(phase.schema["ifg_id"].dataType)), F.lit(float("nan"))) for k in ids)).alias("phi"))
    parts = arrays.mapInPandas(sums, "ab long, bc long, ac long, n double, ee double, c double, s double")
    told = parts.groupBy("ab", "bc", "ac").agg(*(F.sum(c).alias(c) for c in ("n", "ee", "c", "s"))).filter(F.col("n") >= least)
    rms, size = F.sqrt(F.col("ee") / F.col("n")), F.hypot(F.col("c") / F.col("n"), F.col("s") / F.col("n"))
    return told.select("ab", "bc", "ac", F.col("n").cast("long").alias("n"), rms.alias("rms"), (1 - size).alias("incoherence"))


def closure_by_edge(closed: DataFrame) -> DataFrame:
    """Median closure of the loops that an interferogram is in."""
    sides = closed.select(F.explode(F.array("ab", "bc", "ac")).alias("ifg_id"), "rms", "incoherence")
    return sides.groupBy("ifg_id").agg(median("rms").alias("rms"), median("incoherence").alias("incoherence"), F.count("*").alias("n_loops"))


def residual_metrics(residual: DataFrame, least: int = 100, x: str = "r") -> DataFrame:
    """ifg_id, rms, mad, p95, jump share of residuals less their median."""
    middle = quantiles(residual, x, {"med": 0.5}, ["ifg_id"])
    told = residual.join(F.broadcast(middle), "ifg_id").select("ifg_id", (F.col(x) - F.col("med")).alias("d")).withColumn("size", F.abs("d"))
    spread = quantiles(told, "size", {"mad": 0.5, "p95": 0.95}, ["ifg_id"])
    sums = told.groupBy("ifg_id").agg(F.sqrt(F.avg(F.col("d") * F.col("d"))).alias("rms"), F.avg((F.col("size") > F.pi()).cast("double")).alias("jumps"), F.count("*").alias("n"))
    return sums.join(spread, "ifg_id").filter(F.col("n") >= least).select("ifg_id", "rms", (MAD_SCALE * F.col("mad")).alias("mad"), "p95", "jumps", "n")


def connected_to(edges: DataFrame, start: int) -> DataFrame:
    """Nodes that edges connect with `start`: a frontier that grows by one join a round, on a table of acquisition pairs."""
    spark = edges.sparkSession
    links = edges.select(F.col("a").alias("p"), F.col("b").alias("q")).union(edges.select("b", "a")).distinct().collect()
    near: dict[int, list[int]] = {}
    for row in links:  # a row for each end of each interferogram
        near.setdefault(row["p"], []).append(row["q"])
    seen, front = {start}, [start]
    while front:
        front = [q for p in front for q in near.get(p, ()) if not (q in seen or seen.add(q))]
    return spark.createDataFrame([(n,) for n in sorted(seen)], "node long")


def kept_index(ifgs: DataFrame, dropped: list[int]) -> DataFrame:
    """solve_ix, ifg_id: the interferograms that are not dropped, numbered again in order."""
    spark = ifgs.sparkSession
    listed = spark.createDataFrame([(d,) for d in dropped], "ifg_id long")
    left = ifgs.join(F.broadcast(listed), "ifg_id", "left_anti")
    return left.select(F.row_number().over(Window.orderBy("ifg_id")).cast("long").alias("solve_ix"), "ifg_id")


def connected(edges, nodes) -> bool:
    """Whether (a, b) pairs connect all of nodes. Driver-side: the network is small."""
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in edges:
        if a in parent and b in parent:
            parent[root(a)] = root(b)
    return len({root(n) for n in nodes}) <= 1


def greedy_removal(ifgs: list[dict], share: float = 0.05, fail_on_cap: bool = False) -> list[int]:
    """Ids to drop: candidates in order of falling score, at most `share` of all (one at least), each only if the rest still
    connects every acquisition."""
    nodes = {n for e in ifgs for n in (e["a"], e["b"])}
    wanted = sorted((e for e in ifgs if e["candidate"]), key=lambda e: (-e["score"], e["ifg_id"]))
    most = max(1, int(share * len(ifgs)))
    if fail_on_cap and len(wanted) > most:
        raise ValueError(f"{len(wanted)} candidates for removal; the cap is {most}")
    dropped: list[int] = []
    for e in wanted:
        if len(dropped) >= most:
            break
        rest = [(k["a"], k["b"]) for k in ifgs if k["ifg_id"] not in dropped and k["ifg_id"] != e["ifg_id"]]
        if {n for pair in rest for n in pair} == nodes and connected(rest, nodes):
            dropped.append(e["ifg_id"])
    return dropped


def manual_removal(ifgs: list[dict], requested: list[int], preserve: bool = True) -> list[int]:
    """The requested ids; an error if one is unknown or, with `preserve`, if the network falls apart."""
    unknown = set(requested) - {e["ifg_id"] for e in ifgs}
    if unknown:
        raise ValueError(f"no such interferograms: {sorted(unknown)}")
    nodes = {n for e in ifgs for n in (e["a"], e["b"])}
    rest = [(e["a"], e["b"]) for e in ifgs if e["ifg_id"] not in requested]
    if preserve and not connected(rest, nodes):
        raise ValueError("the network would fall apart")
    return sorted(set(requested))


def final_flags(df: DataFrame) -> DataFrame:
    """Rules of the last control from percentiles of network and MSD metrics and the grid control's verdicts: an extreme network
    anomaly alone, a strong one with a grid family or a strong MSD, an extreme MSD with strong grid evidence."""
    extreme, strong = F.col("network_pct") >= 0.99, F.col("network_pct") >= 0.975
    msd_extreme, msd_strong = F.col("msd_pct") >= 0.99, F.col("msd_pct") >= 0.975
    rules = {
        "network_extreme": extreme, "network_strong+grid": strong & F.col("grid_family"), "network_strong+unwrap": strong & msd_strong,
        "unwrap_extreme+grid_strong": msd_extreme & F.col("grid_strong"),
    }
    reasons = F.concat_ws(",", *(F.when(rule, F.lit(name)) for name, rule in rules.items()))
    return df.withColumn("reasons", reasons).withColumn("drop", F.col("reasons") != "")


def final_percentiles(metrics: DataFrame, msd: DataFrame, families: DataFrame) -> DataFrame:
    """ifg_id, network_z (the middle of the z of rms, mad and jumps), network_pct, msd, msd_pct, grid_family, grid_strong: what the
    last control judges by. Each table has a row for each interferogram."""
    rest = metrics
    for c in ("rms", "mad", "jumps"):
        rest = robust_high_z(rest, c, f"z_{c}", kind="network")
    told = rest.select("ifg_id", middle_z(["z_rms", "z_mad", "z_jumps"]).alias("network_z"))
    grid = families.select("ifg_id", (F.col("n_bad") >= 1).alias("grid_family"), (F.col("n_bad") >= 2).alias("grid_strong"))
    joined = written(told.join(msd.select("ifg_id", F.round("msd", 9).alias("msd")), "ifg_id").join(grid, "ifg_id").withColumn("key", F.round("network_z", 9)).coalesce(1))
    return ecdf(ecdf(joined, "key", "network_pct"), "msd", "msd_pct").drop("key")


def final_order() -> list[Column]:
    """Candidates of the last control, the worst first."""
    return [F.desc(F.col("network_pct") >= 0.99), F.desc("network_pct"), F.desc(F.col("msd_pct") >= 0.99), F.desc("msd_pct"), F.desc("grid_strong"), F.col("ifg_id")]


def middle_z(columns: list[str]) -> Column:
    """The middle of three z columns."""
    return F.get(F.array_sort(F.array(*columns)), len(columns) // 2)


#: The metrics of each family of the grid control (fixed values).
MEMBERS = {
    "closure": ("closure_rms", "closure_incoherence"),
    "residual": ("residual_rms", "residual_mad", "residual_incoherence", "extreme_fraction"),
    "gradient": ("gradient_mad",),
    "validity": ("invalid_fraction",),
    "noise": ("ifg_std",),
}


def grid_residuals(grid: DataFrame, least: int = 8) -> DataFrame:
    """ifg_id and the metrics of what the low-pass (lre, lim) leaves of a filtered grid (re, im): RMS, circular MAD,
    incoherence, the share more than a quarter turn from the middle, the share of invalid cells, and the circular MAD of
    differences to the cells below and to the right. Fewer than `least` valid cells or differences tell nothing."""
    there = (F.hypot("re", "im") > 0) & (F.hypot("lre", "lim") > 0)
    turned = F.atan2(F.col("im") * F.col("lre") - F.col("re") * F.col("lim"), F.col("re") * F.col("lre") + F.col("im") * F.col("lim"))
    rest = grid.select("ifg_id", "gi", "gj", F.when(F.coalesce(there, F.lit(False)), turned).alias("r"))
    re, im = F.avg(F.cos("r")), F.avg(F.sin("r"))
    mean = rest.groupBy("ifg_id").agg(
        (1 - F.count("r") / F.count("*")).alias("invalid_fraction"), F.count("r").alias("n"), F.sqrt(F.avg(F.col("r") * F.col("r"))).alias("residual_rms"),
        (1 - F.hypot(re, im)).alias("residual_incoherence"), F.atan2(im, re).alias("centre"),
    )
    apart = F.abs(F.atan2(F.sin(F.col("r") - F.col("centre")), F.cos(F.col("r") - F.col("centre"))))
    spread = rest.join(F.broadcast(mean.select("ifg_id", "centre")), "ifg_id").groupBy("ifg_id").agg(
        (MAD_SCALE * median(apart)).alias("residual_mad"), F.avg((apart > F.pi() / 2).cast("int")).alias("extreme_fraction")
    )
    steps = grid_neighbours(rest.filter("r IS NOT NULL"), "r", ["ifg_id"]).select("ifg_id", F.atan2(F.sin("d"), F.cos("d")).alias("d"))
    gradient = circular_mad(steps, ["ifg_id"], "d").join(steps.groupBy("ifg_id").count(), "ifg_id").filter(F.col("count") >= least)
    told = mean.join(spread, "ifg_id").join(gradient.select("ifg_id", F.col("mad").alias("gradient_mad")), "ifg_id", "left")
    enough = ["residual_rms", "residual_mad", "residual_incoherence", "extreme_fraction"]
    return told.select("ifg_id", *(F.when(F.col("n") >= least, F.col(c)).alias(c) for c in enough), "invalid_fraction", "gradient_mad")


def family_evidence(metrics: DataFrame) -> DataFrame:
    """ifg_id, n_bad, n_extreme, score from a column for each metric in MEMBERS: a family is as bad as the worst of its
    members, so that related metrics have one vote."""
    names = [m for members in MEMBERS.values() for m in members]
    family = F.create_map(*(F.lit(v) for f, members in MEMBERS.items() for m in members for v in (m, f)))
    weight = F.create_map(*(F.lit(v) for f, w in FAMILIES.items() for v in (f, w)))
    long = metrics.unpivot("ifg_id", names, "metric", "x")
    told = mid_rank(robust_high_z(long, "x", "z", ["metric"], kind="grid"), "x", "pct", ["metric"])
    worst = told.groupBy("ifg_id", family[F.col("metric")].alias("family")).agg(F.max("z").alias("z"), F.max("pct").alias("pct"))
    return worst.groupBy("ifg_id").agg(
        F.sum((F.col("pct") >= FAMILY_BAD).cast("int")).alias("n_bad"), F.sum((F.col("z") >= FAMILY_EXTREME).cast("int")).alias("n_extreme"),
        (F.sum(weight[F.col("family")] * F.least(F.col("z"), F.lit(FAMILY_TOP))) / sum(FAMILIES.values())).alias("score"),
    )


def grid_candidates(scored: DataFrame, tail: float = 0.02, z: float = 2.5, families: int = 2, excess: float = 2.5, clustered: float = 3.5, degree: int = 3, sparse_z: float = 4.0) -> DataFrame:
    """scored (ifg_id, a, b, n_bad, n_extreme, score) with score_z, score_pct, base, excess_z and candidate.

    A base candidate is in the tail of scores, far above their median and bad in several families, or extreme in two. It stays
    one if its score stands out above its acquisitions' own level too (further where many of an acquisition's interferograms are
    candidates), or, where an acquisition has too few for a level, if it is far out and extreme in two families."""
    told = mid_rank(robust_high_z(scored, "score", "score_z", kind="grid"), "score", "score_pct")
    usual = (F.col("score_pct") >= 1 - tail) & (F.col("score_z") >= z) & (F.col("n_bad") >= families)
    based = written(told.withColumn("base", usual | (F.col("n_extreme") >= 2)))
    around = robust_high_z(node_context(based, "score", "base"), "excess", "excess_z", kind="grid")
    stands = F.col("excess_z") >= F.when(F.col("clustered"), clustered).otherwise(excess)
    sparse = (F.least("degree_a", "degree_b") < degree) & (F.col("score_z") >= sparse_z) & (F.col("n_extreme") >= 2)
    return around.withColumn("candidate", F.col("base") & (stands | sparse))
