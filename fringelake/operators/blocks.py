"""Arrow-vectorised operators around the dense kernels.

Points are handled in the batches that Spark deals out. Grids are one group for each interferogram (and patch), whose size
the acquisition fixes, not the number of points. Trees and networks are computed once from tables that are small by nature.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fringelake.functions import arcs, kernels
from fringelake.operators.graph import written
from fringelake.operators.robust import quantiles


def stacked(phase: DataFrame, n: int) -> DataFrame:
    """ps_id, phi: one array for each point, in the order of interferograms; partial lists combine before the shuffle."""
    rows = phase.groupBy("ps_id").agg(F.array_sort(F.collect_list(F.struct("ifg_id", "phi"))).alias("s"))
    return rows.filter(F.size("s") == n).select("ps_id", F.col("s.phi").alias("phi"))


def estimate_coherence(phase: DataFrame, bperp: list[float], wraps: float) -> DataFrame:
    """ps_id, k, c, coh by the refined fit."""
    b = np.array(bperp, float)

    def fit(batches):
        for pdf in batches:
            if len(pdf):
                for start in range(0, len(pdf), 500):  # trials of 500 points at once
                    some = pdf.iloc[start : start + 500]
                    k, c, coh, _ = kernels.topofit(np.exp(1j * np.vstack(some["phi"])), b, wraps)
                    yield pd.DataFrame({"ps_id": some["ps_id"], "k": k, "c": c, "coh": coh})

    return stacked(phase, len(b)).mapInPandas(fit, "ps_id long, k double, c double, coh double")


def square_weights(fitted: DataFrame, curve: np.ndarray) -> DataFrame:
    """ps_id, weight by the curve of ``kernels.chance_curve``."""

    def one(batches):
        for pdf in batches:
            yield pd.DataFrame({"ps_id": pdf["ps_id"], "weight": kernels.square_weights(pdf["coh"].to_numpy(float), curve)})

    return fitted.select("ps_id", "coh").mapInPandas(one, "ps_id long, weight double")


def steady(points: DataFrame, residual: DataFrame, most: float, draws: int = 100) -> DataFrame:
    """The points whose coherence deviates by less than `most` over resamples of their residual phases."""
    rows = residual.groupBy("ps_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("ifg_id", "phi"))), lambda x: x["phi"]).alias("phi"))

    def test(batches):
        for pdf in batches:
            for n, same in pdf.groupby(pdf["phi"].map(len)):
                deviation = kernels.bootstrap_deviation(np.vstack(same["phi"]), same["ps_id"].to_numpy(), draws)
                yield pd.DataFrame({"ps_id": same["ps_id"][deviation < most]})

    return points.join(rows.mapInPandas(test, "ps_id long"), "ps_id", "left_semi")


def filter_grid(grid: DataFrame, method: str = "goldstein", cutoff: float = 800.0, pixel: float = 100.0, **settings) -> DataFrame:
    """gi, gj, ifg_id, re, im of each interferogram's grid, filtered, and with the spectral filter its low-pass, lre and lim
    (elsewhere nought); a group is one grid. The adaptive filter's low-pass lets
    through wavelengths above `cutoff`, in the units of `pixel`, the size of a cell."""
    if method == "adaptive":
        settings = {"size": 24, "pad": 8} | settings
        settings.setdefault("low_pass", kernels.butterworth(settings["size"] + settings["pad"], cutoff, pixel))

    def one(pdf):
        i, j = pdf["gi"].to_numpy() - 1, pdf["gj"].to_numpy() - 1
        dense = np.zeros((i.max() + 1, j.max() + 1), complex)
        dense[i, j] = pdf["re"].to_numpy() + 1j * pdf["im"].to_numpy()
        out, low = kernels.goldstein(dense, **settings) if method == "goldstein" else (kernels.adaptive_filter(dense, **settings), np.zeros_like(dense))
        columns = {"re": out[i, j].real, "im": out[i, j].imag, "lre": low[i, j].real, "lim": low[i, j].imag}
        return pd.DataFrame({"gi": i + 1, "gj": j + 1, "ifg_id": pdf["ifg_id"], **columns})

    return grid.groupBy("ifg_id").applyInPandas(one, "gi long, gj long, ifg_id long, re double, im double, lre double, lim double")


def without_own_cell(phase: DataFrame, cells: DataFrame, grid: DataFrame, size: int, cutoff: float, pixel: float) -> DataFrame:
    """ps_id, ifg_id, phi: each point's phase less what the adaptive filter makes of the grid around it without its own cell.
    A group is one interferogram's grid, with the occupied cells of the points asked for; each cell is filtered once and its
    points take it from there."""
    wanted = phase.join(cells.select("ps_id", "gi", "gj"), "ps_id").select("ps_id", "ifg_id", "gi", "gj", "phi")
    places = wanted.select("ifg_id", "gi", "gj").distinct()
    low = kernels.butterworth(size, cutoff, pixel)

    def one(here, all_):
        if not len(all_):
            return pd.DataFrame({"ifg_id": [], "gi": [], "gj": [], "angle": []})
        i, j = all_["gi"].to_numpy() - 1, all_["gj"].to_numpy() - 1
        dense = np.zeros((i.max() + 1, j.max() + 1), complex)
        dense[i, j] = all_["re"].to_numpy() + 1j * all_["im"].to_numpy()
        angle = [np.angle(kernels.own_cell_filter(dense, r - 1, c - 1, size, low_pass=low)) for r, c in zip(here["gi"], here["gj"])]
        return pd.DataFrame({"ifg_id": here["ifg_id"], "gi": here["gi"], "gj": here["gj"], "angle": angle})

    made = places.groupBy("ifg_id").cogroup(grid.groupBy("ifg_id")).applyInPandas(one, "ifg_id long, gi long, gj long, angle double")
    d = F.col("phi") - F.col("angle")
    return wanted.join(made, ["ifg_id", "gi", "gj"]).select("ps_id", "ifg_id", F.atan2(F.sin(d), F.cos(d)).alias("phi"))


def unwrap_grid(grid: DataFrame) -> DataFrame:
    """gi, gj, ifg_id, uw: phases integrated along a spanning tree of neighbouring occupied cells, the same for all
    interferograms that occupy the same cells."""

    def one(pdf):
        pdf = pdf.sort_values(["gi", "gj"], ignore_index=True)
        order, parent = _tree(pdf["gi"].to_numpy(np.int64).tobytes(), pdf["gj"].to_numpy(np.int64).tobytes())
        uw = kernels.unwrap(np.arctan2(pdf["im"], pdf["re"]).to_numpy(), order, parent)
        return pd.DataFrame({"gi": pdf["gi"], "gj": pdf["gj"], "ifg_id": pdf["ifg_id"], "uw": uw})

    return grid.groupBy("ifg_id").applyInPandas(one, "gi long, gj long, ifg_id long, uw double")


@lru_cache(maxsize=2)
def _tree(rows: bytes, cols: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The tree over neighbouring cells, kept by a worker for the interferograms that occupy the same ones."""
    gi, gj = np.frombuffer(rows, np.int64), np.frombuffer(cols, np.int64)
    at = {cell: k for k, cell in enumerate(zip(gi.tolist(), gj.tolist()))}
    links = [(k, at[n]) for (i, j), k in at.items() for n in ((i + 1, j), (i, j + 1)) if n in at]
    return kernels.spanning_order(len(gi), np.array(links, int).reshape(-1, 2))


def restore_points(phase: DataFrame, cells: DataFrame, unwrapped: DataFrame) -> DataFrame:
    """ps_id, ifg_id, uw: a point's unwrapped phase is its cell's plus the wrapped rest."""
    met = phase.join(cells.select("ps_id", "gi", "gj"), "ps_id").join(unwrapped, ["gi", "gj", "ifg_id"])
    rest = F.col("phi") - F.col("uw")
    return met.select("ps_id", "ifg_id", (F.col("uw") + F.atan2(F.sin(rest), F.cos(rest))).alias("uw"))


def _planes(rows: DataFrame, weight) -> dict[int, np.ndarray]:
    """The weighted plane of each interferogram from sums that combine on the map side; a row for each is collected."""
    one = F.lit(1.0)
    design = {"x": F.col("x"), "y": F.col("y"), "o": one}
    pairs = [("x", "x"), ("x", "y"), ("x", "o"), ("y", "y"), ("y", "o"), ("o", "o")]
    sums = [F.sum(weight * design[a] * design[b]).alias(a + b) for a, b in pairs] + [F.sum(weight * design[a] * F.col("v")).alias(a + "v") for a in design]
    out = {}
    for r in rows.filter(weight > 0).groupBy("ifg_id").agg(F.count("*").alias("n"), *sums).collect():
        if r["n"] >= kernels.PLANE_POINTS:
            m = np.array([[r["xx"], r["xy"], r["xo"]], [r["xy"], r["yy"], r["yo"]], [r["xo"], r["yo"], r["oo"]]])
            out[r["ifg_id"]] = np.linalg.lstsq(m, np.array([r["xv"], r["yv"], r["ov"]]), rcond=None)[0]
    return out


def robust_deramp(values: DataFrame, value: str = "phi", delta: float = 1.345, rounds: int = 5) -> DataFrame:
    """ps_id, ifg_id, flat: each interferogram less its robust plane by the rules of ``kernels.huber_plane``; null where it has
    none. Planes are fitted from sums and scales from exact medians, so no task holds an interferogram; what goes round is a
    row for each of them."""
    spark, number = values.sparkSession, lambda c: F.when(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.col(c).cast("double"))
    rows = values.select("ps_id", "ifg_id", (number("x") / 1000).alias("x"), (number("y") / 1000).alias("y"), number(value).alias("v"), (number("coh") * number("coh")).alias("w"))
    rows = written(rows)
    whole = rows.filter("x IS NOT NULL AND y IS NOT NULL AND v IS NOT NULL AND w > 0")
    planes = _planes(whole, F.col("w"))
    open_ = set(planes)

    def rest_of(some: DataFrame, ids) -> DataFrame:
        table = spark.createDataFrame([(int(k), *map(float, planes[k])) for k in ids], "ifg_id long, a double, b double, c double")
        return some.join(F.broadcast(table), "ifg_id").withColumn("r", F.col("v") - F.col("a") * F.col("x") - F.col("b") * F.col("y") - F.col("c"))

    for _ in range(rounds):
        if not open_:
            break
        rest = rest_of(whole, sorted(open_))
        middle = quantiles(rest, "r", {"m": 0.5}, ["ifg_id"])
        apart = rest.join(F.broadcast(middle), "ifg_id").select("ifg_id", F.abs(F.col("r") - F.col("m")).alias("d"))
        scales = {r["ifg_id"]: 1.4826 * r["mad"] for r in quantiles(apart, "d", {"mad": 0.5}, ["ifg_id"]).collect()}  # a row for each
        open_ = {k for k in open_ if scales.get(k, 0.0) > 1e-8}
        if not open_:
            break
        table = spark.createDataFrame([(int(k), float(scales[k])) for k in sorted(open_)], "ifg_id long, s double")
        weighted = rest.join(F.broadcast(table), "ifg_id")
        after = _planes(weighted, F.col("w") / F.greatest(F.abs("r") / (delta * F.col("s")), F.lit(1.0)))
        open_ = {k for k in open_ if k in after}
        moved = {k: float(np.abs(after[k] - planes[k]).max()) for k in open_}
        planes |= {k: after[k] for k in open_}
        open_ = {k for k in open_ if moved[k] >= 1e-8}
    if not planes:
        return rows.select("ps_id", "ifg_id", F.lit(None).cast("double").alias("flat"))
    table = spark.createDataFrame([(int(k), *map(float, p)) for k, p in planes.items()], "ifg_id long, a double, b double, c double")
    met = rows.join(F.broadcast(table), "ifg_id", "left")
    return met.select("ps_id", "ifg_id", (F.col("v") - F.col("a") * F.col("x") - F.col("b") * F.col("y") - F.col("c")).alias("flat"))


def delaunay_arcs(points: DataFrame) -> DataFrame:
    """patch_id, a, b: Delaunay edges of each patch's points; a patch has a bounded number of points by construction."""

    def one(pdf):
        pdf = pdf.sort_values("ps_id", ignore_index=True)
        edges = kernels.delaunay(pdf[["x", "y"]].to_numpy(float))
        ids = pdf["ps_id"].to_numpy()
        return pd.DataFrame({"patch_id": pdf["patch_id"].iloc[0], "a": ids[edges[:, 0]], "b": ids[edges[:, 1]]})

    return points.select("patch_id", "ps_id", "x", "y").groupBy("patch_id").applyInPandas(one, "patch_id long, a long, b long")


def difference_whitener(noise: DataFrame, arcs_: DataFrame, ids: list[int]) -> np.ndarray:
    """The whitener of noise (ps_id, ifg_id, phi) differenced over arcs (a, b): sums of products by block of arcs, one matrix of
    the network's size a task; only arcs whose ends have every interferogram count."""
    points_ = stacked(noise, len(ids))
    met = arcs_.select("a", "b").join(points_.select(F.col("ps_id").alias("a"), F.col("phi").alias("pa")), "a").join(points_.select(F.col("ps_id").alias("b"), F.col("phi").alias("pb")), "b")

    def sums(batches):
        count, total, products = 0, np.zeros(len(ids)), np.zeros((len(ids), len(ids)))
        for pdf in batches:
            if len(pdf):
                d = np.vstack(pdf["pb"]) - np.vstack(pdf["pa"])
                count, total, products = count + len(d), total + d.sum(axis=0), products + d.T @ d
        yield pd.DataFrame({"n": [count], "total": [total.tobytes()], "products": [products.tobytes()]})

    parts = met.select("pa", "pb").mapInPandas(sums, "n long, total binary, products binary")
    whole = parts.repartition(8).mapInPandas(lambda batches: _added(batches, len(ids)), "n long, total binary, products binary").collect()  # eight rows
    count, total, products = 0, np.zeros(len(ids)), np.zeros((len(ids), len(ids)))
    for r in whole:
        count, total, products = count + r["n"], total + np.frombuffer(r["total"]), products + np.frombuffer(r["products"]).reshape(len(ids), -1)
    return arcs.whitener(count, total, products)


def _added(batches, n: int):
    count, total, products = 0, np.zeros(n), np.zeros(n * n)
    for pdf in batches:
        for some, t, p in zip(pdf["n"], pdf["total"], pdf["products"]):
            count, total, products = count + int(some), total + np.frombuffer(t), products + np.frombuffer(p)
    yield pd.DataFrame({"n": [count], "total": [total.tobytes()], "products": [products.tobytes()]})


def arc_space_time(differences: DataFrame, pairs: list[tuple[int, int]], days: list[float], bperp: list[float], window: float, method: str = "3D", wraps: float = 0.0, w: np.ndarray | None = None, runs: int = 15) -> DataFrame:
    """edge_id, ifg_id, k, noise, uw of arcs that every interferogram has: look-angle slopes (none with `wraps` of nought), smoothing
    in time and unwrapping along it. pairs: image indices from 0 in the order of interferograms. Arcs are handled in the
    batches that Spark deals out; an arc's result depends on its id and phases alone."""
    p, d, b = np.array(pairs, int), np.array(days, float), np.array(bperp, float)
    if method not in arcs.METHODS:
        raise ValueError(f"methods are {', '.join(arcs.METHODS)}")
    rows = stacked(differences.select(F.col("edge_id").alias("ps_id"), "ifg_id", F.col("dphi").alias("phi")), len(p))

    def fit(batches):
        for pdf in batches:
            for start in range(0, len(pdf), 500):
                some = pdf.iloc[start : start + 500]
                z, keys = np.exp(1j * np.vstack(some["phi"])), some["ps_id"].to_numpy()
                k = arcs.slopes(z, p, d, b, wraps) if wraps > 0 else np.zeros(len(z))
                noise, uw = arcs.space_time(z, keys, p, d, b, window, method, k, w, runs)
                yield pd.DataFrame({"edge_id": np.repeat(keys, len(p)), "ifg_id": np.tile(np.arange(1, len(p) + 1), len(keys)), "k": np.repeat(k, len(p)), "noise": noise.ravel(), "uw": uw.ravel()})

    return rows.mapInPandas(fit, "edge_id long, ifg_id long, k double, noise double, uw double")


def arc_smoothing(differences: DataFrame, days: DataFrame, window: float) -> DataFrame:
    """edge_id, a, b, std, max: noise of each arc's series against a local line in time."""
    rows = differences.join(F.broadcast(days), "ifg_id").groupBy("edge_id", "a", "b").agg(F.array_sort(F.collect_list(F.struct("day", "dphi"))).alias("s"))

    def fit(batches):
        for pdf in batches:
            out = [kernels.smoothed_arc(np.array([r["dphi"] for r in s]), np.array([r["day"] for r in s]), window)[:2] for s in pdf["s"]]
            yield pd.DataFrame({"edge_id": pdf["edge_id"], "a": pdf["a"], "b": pdf["b"], "std": [o[0] for o in out], "max": [o[1] for o in out]})

    return rows.mapInPandas(fit, "edge_id long, a long, b long, std double, max double")


def random_histogram(spark, bperp: list[float], wraps: float, rows: int = 300_000, parts: int = 64, seed: int = 2005, pairs=None) -> DataFrame:
    """bin, n of the coherence of random phases; each part has a seed of its own, so the result does not depend on the
    number of executors."""
    b, differences = np.array(bperp, float), None if pairs is None else np.array(pairs, int)

    def draw(batches):
        for pdf in batches:
            for part in pdf["id"]:
                size = rows // parts + (part < rows % parts)
                counts = kernels.random_coherence(int(size), b, wraps, seed=seed + int(part), differences=differences)
                yield pd.DataFrame({"bin": np.arange(len(counts)), "n": counts.astype(np.int64)})

    return spark.range(0, parts, 1, min(parts, 64)).mapInPandas(draw, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n"))
