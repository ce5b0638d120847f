"""Scatterer candidates: screening, balanced selection, patches, merging, neighbours and rasters.

All of it is equi-joins, partial aggregations and windows whose partitions are cells or pixels, bounded by the data's
density, never by its size. Range conditions become equi-joins over grid cells.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fringelake.functions.geometry import distance
from fringelake.operators.graph import weak_components, written


def amplitude_scales(amp: DataFrame, least: float = 0.0) -> DataFrame:
    """Mean of the positive amplitudes of each image."""
    return amp.groupBy("image").agg(F.avg(F.when(F.col("amp") > least, F.col("amp"))).alias("scale"))


def amplitude_dispersion(amp: DataFrame, threshold: float, valid: float, n_images: int) -> DataFrame:
    """pixel, n, mean, d_a of pixels seen in enough images whose calibrated amplitude varies little enough. One shuffle of
    partial sums; the scales, one per image, are broadcast."""
    scaled = amp.join(F.broadcast(amplitude_scales(amp)), "image").filter("amp > 0").withColumn("v", F.col("amp") / F.col("scale"))
    sums = scaled.groupBy("pixel").agg(F.count("*").alias("n"), F.sum("v").alias("s"), F.sum(F.col("v") * F.col("v")).alias("q"))
    mean = F.col("s") / F.col("n")
    variance = F.greatest(F.lit(0.0), (F.col("q") - F.col("s") * F.col("s") / F.col("n")) / (F.col("n") - 1))
    least = max(2, -(-int(valid * n_images * 1_000_000) // 1_000_000))
    return sums.filter(F.col("n") >= least).select("pixel", "n", mean.alias("mean"), (F.sqrt(variance) / mean).alias("d_a")).filter(F.col("d_a") <= threshold)


def pairwise_dispersion(amp: DataFrame, ifgs: DataFrame, threshold: float) -> DataFrame:
    """pixel, n_pairs, d_a over interferogram pairs: root mean square difference over mean amplitude; below the threshold.
    The network is broadcast; amplitudes meet by (pixel, image)."""
    scaled = amp.join(F.broadcast(amplitude_scales(amp, 0.001)), "image").select("pixel", "image", F.coalesce(F.col("amp") / F.col("scale"), F.lit(0.0)).alias("v"))
    first = scaled.join(F.broadcast(ifgs.select("ifg_id", "a", "b")), F.col("image") == F.col("a")).select("pixel", F.col("b").alias("image"), F.col("v").alias("m"))
    met = first.join(scaled.withColumnRenamed("v", "s"), ["pixel", "image"])
    apart = F.col("m") - F.col("s")
    found = met.groupBy("pixel").agg(F.count("*").alias("n_pairs"), F.avg(apart * apart).alias("q"), F.avg((F.col("m") + F.col("s")) / 2).alias("mean"))
    return found.select("pixel", "n_pairs", (F.sqrt("q") / F.col("mean")).alias("d_a")).filter(F.col("d_a") < threshold)


def single_look_candidates(amp: DataFrame, ifgs: DataFrame, width: int, range_looks: int, azimuth_looks: int, threshold: float) -> DataFrame:
    """cell_row, cell_col, row, col, d_a: the pairwise dispersion of each single-look pixel (numbered along lines of `width`), the
    least one of each multilook cell, and of those the ones below the threshold."""
    told = pairwise_dispersion(amp, ifgs, math.inf).select(F.floor(F.col("pixel") / width).alias("row"), (F.col("pixel") % width).alias("col"), "d_a")
    return best_look(told, range_looks, azimuth_looks).filter(F.col("d_a") < threshold)


def best_look(pixels: DataFrame, range_looks: int, azimuth_looks: int) -> DataFrame:
    """The single-look pixel of least dispersion in each multilook cell, the first by (row, col) on ties."""
    cell = [F.floor(F.col("row") / azimuth_looks).alias("cell_row"), F.floor(F.col("col") / range_looks).alias("cell_col")]
    best = F.min(F.struct("d_a", "row", "col")).alias("best")
    return pixels.groupBy(*cell).agg(best).select("cell_row", "cell_col", "best.row", "best.col", "best.d_a")


def valid_coordinates(points: DataFrame) -> DataFrame:
    lon, lat = F.col("lon"), F.col("lat")
    none = (F.abs(lon) < 1e-6) & (F.abs(lat) < 1e-6)
    return points.filter(lon.between(-180, 180) & lat.between(-90, 90) & ~none & ~F.isnan("hgt"))


def enough_phases(phase: DataFrame, most_invalid: int) -> DataFrame:
    """ps_id, valid share of points with at most `most_invalid` null or NaN phases."""
    bad = F.count_if(F.col("phi").isNull() | F.isnan("phi"))
    told = phase.groupBy("ps_id").agg(bad.alias("invalid"), F.count("*").alias("n"))
    return told.filter(F.col("invalid") <= most_invalid).select("ps_id", (1 - F.col("invalid") / F.col("n")).alias("valid"))


def cell_rank(points: DataFrame, rows: int, cols: int) -> DataFrame:
    """points with the rank of each in its cell, by dispersion, row, col."""
    cell = [F.floor(F.col("row") / rows), F.floor(F.col("col") / cols)]
    return points.withColumn("rank", F.row_number().over(Window.partitionBy(*cell).orderBy("d_a", "row", "col")))


def cell_balanced(points: DataFrame, rows: int = 32, cols: int = 32, most: int = 32) -> DataFrame:
    return cell_rank(points, rows, cols).filter(F.col("rank") <= most)


def fair_cap(points: DataFrame, rows: int, cols: int, most: int) -> DataFrame:
    """The first `most` points by rank in the cell, then dispersion: every cell gets its turn. Ranks are counted first; all
    points of the ranks before the one in which the cap falls stay, and only that rank's points are ordered, by range."""
    from fringelake.operators.selection import placed

    ranked = written(cell_rank(points, rows, cols))
    counts = sorted((r["rank"], r["count"]) for r in ranked.groupBy("rank").count().collect())  # a row for each place in a cell
    total = 0
    for rank, n in counts:
        if total + n > most:
            edge = placed(ranked.filter(F.col("rank") == rank).withColumn("__order", F.struct("d_a", "row", "col")), "__order")
            return ranked.filter(F.col("rank") < rank).unionByName(edge.filter(F.col("place") < most - total).drop("__order", "place"))
        total += n
    return ranked


def anchors(points: DataFrame, cell_m: float, per_cell: int) -> DataFrame:
    cell = [F.floor(F.col("x") / cell_m), F.floor(F.col("y") / cell_m)]
    place = F.row_number().over(Window.partitionBy(*cell).orderBy(F.desc("coh"), "ps_id"))
    return points.withColumn("place", place).filter(F.col("place") <= per_cell)


def patch_bounds(spark, rows: int, cols: int, n_rows: int, n_cols: int, overlap: int) -> DataFrame:
    """Half-open core and window of each patch of a grid of patches."""
    cut = lambda n, parts: [n * k // parts for k in range(parts + 1)]
    out = []
    for i, (r0, r1) in enumerate(zip(cut(rows, n_rows), cut(rows, n_rows)[1:])):
        for j, (c0, c1) in enumerate(zip(cut(cols, n_cols), cut(cols, n_cols)[1:])):
            out.append((i * n_cols + j + 1, r0, r1, c0, c1, max(0, r0 - overlap), min(rows, r1 + overlap), max(0, c0 - overlap), min(cols, c1 + overlap)))
    return spark.createDataFrame(out, "patch long, core_r0 long, core_r1 long, core_c0 long, core_c1 long, r0 long, r1 long, c0 long, c1 long")


def assign_patches(points: DataFrame, bounds: DataFrame) -> DataFrame:
    """Each point in each patch whose window holds it. The bounds have a row for each patch and are broadcast."""
    r, c = F.col("row"), F.col("col")
    inside = (r >= F.col("r0")) & (r < F.col("r1")) & (c >= F.col("c0")) & (c < F.col("c1"))
    core = (r >= F.col("core_r0")) & (r < F.col("core_r1")) & (c >= F.col("core_c0")) & (c < F.col("core_c1"))
    return points.join(F.broadcast(bounds), inside).withColumn("in_core", core)


def merge_patches(assigned: DataFrame) -> DataFrame:
    """One row of each pixel: the one in its patch's core (the last patch of several), else the first patch's."""
    order = F.when(F.col("in_core"), -F.col("patch")).otherwise(F.col("patch"))
    place = F.row_number().over(Window.partitionBy("row", "col").orderBy(F.desc("in_core"), order))
    return assigned.withColumn("place", place).filter("place = 1").drop("place")


def keep_best(points: DataFrame, keys: list[str], quality: str = "coh", key: str = "ps_id") -> DataFrame:
    """The row of highest quality of each set of keys, the first on ties; partial aggregation instead of a sort."""
    best = points.groupBy(*keys).agg(F.min(F.struct((-F.col(quality)).alias("q"), F.col(key).alias("k"))).alias("best"))
    return best.select(*keys, F.col("best.k").alias(key), (-F.col("best.q")).alias(quality))


def adjacent_groups(points: DataFrame) -> DataFrame:
    """ps_id, group, keep: every point leads to the lowest of its eight neighbours, if that is lower; points that lead to
    the same place are a group, of which the highest coherence stays. Following the lead is pointer doubling: each round
    squares the distance covered."""
    near = points.select("ps_id", F.explode(F.array(*(F.struct((F.col("row") + i).alias("row"), (F.col("col") + j).alias("col")) for i in (-1, 0, 1) for j in (-1, 0, 1) if i or j))).alias("at"))
    met = near.join(points.select(F.col("row"), F.col("col"), F.col("ps_id").alias("other")), (F.col("at.row") == F.col("row")) & (F.col("at.col") == F.col("col")))
    lead = met.groupBy("ps_id").agg(F.min("other").alias("to"))
    grouped = points.join(weak_components(lead.select(F.col("ps_id").alias("a"), F.col("to").alias("b"))), points.ps_id == F.col("node"), "left")
    told = grouped.withColumn("group", F.coalesce("component", "ps_id"))
    best = told.groupBy("group").agg(F.min(F.struct((-F.col("coh")).alias("q"), F.col("ps_id").alias("k"))).alias("best"))
    return told.join(best, "group").select("ps_id", "group", (F.col("ps_id") == F.col("best.k")).alias("keep"))


def radius_mask(points: DataFrame, lon: float, lat: float, radius: float) -> Column:
    return distance(F.col("lon"), F.col("lat"), lon, lat) <= radius


def near_pairs(left: DataFrame, right: DataFrame, radius: float) -> DataFrame:
    """(ps_id, other, d): pairs nearer than radius. Right rows enter the nine cells around them; the join is on cells, so a
    row meets the density of its surroundings and never the whole table."""
    cell = lambda c: F.floor(F.col(c) / radius)
    entered = right.select(F.col("ps_id").alias("other"), F.col("x").alias("ox"), F.col("y").alias("oy"), F.explode(F.array(*(F.struct((cell("x") + i).alias("cx"), (cell("y") + j).alias("cy")) for i in (-1, 0, 1) for j in (-1, 0, 1)))).alias("c")).select("other", "ox", "oy", "c.*")
    met = left.select("ps_id", "x", "y", cell("x").alias("cx"), cell("y").alias("cy")).join(entered, ["cx", "cy"])
    return met.select("ps_id", "other", F.hypot(F.col("x") - F.col("ox"), F.col("y") - F.col("oy")).alias("d")).filter(F.col("d") < radius)


def gaussian_filter(points: DataFrame, values: DataFrame, wavelength: float) -> DataFrame:
    """ps_id, ifg_id, v: mean of values around each point, weights exp(-d^2 / 2 wavelength^2) within four wavelengths."""
    weights = near_pairs(points, points, 4 * wavelength).withColumn("w", F.exp(-F.col("d") * F.col("d") / (2 * wavelength * wavelength)))
    met = weights.join(values.withColumnRenamed("ps_id", "other"), "other")
    return met.groupBy("ps_id", "ifg_id").agg((F.sum(F.col("w") * F.col("phi")) / F.sum("w")).alias("v"))


def _placed(df: DataFrame) -> Column:
    finite = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(math.inf))
    return finite("x") & finite("y")


def nearest(queries: DataFrame, nodes: DataFrame, size: float) -> DataFrame:
    """ps_id, other, d: the nearest node of each query, the smallest id on ties. Rings of cells grow, doubling, for the queries
    that have no answer yet; an answer holds once its distance is within the ring, and a ring as wide as the extent of all
    answers the rest. Queries and nodes without a finite place have no part; no nodes, no rows."""
    left, nodes = queries.filter(_placed(queries)), nodes.filter(_placed(nodes))
    ends = lambda df: df.agg(F.min("x"), F.max("x"), F.min("y"), F.max("y")).first()
    found = near_pairs(left.limit(0), nodes, size).select("ps_id", "other", "d")
    boxes = [box for box in (ends(left), ends(nodes)) if box[0] is not None]
    if len(boxes) < 2:
        return found
    span = math.hypot(max(b[1] for b in boxes) - min(b[0] for b in boxes), max(b[3] for b in boxes) - min(b[2] for b in boxes))
    reach = size
    while True:
        met = near_pairs(left, nodes, reach)
        best = met.groupBy("ps_id").agg(F.min(F.struct("d", "other")).alias("best")).select("ps_id", F.col("best.other").alias("other"), F.col("best.d").alias("d"))
        best = written(best)
        found = found.unionAll(best)
        left = left.join(best, "ps_id", "left_anti")
        if reach > span or left.isEmpty():
            return found
        reach *= 2


def label_raster(occupied: DataFrame) -> DataFrame:
    """gi, gj, z: for each cell of the grid the number of the nearest occupied one (gi, gj), the smallest on ties; occupied cells
    are numbered from 1 by column, then row."""
    from fringelake.operators.selection import placed

    nodes = written(placed(occupied.select("gi", "gj").distinct().withColumn("order", F.struct("gj", "gi")), "order"))
    nodes = nodes.select((F.col("place") + 1).cast("long").alias("ps_id"), F.col("gj").cast("double").alias("x"), F.col("gi").cast("double").alias("y"))
    ends = nodes.agg(F.max("y").cast("long").alias("rows"), F.max("x").cast("long").alias("cols")).filter("rows IS NOT NULL")
    lines = ends.select("cols", F.explode(F.sequence(F.lit(1).cast("long"), "rows")).alias("gi"))
    cells = lines.select("gi", F.explode(F.sequence(F.lit(1).cast("long"), "cols")).alias("gj"))
    at = cells.select(F.struct("gi", "gj").alias("ps_id"), F.col("gj").cast("double").alias("x"), F.col("gi").cast("double").alias("y"))
    return nearest(at, nodes, 2.0).select("ps_id.gi", "ps_id.gj", F.col("other").alias("z"))


def label_edges(labels: DataFrame) -> DataFrame:
    """gi, gj, z, colix, rowix: the signed number of the edge between a cell's label and the one to its right (colix) and below
    (rowix): 0 where they are the same, null past the border, negative where the larger label comes first. Edges are the
    distinct pairs of labels, numbered from 1 in order."""
    from fringelake.operators.selection import placed

    here = written(labels.select("gi", "gj", "z"))
    right = here.select("gi", (F.col("gj") - 1).alias("gj"), F.col("z").alias("zr"))
    below = here.select((F.col("gi") - 1).alias("gi"), "gj", F.col("z").alias("zb"))
    met = here.join(right, ["gi", "gj"], "left").join(below, ["gi", "gj"], "left")
    pair = lambda c: F.struct(F.least("z", c).alias("lo"), F.greatest("z", c).alias("hi"))
    ends = met.select(F.explode(F.array(pair("zr"), pair("zb"))).alias("e"), "zr", "zb").filter("e.lo <> e.hi").select("e").distinct()
    numbers = placed(ends, "e").select("e", (F.col("place") + 1).cast("long").alias("n"))
    out = met
    for c, name in (("zr", "colix"), ("zb", "rowix")):
        number = numbers.select(F.col("e").alias("pair"), F.col("n").alias(name))
        signed = F.when(F.col(c).isNull(), None).when(F.col(c) == F.col("z"), 0).otherwise(F.signum(F.col(c) - F.col("z")).cast("long") * F.col(name))
        out = out.withColumn("pair", pair(c)).join(number, "pair", "left").withColumn(name, signed).drop("pair")
    return out.select("gi", "gj", "z", "colix", "rowix")


def filled(values: DataFrame, x: str, size: float) -> DataFrame:
    """ps_id and x, with the nearest known value where a point has none; null if no point has any."""
    known = F.col(x).isNotNull() & ~F.isnan(x)
    there = values.filter(known)
    near = nearest(values.filter(~known).select("ps_id", "x", "y"), there.select("ps_id", "x", "y"), size)
    taken = near.join(there.select(F.col("ps_id").alias("other"), F.col(x).alias("taken")), "other").select("ps_id", "taken")
    return values.join(taken, "ps_id", "left").select("ps_id", F.when(known, F.col(x)).otherwise(F.col("taken")).alias(x))


def grid_index(v: Column, low: Column, size: float, tolerance: float) -> Column:
    return F.greatest(F.lit(1), F.ceil((v - low + tolerance) / size))


def grid_cells(points: DataFrame, size: float, tolerance: float = 1e-6) -> DataFrame:
    """points with gi, gj, from 1; the last cell is folded into the one before it. The extent is one broadcast row."""
    low = points.agg(F.min("x").alias("x0"), F.min("y").alias("y0"), F.max("x").alias("x1"), F.max("y").alias("y1"))
    told = points.crossJoin(F.broadcast(low))
    index = lambda v, lo, hi: F.least(grid_index(F.col(v), F.col(lo), size, tolerance), F.greatest(F.lit(1), grid_index(F.col(hi), F.col(lo), size, tolerance) - 1)).cast("long")
    return told.withColumn("gi", index("y", "y0", "y1")).withColumn("gj", index("x", "x0", "x1")).drop("x0", "y0", "x1", "y1")


def grid_accumulate(cells: DataFrame, phase: DataFrame, weight: str | None = None) -> DataFrame:
    """gi, gj, ifg_id, re, im, n: complex sums by cell, of phasors or of `weight` (a column of cells) times them; map-side combined."""
    met = phase.join(cells.select("ps_id", "gi", "gj", *([weight] if weight else [])), "ps_id")
    w = F.col(weight) if weight else F.lit(1.0)
    return met.groupBy("gi", "gj", "ifg_id").agg(F.sum(w * F.cos("phi")).alias("re"), F.sum(w * F.sin("phi")).alias("im"), F.count("*").alias("n"))


def dispersion_edges(points: DataFrame, x: str = "d_a") -> list[float | None]:
    """Upper ends of the bins of dispersion, the first lower end (0) before them: every 2,000th sorted value (10,000th from
    50,000 points on) that leaves a whole bin after it, then the largest; (0, 1] in one with less than 10,000 points. Points
    without a value come last in the order. Equal values are counted before they move, and the values are dealt by range and
    placed from the counts of the parts before, so no task sees all; what is collected is a row for each part and a value for
    every 2,000 points or more."""
    counted = points.groupBy(F.col(x).cast("double").alias("v")).agg(F.count("*").alias("c"))
    part = written(counted.repartitionByRange(F.asc_nulls_last("v")).withColumn("part", F.spark_partition_id()))
    n, begins = 0, []
    for k, c in sorted((r["part"], r["c"]) for r in part.groupBy("part").agg(F.sum("c").alias("c")).collect()):
        begins.append((k, n))
        n += c
    if n < 10_000:
        return [0.0, 1.0]
    step = 10_000 if n >= 50_000 else 2000
    begin = F.broadcast(part.sparkSession.createDataFrame(begins, "part int, begin long"))
    end = F.col("begin") + F.sum("c").over(Window.partitionBy("part").orderBy(F.asc_nulls_last("v")))
    first, last = F.greatest(F.lit(1), F.ceil((F.col("end") - F.col("c")) / step)), F.least(F.lit((n - 1) // step - 1), F.floor((F.col("end") - 1) / step))
    held = part.join(begin, "part").withColumn("end", end).withColumn("first", first).withColumn("last", last).filter("first <= last")
    found = held.select("v", F.explode(F.sequence("first", "last")).alias("k")).orderBy("k").collect()
    return [0.0, *(r["v"] for r in found), part.agg(F.max("v").alias("v")).first()["v"]]


def grid_neighbours(grid: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """keys, gi, gj, d: differences to the cells below and to the right, where both are occupied."""
    here = grid.select(*keys, "gi", "gj", F.col(value).alias("v"))
    there = here.select(*keys, F.explode(F.array(F.struct((F.col("gi") - 1).alias("gi"), F.col("gj").alias("gj")), F.struct(F.col("gi").alias("gi"), (F.col("gj") - 1).alias("gj")))).alias("c"), F.col("v").alias("w"))
    return here.join(there.select(*keys, "c.gi", "c.gj", "w"), [*keys, "gi", "gj"]).select(*keys, "gi", "gj", (F.col("w") - F.col("v")).alias("d"))


def grid_msd(differences: DataFrame, keys: list[str]) -> DataFrame:
    told = differences.filter("d <> 0")
    return told.groupBy(*keys).agg(F.avg(F.col("d") * F.col("d")).alias("msd"), F.count("*").alias("n"))


def raster_mean(points: DataFrame, x: Column, y: Column, size: float, value: str) -> DataFrame:
    return points.groupBy(F.floor(y / size).alias("row"), F.floor(x / size).alias("col")).agg(F.avg(value).alias("mean"), F.count("*").alias("n"))


def bilinear(points: DataFrame, raster: DataFrame, least: float = 0.25) -> DataFrame:
    """pt, v: the four raster cells around (r, c), weighted; missing ones are left out; with no more than `least` of the
    weight left, the nearest cell counts. An equi-join on the cell."""
    r0, c0 = F.floor("r"), F.floor("c")
    fr, fc = F.col("r") - r0, F.col("c") - c0
    corners = F.array(*(F.struct((r0 + i).alias("row"), (c0 + j).alias("col"), ((fr if i else 1 - fr) * (fc if j else 1 - fc)).alias("w")) for i in (0, 1) for j in (0, 1)))
    near = points.select("pt", F.explode(corners).alias("k")).select("pt", "k.*").filter("w > 0")
    met = near.join(raster, ["row", "col"]).filter("value IS NOT NULL AND NOT isnan(value)")
    told = met.groupBy("pt").agg(F.sum("w").alias("w"), (F.sum(F.col("w") * F.col("value")) / F.sum("w")).alias("v"), F.max(F.struct("w", "row", "col", "value")).alias("near"))
    return told.select("pt", F.when(F.col("w") > least, F.col("v")).otherwise(F.col("near.value")).alias("v"))


def incidence(places: DataFrame, elevation: DataFrame) -> DataFrame:
    """pt, incidence, cosine from a raster of look-vector elevations (row, col, value, radians): bilinear between its cells. A
    place outside the raster, or a direction that does not come down, is an error."""
    sampled = bilinear(places, elevation)
    told = sampled.select("pt", (F.pi() / 2 - F.col("v")).alias("incidence"), F.sin("v").alias("cosine"))
    outside, flat = places.join(sampled, "pt", "left_anti").count(), told.filter("NOT cosine > 0").count()
    if outside or flat:
        raise ValueError(f"{outside} places outside the raster, {flat} directions that do not come down")
    return told


def even_sample(df: DataFrame, key: str, n: int) -> DataFrame:
    """Rows at n evenly spaced places of the order by key, the first and the last included."""
    from fringelake.operators.selection import at_places

    total = df.count()
    return at_places(df, key, sorted({round(k * (total - 1) / max(1, n - 1)) for k in range(min(n, total))}))


def histogram(values: DataFrame, x: str, first: float, step: float, n: int) -> DataFrame:
    """bin (from 0), n: nearest of n equally spaced centres, midpoints going down, ends open; empty bins are there too."""
    low = first + step / 2
    index = F.greatest(F.lit(0), F.least(F.lit(n - 1), F.ceil((F.col(x) - low) / step))).cast("long")
    counted = values.groupBy(index.alias("bin")).agg(F.count("*").alias("n"))
    bins = values.sparkSession.range(n).withColumnRenamed("id", "bin")
    return bins.join(F.broadcast(counted), "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))
