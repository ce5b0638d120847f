"""Parameter files, scene and pair lists: text that Spark reads and checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _lines(spark, path: str) -> DataFrame:
    text = F.trim(F.regexp_replace("value", "[#].*$", ""))
    return spark.read.text(path).select(text.alias("line"), F.monotonically_increasing_id().alias("at")).filter("line <> ''")


def parameters(spark, path: str) -> DataFrame:
    """name, text, number (the first numeric token) of 'name: value' lines."""
    rows = spark.read.text(path).filter(F.col("value").contains(":"))
    name, text = F.trim(F.substring_index("value", ":", 1)), F.trim(F.expr("substring(value, locate(':', value) + 1)"))
    found = F.regexp_extract(text, r"([-+]?\d+\.?\d*(?:[eE][-+]?\d+)?)", 1)
    return rows.select(name.alias("name"), text.alias("text"), F.when(found != "", found.cast("double")).alias("number"))


def scene_list(spark, path: str) -> DataFrame:
    """image_ix (from 1), first, second, date of a two-column list of scenes; at least two scenes, dates unique."""
    return scenes(_lines(spark, path))


def scenes(lines: DataFrame) -> DataFrame:
    """As ``scene_list``, of rows (line, at). Scene and pair lists are as small as the network, so one task orders them."""
    rows = lines.withColumn("part", F.split("line", r"\s+"))
    told = rows.select(
        F.row_number().over(Window.orderBy("at")).cast("long").alias("image_ix"), F.get("part", F.lit(0)).alias("first"),
        F.get("part", F.lit(1)).alias("second"), F.to_date(F.regexp_extract("line", r"(\d{8})", 1), "yyyyMMdd").alias("date"),
    )
    n, dates, narrow = told.agg(F.count("*"), F.countDistinct("date"), F.count_if(F.col("second").isNull())).first()
    if n < 2 or dates != n or narrow:
        raise ValueError(f"{n} scenes, {dates} dates, {narrow} lines of less than two columns")
    return told


def pair_list(spark, path: str, n_images: int) -> DataFrame:
    """ifg_id, a, b of a list of scene pairs; indices within range, no pair twice or of a scene with itself."""
    return pairs(_lines(spark, path), n_images)


def pairs(lines: DataFrame, n_images: int) -> DataFrame:
    """As ``pair_list``, of rows (line, at)."""
    rows = lines.withColumn("part", F.split("line", r"\s+"))
    told = rows.select(F.row_number().over(Window.orderBy("at")).cast("long").alias("ifg_id"), F.get("part", F.lit(0)).try_cast("long").alias("a"), F.get("part", F.lit(1)).try_cast("long").alias("b"))
    bad = told.filter(f"a IS NULL OR b IS NULL OR a < 1 OR b < 1 OR a > {n_images} OR b > {n_images} OR a = b").count()
    ends = told.select(F.least("a", "b"), F.greatest("a", "b"))
    if bad or ends.count() != ends.distinct().count():
        raise ValueError(f"{bad} pairs out of range, or a pair twice")
    return told


def edges(lines: DataFrame, n_nodes: int) -> DataFrame:
    """edge_id, a, b (from 0) of the lines of an edge file: a head with the number of edges, then 'number a b mark', counted
    from 1. The number of edges must be the head's, and the nodes in range."""
    first = lines.agg(F.min("at").alias("first"))
    cut = lines.crossJoin(F.broadcast(first)).select((F.col("at") == F.col("first")).alias("head"), F.split(F.trim("line"), r"\s+").alias("part"))
    told = cut.filter("NOT head").select(*((F.get("part", F.lit(k)).try_cast("long") - 1).alias(c) for k, c in enumerate(("edge_id", "a", "b"))))
    n = cut.filter("head").select(F.get("part", F.lit(0)).try_cast("long")).first()
    found, bad = told.agg(F.count("*"), F.count_if(~F.col("a").between(0, n_nodes - 1) | ~F.col("b").between(0, n_nodes - 1) | F.col("a").isNull() | F.col("b").isNull())).first()
    if n is None or found != n[0] or bad:
        raise ValueError(f"{found} edges where the head says {n and n[0]}, {bad} out of range")
    return told


def dated_files(dates: DataFrame, files: DataFrame) -> DataFrame:
    """image_ix, date, path: for each scene the one file whose name has its date; an error if a scene has none or several."""
    named = files.select("path", F.explode(F.array_distinct(F.regexp_extract_all("path", F.lit(r"(\d{8})"), 1))).alias("stamp"))
    met = dates.select("image_ix", "date", F.date_format("date", "yyyyMMdd").alias("stamp")).join(named, "stamp", "left")
    odd = met.groupBy("image_ix").agg(F.count("path").alias("n")).filter("n <> 1")
    if not odd.isEmpty():
        raise ValueError(f"scenes without a file, or with several: {[r['image_ix'] for r in odd.orderBy('image_ix').limit(10).collect()]}")
    return met.select("image_ix", "date", "path")


def paired_files(ifgs: DataFrame, dates: DataFrame, files: DataFrame) -> DataFrame:
    """ifg_id, path: for each interferogram the one file that is named by the dates of its two scenes, in their order."""
    stamp = lambda name: dates.select(F.col("image_ix").alias(name), F.date_format("date", "yyyyMMdd").alias(f"d{name}"))
    named = files.select("path", F.regexp_extract_all("path", F.lit(r"(\d{8})"), 1).alias("stamps")).filter(F.size("stamps") >= 2)
    named = named.select("path", F.col("stamps")[0].alias("da"), F.col("stamps")[1].alias("db"))
    met = ifgs.select("ifg_id", "a", "b").join(stamp("a"), "a").join(stamp("b"), "b").join(named, ["da", "db"], "left")
    odd = met.groupBy("ifg_id").agg(F.count("path").alias("n")).filter("n <> 1")
    if not odd.isEmpty():
        raise ValueError(f"interferograms without a file, or with several: {[r['ifg_id'] for r in odd.orderBy('ifg_id').limit(10).collect()]}")
    return met.select("ifg_id", "path")


def patch_order(names: DataFrame, listed: DataFrame | None = None) -> DataFrame:
    """place, name of the patches of a dataset: in the order of its list if there is one (rows name, at), else by the number
    that ends the name, then the name. A listed patch that is not there is an error."""
    if listed is None:
        order = [F.coalesce(F.regexp_extract("name", r"(\d+)$", 1).try_cast("long"), F.lit(2**31)), F.col("name")]
        return names.select(F.row_number().over(Window.orderBy(*order)).cast("long").alias("place"), "name")
    missing = listed.join(names, "name", "left_anti")
    if not missing.isEmpty():
        raise ValueError(f"listed patches that are not there: {[r['name'] for r in missing.limit(10).collect()]}")
    return listed.select(F.row_number().over(Window.orderBy("at")).cast("long").alias("place"), "name")


def crosscheck(found: DataFrame, network: DataFrame) -> DataFrame:
    """One row on a scene list and a pair list: scenes, pairs, scenes that no pair has, scenes that pairs have and the list has not."""
    used = network.select(F.explode(F.array("a", "b")).alias("image_ix")).distinct()
    alone = found.join(used, "image_ix", "left_anti").agg(F.count("*").alias("unused"))
    strange = used.join(found, "image_ix", "left_anti").agg(F.count("*").alias("unknown"))
    sizes = found.agg(F.count("*").alias("scenes")).crossJoin(network.agg(F.count("*").alias("pairs")))
    return sizes.crossJoin(alone).crossJoin(strange)


def pick_products(files: DataFrame) -> DataFrame:
    """One product for each date: the preferred kind, then the shortest path, then the first."""
    kind = F.when(F.col("path").rlike(r"(?i)\.tiff?$"), 0).otherwise(1)
    place = F.row_number().over(Window.partitionBy("date").orderBy(kind, F.length("path"), "path"))
    dated = files.withColumn("date", F.regexp_extract("path", r"(\d{8})", 1)).filter("date <> ''")
    return dated.withColumn("place", place).filter("place = 1").select("date", "path")
