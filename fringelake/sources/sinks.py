"""Sinks: artifact tables, manifests, point features, point shapes and coloured rasters."""

from __future__ import annotations

import json
import os
import struct

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_artifact(df: DataFrame, root: str, name: str, by: list[str] | None = None) -> None:
    """A named table of a dataset folder; readers prune columns and partitions."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(f"{root}/{name}")


def write_feature_lines(df: DataFrame, path: str, lon: str = "lon", lat: str = "lat") -> None:
    """One GeoJSON feature a line, written in parallel; the other columns are its properties."""
    rest = [c for c in df.columns if c not in (lon, lat)]
    geometry = F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates"))
    df.select(F.to_json(F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), F.struct(*rest).alias("properties"))).alias("value")).write.mode("overwrite").text(path)


def write_feature_collection(df: DataFrame, path: str, lon: str = "lon", lat: str = "lat") -> int:
    """One GeoJSON file with all features, written row by row by the driver, which never holds more than a part."""
    rest, n = [c for c in df.columns if c not in (lon, lat)], 0
    geometry = F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates"))
    features = df.select(F.to_json(F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), F.struct(*rest).alias("properties"))).alias("value"))
    with open(path, "w", encoding="utf-8") as file:
        file.write('{"type":"FeatureCollection","features":[')
        for row in features.toLocalIterator():
            file.write(("," if n else "") + "\n" + row["value"])
            n += 1
        file.write("\n]}\n")
    return n


def series_columns(ts: DataFrame, key: str, date: str, value: str) -> DataFrame:
    """A row for each point with a column D<yyyymmdd> for each date: the table of a series shapefile. Dates are as few as the
    acquisitions."""
    stamped = ts.withColumn("stamp", F.date_format(date, "'D'yyyyMMdd"))
    stamps = [r["stamp"] for r in stamped.select("stamp").distinct().orderBy("stamp").collect()]
    return stamped.groupBy(key).pivot("stamp", stamps).agg(F.first(value))


def write_geotiff(cells: DataFrame, path: str, west: float, north: float, size: float, epsg: int, tags: dict[int, str] | None = None) -> tuple[int, int]:
    """A map of two bands, mean and count, from rows (row, col, mean, n) counted from the north-west corner; cells without a row
    are NaN and 0. Rows come to the driver in order, one line of the map is held at once, and the file is as large as the map.
    tags: further text tags by number. Returns (rows, columns)."""
    ends = cells.agg(F.max("row"), F.max("col")).first()
    rows, cols = (int(v) + 1 if v is not None else 0 for v in ends)
    if not rows or not cols:
        raise ValueError("no cells to map")
    texts = {42113: "nan", **(tags or {})}
    doubles = {33550: (size, size, 0.0), 33922: (0.0, 0.0, 0.0, west, north, 0.0)}
    keys = (1, 1, 0, 3, 1024, 0, 1, 1, 1025, 0, 1, 1, 3072, 0, 1, epsg)  # a projected plane, cells as areas, its code
    line, entries, extra = 4 * cols, [], b""
    n_entries = 11 + len(texts) + len(doubles) + 1
    at = 8 + 2 + 12 * n_entries + 4

    def entry(tag, kind, count, content):
        nonlocal extra
        if len(content) <= 4:
            entries.append((tag, struct.pack("<HHI", tag, kind, count) + content.ljust(4, b"\0")))
        else:
            entries.append((tag, struct.pack("<HHII", tag, kind, count, at + len(extra))))
            extra += content + b"\0" * (len(content) % 2)

    short, long = lambda *v: struct.pack(f"<{len(v)}H", *v), lambda *v: struct.pack(f"<{len(v)}I", *v)
    for tag, kind, value in ((256, 4, long(cols)), (257, 4, long(rows)), (259, 3, short(1)), (262, 3, short(1)), (277, 3, short(2)), (278, 4, long(rows)), (284, 3, short(2))):
        entry(tag, kind, 1, value)
    entry(258, 3, 2, short(32, 32))
    entry(339, 3, 2, short(3, 3))
    entry(279, 4, 2, long(rows * line, rows * line))
    for tag, values in doubles.items():
        entry(tag, 12, len(values), struct.pack(f"<{len(values)}d", *values))
    for tag, text in texts.items():
        entry(tag, 2, len(text) + 1, text.encode("ascii") + b"\0")
    entry(34735, 3, len(keys), short(*keys))
    first = at + len(extra) + 8
    entry(273, 4, 2, long(first, first + rows * line))
    with open(path, "wb") as file:
        file.write(struct.pack("<2sHI", b"II", 42, 8) + struct.pack("<H", n_entries) + b"".join(e for _, e in sorted(entries)) + struct.pack("<I", 0) + extra)
        blank, none = struct.pack("<f", float("nan")) * cols, bytes(line)
        for k, filler in enumerate((blank, none)):
            file.seek(first + k * rows * line)
            for _ in range(rows):
                file.write(filler)
        for r in cells.select("row", "col", "mean", "n").orderBy("row", "col").toLocalIterator():
            for k, value in enumerate((r["mean"], r["n"])):
                file.seek(first + k * rows * line + r["row"] * line + 4 * r["col"])
                file.write(struct.pack("<f", float("nan") if value is None else float(value)))
    return rows, cols


def write_series_csv(df: DataFrame, path: str, decimals: int = 6) -> None:
    kept = [F.format_number(c, decimals).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    df.select(*kept).write.mode("overwrite").option("header", True).csv(path)


def write_point_shapes(df: DataFrame, base: str, lon: str = "lon", lat: str = "lat") -> int:
    """base.shp, .shx and .dbf of points with their numeric columns, written row by row by the driver."""
    fields = [c for c, t in df.dtypes if c not in (lon, lat) and t in ("double", "float", "bigint", "int")]
    n, box = 0, [180.0, 90.0, -180.0, -90.0]
    with open(f"{base}.shp", "wb") as shp, open(f"{base}.shx", "wb") as shx, open(f"{base}.dbf", "wb") as dbf:
        shp.write(bytes(100)), shx.write(bytes(100))
        dbf.write(bytes(32 + 32 * len(fields) + 1))
        for row in df.select(lon, lat, *fields).toLocalIterator():
            x, y = float(row[0]), float(row[1])
            box = [min(box[0], x), min(box[1], y), max(box[2], x), max(box[3], y)]
            shx.write(struct.pack(">2i", shp.tell() // 2, 10))
            n += 1
            shp.write(struct.pack(">2i", n, 10) + struct.pack("<i2d", 1, x, y))
            dbf.write(b" " + b"".join(f"{'' if v is None else f'{v:.8g}':>18}".encode() for v in row[2:]))
        dbf.write(b"\x1a")
        for file in (shp, shx):
            size = file.tell() // 2
            file.seek(0)
            file.write(struct.pack(">7i", 9994, 0, 0, 0, 0, 0, size) + struct.pack("<2i8d", 1000, 1, *(box if n else [0.0] * 4), 0, 0, 0, 0))
        dbf.seek(0)
        dbf.write(struct.pack("<4B I 2H 20x", 3, 124, 1, 1, n, 33 + 32 * len(fields), 1 + 18 * len(fields)))
        for name in fields:
            dbf.write(struct.pack("<11s c 4x 2B 14x", name[:10].upper().encode(), b"N", 18, 8))
        dbf.write(b"\r")
    return n


def write_manifest(path: str, **entries) -> None:
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "w", encoding="utf-8") as file:
        json.dump(entries, file, indent=2, sort_keys=True, default=str)
