"""Radar and map geometry as expressions; scalars that a whole table shares come in as literals or joined columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M = 6371008.8
#: WGS84.
SEMI_MAJOR, FLATTENING = 6378137.0, 1 / 298.257223563
#: Eccentricity of the polyconic local frame.
ECCENTRICITY = 0.0820944379497


def clipped(x) -> Column:
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), x))


def original_index(index, looks: int) -> Column:
    """Centre of a multilook cell in single-look samples."""
    return index * looks + F.lit((looks - 1) / 2)


def slant_range(range_index, near: float, spacing: float) -> Column:
    return F.lit(near) + range_index * spacing


def look_angle(slant, orbit: float, earth: float) -> Column:
    """Angle at the antenna between nadir and target; orbit and earth are radii."""
    return F.acos(clipped((orbit**2 + slant * slant - earth**2) / (2 * orbit * slant)))


def incidence_angle(slant, orbit: float, earth: float) -> Column:
    return F.acos(clipped((F.lit(orbit**2 - earth**2) - slant * slant) / (2 * earth * slant)))


def baseline_at(start, rate, azimuth, centre: float, prf: float) -> Column:
    """A baseline component that drifts along track."""
    return start + rate * (azimuth - F.lit(centre)) / prf


def perpendicular(cross, normal, look) -> Column:
    return cross * F.cos(look) - normal * F.sin(look)


def vertical_factor(incidence, positive: str = "up") -> Column:
    return F.lit(1.0 if positive == "up" else -1.0) / F.cos(incidence)


def utm_epsg(lon, lat) -> Column:
    zone = F.greatest(F.lit(1), F.least(F.lit(60), F.floor((lon + 180) / 6) + 1))
    return (zone + F.when(lat >= 0, 32600).otherwise(32700)).cast("int")


def flat_metres(lon, lat, lon0, lat0, east: float | Column, north: float | Column) -> tuple[Column, Column]:
    """Metres east and north of (lon0, lat0) on the ellipsoid's radii there."""
    return F.radians(lon - lon0) * east, F.radians(lat - lat0) * north


def curvature(lat) -> tuple[Column, Column]:
    """Metres per radian of longitude and of latitude."""
    e2 = FLATTENING * (2 - FLATTENING)
    s = 1 - e2 * F.pow(F.sin(F.radians(lat)), 2)
    return SEMI_MAJOR / F.sqrt(s) * F.cos(F.radians(lat)), SEMI_MAJOR * (1 - e2) / F.pow(s, 1.5)


def meridian_arc(phi) -> Column:
    e2 = ECCENTRICITY**2
    e4, e6 = e2**2, e2**3
    return SEMI_MAJOR * (
        (1 - e2 / 4 - 3 * e4 / 64 - 5 * e6 / 256) * phi
        - (3 * e2 / 8 + 3 * e4 / 32 + 45 * e6 / 1024) * F.sin(2 * phi)
        + (15 * e4 / 256 + 45 * e6 / 1024) * F.sin(4 * phi)
        - (35 * e6 / 3072) * F.sin(6 * phi)
    )


def polyconic(lon, lat, lon0, lat0) -> tuple[Column, Column]:
    """Local metres in the polyconic frame around (lon0, lat0)."""
    phi, dlon = F.radians(lat), F.radians(lon - lon0)
    n = SEMI_MAJOR / F.sqrt(1 - ECCENTRICITY**2 * F.pow(F.sin(phi), 2))
    e = dlon * F.sin(phi)
    arc0 = meridian_arc(F.radians(lat0))
    x = F.when(lat == 0, SEMI_MAJOR * dlon).otherwise(n * F.cot(phi) * F.sin(e))
    y = F.when(lat == 0, -arc0).otherwise(meridian_arc(phi) - arc0 + n * F.cot(phi) * (1 - F.cos(e)))
    return x, y


def transverse_mercator(lon, lat, lon0) -> tuple[Column, Column]:
    """Easting and northing (southern metres negative) of the UTM projection on WGS84, series to the sixth order."""
    e2 = FLATTENING * (2 - FLATTENING)
    ep2 = e2 / (1 - e2)
    phi = F.radians(lat)
    n = SEMI_MAJOR / F.sqrt(1 - e2 * F.pow(F.sin(phi), 2))
    t, c, a = F.pow(F.tan(phi), 2), ep2 * F.pow(F.cos(phi), 2), F.cos(phi) * F.radians(lon - lon0)
    e4, e6 = e2**2, e2**3
    m = SEMI_MAJOR * (
        (1 - e2 / 4 - 3 * e4 / 64 - 5 * e6 / 256) * phi
        - (3 * e2 / 8 + 3 * e4 / 32 + 45 * e6 / 1024) * F.sin(2 * phi)
        + (15 * e4 / 256 + 45 * e6 / 1024) * F.sin(4 * phi)
        - (35 * e6 / 3072) * F.sin(6 * phi)
    )
    k = 0.9996
    x = 500000 + k * n * (a + (1 - t + c) * F.pow(a, 3) / 6 + (5 - 18 * t + t * t + 72 * c - 58 * ep2) * F.pow(a, 5) / 120)
    y = k * (m + n * F.tan(phi) * (a * a / 2 + (5 - t + 9 * c + 4 * c * c) * F.pow(a, 4) / 24 + (61 - 58 * t + t * t + 600 * c - 330 * ep2) * F.pow(a, 6) / 720))
    return x, y


def central_meridian(zone_epsg) -> Column:
    return (zone_epsg % 100) * 6 - 183


def distance(lon, lat, lon0, lat0) -> Column:
    """Equirectangular metres."""
    cos0 = math.cos(math.radians(lat0)) if isinstance(lat0, (int, float)) else F.cos(F.radians(lat0))
    return F.hypot(F.radians(lon - lon0) * EARTH_M * cos0, F.radians(lat - lat0) * EARTH_M)


def looks(original, multilooked) -> Column:
    """How many cells of an axis became one, from its two sizes; null where they don't go together."""
    ratio = F.greatest(F.lit(1), F.bround(original / multilooked).cast("long"))
    fits = (multilooked == F.floor(original / ratio)) | (multilooked == F.ceil(original / ratio))
    return F.when((original > 0) & (multilooked > 0) & fits, ratio)


def local_frame(points, heading: float):
    """points with x, y: metres from the middle of their extent on the ellipsoid's radii there, turned by 180 degrees less the
    heading if that makes both extents smaller, to millimetres. Extents are one broadcast row."""
    ends = points.agg(((F.min("lon") + F.max("lon")) / 2).alias("lon0"), ((F.min("lat") + F.max("lat")) / 2).alias("lat0"))
    east, north = curvature(F.col("lat0"))
    x, y = flat_metres(F.col("lon"), F.col("lat"), F.col("lon0"), F.col("lat0"), east, north)
    flat = points.crossJoin(F.broadcast(ends)).withColumn("x", x).withColumn("y", y).drop("lon0", "lat0")
    turn = math.radians(180 - heading)
    tx = F.col("x") * math.cos(turn) + F.col("y") * math.sin(turn)
    ty = F.col("y") * math.cos(turn) - F.col("x") * math.sin(turn)
    extent = lambda v: F.max(v) - F.min(v)
    smaller = flat.agg(((extent(tx) < extent(F.col("x"))) & (extent(ty) < extent(F.col("y")))).alias("turned"))
    told = flat.crossJoin(F.broadcast(smaller))
    pick = lambda turned, straight: F.round(F.when(F.col("turned"), turned).otherwise(F.col(straight)), 3) + F.lit(0.0)
    return told.select(*points.columns, pick(tx, "x").alias("x"), pick(ty, "y").alias("y"))
