"""Deterministic tables of the engine's model, derived from the driver's tables, in Spark and as oracle SQL.

The same definitions serve both engines: ``FX`` maps a name to (parents, Spark SQL, DuckDB SQL); None means the Spark text. Parents stand in braces.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

PI = 3.141592653589793
WAVELENGTH = 0.05546576
TABLES = "region nation customer supplier part orders lineitem events embeddings".split()

#: name: (parents, Spark SQL, DuckDB SQL or None for the same text)
FX: dict[str, tuple[str, str, str | None]] = {
    "fx_phase": (
        "embeddings",
        "SELECT vec_id + 1 AS ps_id, CAST(pos + 1 AS BIGINT) AS ifg_id, atan2(sin(20 * CAST(x AS DOUBLE)), cos(20 * CAST(x AS DOUBLE))) AS phi"
        " FROM {embeddings} embeddings LATERAL VIEW posexplode(embedding) e AS pos, x",
        "SELECT vec_id + 1 AS ps_id, CAST(pos AS BIGINT) AS ifg_id, atan2(sin(20 * CAST(x AS DOUBLE)), cos(20 * CAST(x AS DOUBLE))) AS phi FROM"
        " (SELECT vec_id, unnest(range(1, len(embedding) + 1)) AS pos, unnest(embedding) AS x FROM {embeddings} embeddings)",
    ),
    "fx_coh": (
        "fx_phase",
        "SELECT ps_id, sqrt(power(sum(cos(phi)), 2) + power(sum(sin(phi)), 2)) / count(*) AS coh FROM {fx_phase} fx_phase GROUP BY ps_id",
        None,
    ),
    "fx_ps": (
        "embeddings fx_coh",
        "SELECT vec_id + 1 AS ps_id, CAST(label AS BIGINT) AS patch_id, CAST(floor(vec_id / 25.0D) AS BIGINT) AS row, vec_id % 25 AS col,"
        " CAST(40 * (vec_id % 25) AS DOUBLE) AS x, 40 * floor(vec_id / 25.0D) AS y, -120 + 0.0004D * (vec_id % 25) AS lon,"
        " 35 + 0.00036D * floor(vec_id / 25.0D) AS lat, 0.1D + ((vec_id * 37) % 100) / 250.0D AS d_a, coh,"
        " CAST((vec_id * 53) % 400 AS DOUBLE) AS hgt FROM {embeddings} embeddings JOIN {fx_coh} fx_coh ON fx_coh.ps_id = embeddings.vec_id + 1",
        "SELECT vec_id + 1 AS ps_id, CAST(label AS BIGINT) AS patch_id, CAST(floor(vec_id / 25.0) AS BIGINT) AS row, vec_id % 25 AS col,"
        " CAST(40 * (vec_id % 25) AS DOUBLE) AS x, CAST(40 * floor(vec_id / 25.0) AS DOUBLE) AS y, -120 + CAST(0.0004 AS DOUBLE) * (vec_id % 25) AS lon,"
        " 35 + CAST(0.00036 AS DOUBLE) * floor(vec_id / 25.0) AS lat, CAST(0.1 AS DOUBLE) + ((vec_id * 37) % 100) / CAST(250 AS DOUBLE) AS d_a, coh,"
        " CAST((vec_id * 53) % 400 AS DOUBLE) AS hgt FROM {embeddings} embeddings JOIN {fx_coh} fx_coh ON fx_coh.ps_id = embeddings.vec_id + 1",
    ),
    "fx_images": (
        "",
        "SELECT id AS image_ix, CAST(739252 + 12 * (id - 1) AS DOUBLE) AS day FROM range(1, 20)",
        "SELECT range AS image_ix, CAST(739252 + 12 * (range - 1) AS DOUBLE) AS day FROM range(1, 20)",
    ),
    "fx_ifgs": (
        "fx_images",
        "SELECT ifg_id, a, b, CAST((37 * a + 11 * b) % 201 - 100 AS DOUBLE) AS bperp, CAST(12 * (b - a) AS DOUBLE) AS dt FROM"
        " (SELECT row_number() OVER (ORDER BY p.image_ix, q.image_ix) AS ifg_id, p.image_ix AS a, q.image_ix AS b FROM {fx_images} p JOIN {fx_images} q"
        " ON q.image_ix - p.image_ix BETWEEN 1 AND 4) n WHERE ifg_id <= 64",
        None,
    ),
    "fx_amp": (
        "lineitem",
        "SELECT l_partkey AS pixel, l_suppkey % 20 AS image, avg(l_extendedprice) AS amp FROM {lineitem} lineitem GROUP BY l_partkey, l_suppkey % 20",
        None,
    ),
    "fx_ts": (
        "events",
        "SELECT user_id AS pt, datediff(CAST(ts AS DATE), DATE'2024-01-01') AS day, avg(value) AS v FROM {events} events GROUP BY 1, 2",
        "SELECT user_id AS pt, CAST(datediff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS day, avg(value) AS v FROM {events} events GROUP BY 1, 2",
    ),
    "fx_net": (
        "lineitem orders customer supplier",
        "SELECT least(c_nationkey, s_nationkey) AS a, greatest(c_nationkey, s_nationkey) AS b, stddev_samp(l_discount) AS stat FROM {lineitem} lineitem"
        " JOIN {orders} orders ON l_orderkey = o_orderkey JOIN {customer} customer ON o_custkey = c_custkey JOIN {supplier} supplier ON l_suppkey = s_suppkey"
        " WHERE c_nationkey <> s_nationkey AND (c_nationkey + s_nationkey) % 3 < 2 GROUP BY 1, 2",
        None,
    ),
    "fx_pts": (
        "customer",
        "SELECT c_custkey AS pt, -120 + (c_custkey * 7919 % 1000) / 1000.0D AS lon, 35 + (c_custkey * 104729 % 1000) / 1000.0D AS lat,"
        " c_acctbal AS value FROM {customer} customer",
        "SELECT c_custkey AS pt, -120 + (c_custkey * 7919 % 1000) / CAST(1000 AS DOUBLE) AS lon, 35 + (c_custkey * 104729 % 1000) / CAST(1000 AS DOUBLE) AS lat,"
        " c_acctbal AS value FROM {customer} customer",
    ),
    "fx_run": ("orders", "SELECT o_orderkey AS key, o_totalprice AS v FROM {orders} orders", None),
    "fx_golden": (
        "orders",
        "SELECT o_orderkey AS key, o_totalprice + 0.00001D * (o_orderkey % 3) AS v FROM {orders} orders WHERE o_orderkey % 1000 <> 7",
        "SELECT o_orderkey AS key, o_totalprice + CAST(0.00001 AS DOUBLE) * (o_orderkey % 3) AS v FROM {orders} orders WHERE o_orderkey % 1000 <> 7",
    ),
}


def parents(names: str) -> list[str]:
    """The fixtures that `names` need, in order, themselves included."""
    found: list[str] = []
    for name in names.split():
        if name in FX:
            for p in [*parents(FX[name][0]), name]:
                if p not in found:
                    found.append(p)
    return found


def oracle(needs: str, body: str) -> str:
    """DuckDB SQL with the fixtures as common table expressions. A body may start with more of them: 'WITH x AS (..) SELECT'."""
    listed = ",\n".join(f"{n} AS ({re.sub(r'[{}]', '', FX[n][2] or FX[n][1])})" for n in parents(needs))
    body = body.strip()
    if not listed:
        return body
    if body.startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {listed}, {body[15:]}"
    return f"WITH {listed}, {body[5:]}" if body.startswith("WITH ") else f"WITH {listed}\n{body}"


class Fixtures:
    """DataFrames of the fixtures and of the tables of one folder, as attributes."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self._spark.read.parquet(f"{self._dir}/{name}.parquet")
        if name not in FX:
            raise AttributeError(name)
        return self._spark.sql(FX[name][1], **{p: getattr(self, p) for p in FX[name][0].split()})
