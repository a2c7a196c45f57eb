"""Registry of queries: a function of (spark, sf_dir) and, where SQL can say the same, DuckDB SQL beside it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function under its name."""

    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with coordinates derived from their ids."""
    lat = ((F.col("event_id") * 7919) % 18000).cast("double") / 100 - 90
    lon = ((F.col("event_id") * 104729) % 36000).cast("double") / 100 - 180
    return table(spark, sf_dir, "events").withColumns({"lat": lat, "lon": lon})


#: The same points in SQL.
POINTS = "(SELECT *, CAST((event_id * 7919) % 18000 AS DOUBLE) / 100 - 90 AS lat, CAST((event_id * 104729) % 36000 AS DOUBLE) / 100 - 180 AS lon FROM events)"

BITS = {5: 11, 7: 14, 8: 15, 9: 17, 10: 18}


def cell_sql(lat: str, lon: str, res: int) -> str:
    n = BITS[res]
    return f"(CASE WHEN {lat} IS NOT NULL AND {lon} IS NOT NULL THEN {res << 52} + least(CAST(floor(({lat} + 90) / 180 * {1 << n}) AS BIGINT), {(1 << n) - 1}) * 67108864 + least(CAST(floor(({lon} + 180) / 360 * {2 << n}) AS BIGINT), {(2 << n) - 1}) END)"


def parent_sql(cell: str, res: int, to: int) -> str:
    s = BITS[res] - BITS[to]
    return f"({to << 52} + (((({cell}) >> 26) & 67108863) >> {s}) * 67108864 + ((({cell}) & 67108863) >> {s}))"


def lat_sql(cell: str, res: int) -> str:
    return f"((((({cell}) >> 26) & 67108863) + 0.5::DOUBLE) * 180.0::DOUBLE / {1 << BITS[res]} - 90.0::DOUBLE)"


def lon_sql(cell: str, res: int) -> str:
    return f"(((({cell}) & 67108863) + 0.5::DOUBLE) * 360.0::DOUBLE / {2 << BITS[res]} - 180.0::DOUBLE)"


def hilbert_sql(source: str, columns: str, order: int = 16) -> str:
    """A query for ``columns`` and ``h`` of a source with lat and lon: one nested step a bit."""
    side = (1 << order) - 1
    q = f"SELECT *, 0::BIGINT AS h, CAST(floor((lon + 180) / 360 * {side}) AS BIGINT) AS hx, CAST(floor((lat + 90) / 180 * {side}) AS BIGINT) AS hy FROM {source}"
    for bit in range(order - 1, -1, -1):
        s = 1 << bit
        q = f"SELECT * EXCLUDE (h, hx, hy, rx, ry), h + {s * s}::BIGINT * xor(3 * rx, ry) AS h, CASE WHEN ry = 0 THEN CASE WHEN rx = 1 THEN {side} - hy ELSE hy END ELSE hx END AS hx, CASE WHEN ry = 0 THEN CASE WHEN rx = 1 THEN {side} - hx ELSE hx END ELSE hy END AS hy FROM (SELECT *, CASE WHEN (hx & {s}) > 0 THEN 1 ELSE 0 END AS rx, CASE WHEN (hy & {s}) > 0 THEN 1 ELSE 0 END AS ry FROM ({q}))"
    return f"SELECT {columns}, h FROM ({q})"
