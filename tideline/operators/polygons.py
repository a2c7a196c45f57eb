"""Points in polygons by cells: a table of polygons, with holes, is covered by cells, points join it by their own cell, and only
points in cells that a border crosses are tested against it.

A polygon is ``rings``: array<array<struct<x, y>>>, the outer ring and holes in any order; a ring need not repeat its first point. Inside is
what an odd number of edges has on its right (the even-odd rule), so a point in a hole is outside. Polygons may overlap, and a point has
a row for each that holds it. A ring across the antimeridian has to be cut there before. Null, empty and one-point rings hold nothing.

Everything is columns and equi-joins. A polygon's cover is made row by row of cells: a row of cells keeps the edges that reach into
it, which are all that a test of a point there needs, so no polygon is sent whole to a point.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.spatial import BITS, _ROW, cell_id


def right_of(x: Column, y: Column, edges: Column) -> Column:
    """Whether an odd number of edges (array<struct<x1, y1, x2, y2>>) lies to the right of a point."""
    crosses = lambda e: ((e.y1 > y) != (e.y2 > y)) & (x < (e.x2 - e.x1) * (y - e.y1) / (e.y2 - e.y1) + e.x1)
    return F.size(F.filter(edges, crosses)) % 2 == 1


def _edges(rings: Column) -> Column:
    closed = lambda ring: F.concat(ring, F.slice(ring, 1, 1))
    edge = lambda ring: F.transform(F.sequence(F.lit(0), F.size(ring) - 2), lambda i: F.struct(*(F.get(ring, i + k)[c].cast("double").alias(f"{c}{k + 1}") for k in (0, 1) for c in "xy")))
    return F.flatten(F.transform(F.filter(rings, lambda r: F.coalesce(F.size(r) > 1, F.lit(False))), lambda r: edge(closed(r))))


def cover(polygons: DataFrame, key: str, res: int) -> DataFrame:
    """(key, cell, edges) of all cells that a polygon touches: null edges where the cell lies inside, else those that decide its points."""
    n = BITS[res]
    high, wide = 180.0 / (1 << n), 360.0 / (2 << n)
    row = lambda y: F.least(F.greatest(F.floor((y + 90) / high), F.lit(0)), F.lit((1 << n) - 1))
    col = lambda x: F.least(F.greatest(F.floor((x + 180) / wide), F.lit(0)), F.lit((2 << n) - 1))
    edges = polygons.select(key, F.explode(_edges(F.col("rings"))).alias("e"))
    # Borders are widened a little, so that rounding leaves no cell out; a cell too many is only tested for nothing.
    tiny = 1e-9
    low, top = F.least("e.y1", "e.y2"), F.greatest("e.y1", "e.y2")
    rows = edges.select(key, "e", F.explode(F.sequence(row(low - tiny), row(top + tiny))).alias("row"))
    # The part of an edge that lies in a row of cells: where it enters and leaves the row.
    south = F.col("row") * high - 90.0
    along = lambda y: F.when(F.col("e.y1") == F.col("e.y2"), F.col("e.x1")).otherwise(F.col("e.x1") + (y - F.col("e.y1")) * (F.col("e.x2") - F.col("e.x1")) / (F.col("e.y2") - F.col("e.y1")))
    a, b = along(F.greatest(low, south - tiny)), F.when(F.col("e.y1") == F.col("e.y2"), F.col("e.x2")).otherwise(along(F.least(top, south + high + tiny)))
    part = rows.select(key, "row", "e", F.sequence(col(F.least(a, b) - tiny), col(F.greatest(a, b) + tiny)).alias("cols"))
    lines = part.groupBy(key, "row").agg(F.array_distinct(F.flatten(F.collect_list("cols"))).alias("border"), F.collect_list("e").alias("edges"))  # a row of cells of one polygon
    cells = lines.select(key, "row", "edges", "border", F.explode(F.sequence(F.array_min("border"), F.array_max("border"))).alias("col"))
    crossed = F.array_contains("border", F.col("col"))
    inside = right_of((F.col("col") + 0.5) * wide - 180.0, (F.col("row") + 0.5) * high - 90.0, F.col("edges"))
    cell = (F.lit(res << 52) + F.col("row") * _ROW + F.col("col")).cast("bigint").alias("cell")
    return cells.where(crossed | inside).select(key, cell, F.when(crossed, F.col("edges")).alias("edges"))


def points_in_polygons(points: DataFrame, lat: str, lon: str, polygons: DataFrame, key: str, res: int = 5) -> DataFrame:
    """``points`` with the ``key`` of each polygon that holds them. Finer cells leave fewer points to test and make more cells."""
    at = points.withColumn("_cell", cell_id(F.col(lat), F.col(lon), res))
    found = at.join(cover(polygons, key, res).select(F.col(key).alias("_key"), F.col("cell").alias("_cell"), F.col("edges").alias("_edges")), "_cell")
    held = found.where(F.col("_edges").isNull() | right_of(F.col(lon).cast("double"), F.col(lat).cast("double"), F.col("_edges")))
    return held.select(*points.columns, F.col("_key").alias(key if key not in points.columns else f"{key}_polygon"))


def within(points: DataFrame, lat: str, lon: str, covered: DataFrame, res: int) -> DataFrame:
    """``points`` that some polygon of a ``cover`` holds, each once."""
    at = points.withColumn("_cell", cell_id(F.col(lat), F.col(lon), res))
    other = covered.select(F.col("cell").alias("_cell"), F.col("edges").alias("_edges"))
    decided = F.col("_edges").isNull() | right_of(F.col(lon).cast("double"), F.col(lat).cast("double"), F.col("_edges"))
    return at.join(other, (at["_cell"] == other["_cell"]) & decided, "left_semi").drop("_cell")
