"""Points, grid cells, Hilbert order and distances as column expressions.

Cells are nested latitude/longitude rectangles with 64-bit ids, ``resolution * 2**52 + row * 2**26 + column``. They are a
scheme of their own, not interchangeable with others, and narrow toward the poles. All of it stays in the JVM.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Latitude bits of each resolution; longitude has one bit more.
BITS = {5: 11, 7: 14, 8: 15, 9: 17, 10: 18}

_ROW, _COL = 1 << 26, (1 << 26) - 1


def point(lon: Column, lat: Column) -> Column:
    """struct<x, y>, null if a coordinate is."""
    return F.when(lon.isNotNull() & lat.isNotNull(), F.struct(lon.cast("double").alias("x"), lat.cast("double").alias("y")))


def in_bbox(lat: Column, lon: Column, box: tuple[float, float, float, float]) -> Column:
    """Inside (south, west, north, east), edges included."""
    south, west, north, east = box
    return lat.between(south, north) & lon.between(west, east)


def within_envelope(p: Column, west: float, south: float, east: float, north: float) -> Column:
    """Strictly inside: a point on the boundary is not within."""
    return (p.x > west) & (p.x < east) & (p.y > south) & (p.y < north)


def in_ring(x: Column, y: Column, ring: list[tuple[float, float]]) -> Column:
    """Even-odd rule over the edges of a ring of (x, y)."""
    crossings = []
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True):
        if y1 != y2:
            straddles = (F.lit(y1) > y) != (F.lit(y2) > y)
            crossings.append((straddles & (x < (F.lit(x2 - x1) * (y - y1) / F.lit(y2 - y1) + x1))).cast("int"))
    return reduce(lambda a, b: a + b, crossings) % 2 == 1


def cell_id(lat: Column, lon: Column, res: int) -> Column:
    """Null if a coordinate is (``least`` alone would skip nulls)."""
    n = BITS[res]
    row = F.least(F.floor((lat + 90) / 180 * float(1 << n)), F.lit((1 << n) - 1))
    col = F.least(F.floor((lon + 180) / 360 * float(1 << (n + 1))), F.lit((1 << (n + 1)) - 1))
    return F.when(lat.isNotNull() & lon.isNotNull(), (F.lit(res << 52) + row * _ROW + col).cast("bigint"))


def cell_res(cell: Column) -> Column:
    return F.shiftright(cell, 52).cast("int")


def cell_row(cell: Column) -> Column:
    return F.shiftright(cell, 26).bitwiseAND(F.lit(_COL))


def cell_col(cell: Column) -> Column:
    return cell.bitwiseAND(F.lit(_COL))


def cell_lat(cell: Column, res: int) -> Column:
    """Latitude of the centre."""
    return (cell_row(cell) + 0.5) * 180.0 / float(1 << BITS[res]) - 90.0


def cell_lon(cell: Column, res: int) -> Column:
    return (cell_col(cell) + 0.5) * 360.0 / float(1 << (BITS[res] + 1)) - 180.0


def cell_parent(cell: Column, res: int, to: int) -> Column:
    shift = BITS[res] - BITS[to]
    return (F.lit(to << 52) + F.shiftright(cell_row(cell), shift) * _ROW + F.shiftright(cell_col(cell), shift)).cast("bigint")


def cell_center_child(cell: Column, res: int, to: int) -> Column:
    """The finer cell at the centre of a cell."""
    return cell_id(cell_lat(cell, res), cell_lon(cell, res), to)


def cell_text(cell: Column) -> Column:
    return F.lower(F.hex(cell))


def cell_from_text(text: Column) -> Column:
    return F.conv(text, 16, 10).cast("bigint")


def cell_boundary(cell: Column, res: int) -> Column:
    """Outline as array<struct<x, y>>: south-west, south-east, north-east, north-west."""
    n = BITS[res]
    height, width = 180.0 / (1 << n), 360.0 / (1 << (n + 1))
    row, col = cell_row(cell), cell_col(cell)
    corner = lambda dx, dy: F.struct(((col + dx) * width - 180.0).alias("x"), ((row + dy) * height - 90.0).alias("y"))
    return F.array(corner(0, 0), corner(1, 0), corner(1, 1), corner(0, 1))


def cell_range(south: float, north: float, res: int) -> tuple[int, int]:
    """Bounds of the ids whose centre can lie between two latitudes: rows are the high bits, so file statistics can skip."""
    rows = 1 << BITS[res]
    low = max(0, int((south + 90) / 180 * rows) - 1)
    high = min(rows - 1, int((north + 90) / 180 * rows) + 1)
    return (res << 52) + low * _ROW, (res << 52) + high * _ROW + _COL


def center_in_bbox(cell: Column, res: int, box: tuple[float, float, float, float]) -> Column:
    """Centre inside a box, with the implied range of ids, which is pushed to the scan."""
    low, high = cell_range(box[0], box[2], res)
    return cell.between(low, high) & in_bbox(cell_lat(cell, res), cell_lon(cell, res), box)


def with_cells(df: DataFrame, lat: str, lon: str, resolutions: list[int]) -> DataFrame:
    return df.withColumns({f"cell_r{r}": cell_id(F.col(lat), F.col(lon), r) for r in resolutions})


def _curve() -> tuple[list[int], list[int]]:
    """The Hilbert curve as a machine that takes two bits of x and y at a time: for each state (2 * swapped + flipped) the digits
    (four bits each) and the next states (two bits each), packed by ``4 * bits of x + bits of y``."""
    digits, states = [0] * 4, [0] * 4
    for state in range(4):
        for at in range(16):
            swap, flip, digit = state >> 1, state & 1, 0
            for bit in (1, 0):
                x, y = at >> 2 + bit & 1, at >> bit & 1
                rx, ry = (y ^ flip, x ^ flip) if swap else (x ^ flip, y ^ flip)
                digit = 4 * digit + (3 * rx ^ ry)
                swap, flip = swap ^ (ry == 0), flip ^ (rx & (ry == 0))
            digits[state] |= digit << 4 * at
            states[state] |= (2 * swap + flip) << 2 * at
    return [d - (1 << 64) if d >> 63 else d for d in digits], states


_DIGITS, _STATES = _curve()


def hilbert_index(lon: Column, lat: Column, order: int = 16) -> Column:
    """Position along a Hilbert curve over the globe, of ``order`` (even) bits a coordinate. Plain arithmetic, so it stays in generated
    code; a sort takes it from a column (``shape.hilbert_sort``), as an expression in the order would be computed in every comparison."""
    side = float((1 << order) - 1)
    x, y = F.floor((lon + 180) / 360 * side), F.floor((lat + 90) / 180 * side)
    tables = [F.array(*(F.lit(v).cast("bigint") for v in t)) for t in (_DIGITS, _STATES)]
    packed = lambda table, state, at, bits: F.call_function("shiftright", F.get(table, state), at * bits).bitwiseAND(F.lit((1 << bits) - 1))
    state, index = F.lit(0), F.lit(0).cast("bigint")
    for bit in range(order - 2, -1, -2):
        at = (F.shiftright(x, bit).bitwiseAND(F.lit(3)) * 4 + F.shiftright(y, bit).bitwiseAND(F.lit(3))).cast("int")
        index, state = index * 16 + packed(tables[0], state, at, 4), packed(tables[1], state, at, 2).cast("int")
    return index


def haversine_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.asin(F.sqrt(a)) * (2 * 6371.0088)


def _segments(line: Column) -> Column:
    return F.when(F.size(line) > 1, F.transform(F.sequence(F.lit(1), F.size(line) - 1), lambda i: F.struct(F.get(line, i - 1).alias("p"), F.get(line, i).alias("q")))).otherwise(F.array())


def line_length_km(line: Column) -> Column:
    """struct<km, skipped> of a line of struct<x, y>: segments that jump over 180 degrees or are not finite are counted apart."""
    usable = lambda s: F.coalesce((F.abs(s.p.x - s.q.x) <= 180) & ~F.isnan(s.p.x + s.p.y + s.q.x + s.q.y), F.lit(False))
    parts = _segments(line)
    km = F.aggregate(F.filter(parts, usable), F.lit(0.0), lambda acc, s: acc + haversine_km(s.p.x, s.p.y, s.q.x, s.q.y))
    return F.struct(km.alias("km"), F.size(F.filter(parts, lambda s: ~usable(s))).alias("skipped"))


def line_centroid(line: Column) -> Column:
    """Mean of segment middles weighted by planar length; of a line without length its first point."""
    length = lambda s: F.sqrt(F.pow(s.p.x - s.q.x, 2) + F.pow(s.p.y - s.q.y, 2))
    zero = F.struct(F.lit(0.0).alias("w"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    step = lambda a, s: F.struct((a.w + length(s)).alias("w"), (a.x + length(s) * (s.p.x + s.q.x) / 2).alias("x"), (a.y + length(s) * (s.p.y + s.q.y) / 2).alias("y"))
    return F.aggregate(_segments(line), zero, step, lambda a: F.when(a.w > 0, F.struct((a.x / a.w).alias("x"), (a.y / a.w).alias("y"))).otherwise(F.get(line, 0)))


def representative_point(line: Column) -> Column:
    """A stable point on a line: its middle vertex."""
    return F.get(line, F.floor(F.size(line) / 2).cast("int"))


def wkb_point(x: Column, y: Column) -> Column:
    """Little-endian WKB of a point, by an Arrow function: there is no built-in from doubles to bytes. A batch is one buffer."""

    @F.arrow_udf("binary")
    def pack(xs: pa.Array, ys: pa.Array) -> pa.Array:
        out = np.zeros(len(xs), dtype=[("order", "u1"), ("kind", "<u4"), ("x", "<f8"), ("y", "<f8")])
        out["order"], out["kind"] = 1, 1
        for name, values in (("x", xs), ("y", ys)):
            out[name] = pc.fill_null(values, 0.0).to_numpy(zero_copy_only=False)
        both = pc.and_(pc.is_valid(xs), pc.is_valid(ys)).to_numpy(zero_copy_only=False)
        offsets = np.arange(len(out) + 1, dtype=np.int32) * out.itemsize
        return pa.Array.from_buffers(pa.binary(), len(out), [pa.py_buffer(np.packbits(both, bitorder="little").tobytes()), pa.py_buffer(offsets.tobytes()), pa.py_buffer(out.tobytes())])

    return pack(x, y)


def pixel_to_lonlat(y: Column, x: Column, box: tuple[float, float, float, float], rows: int, cols: int) -> Column:
    """struct<lat, lon> by linear spacing from the north-west corner of (south, west, north, east)."""
    south, west, north, east = box
    return F.struct((F.lit(north) - y * ((north - south) / max(rows - 1, 1))).alias("lat"), (F.lit(west) + x * ((east - west) / max(cols - 1, 1))).alias("lon"))
