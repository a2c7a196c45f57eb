"""Raster planes as long tables (scene, band, y, x, value): moving means, speckle filter, change scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import nan_to_null


def _mirrored(df: DataFrame, axis: str, last: str, reach: int):
    """Adds the ``reach`` rows beyond each edge, reflected with the edge repeated (c b a | a b c | c b a)."""
    p, n = F.col(axis), F.col(last)
    copies = F.array_compact(F.array(p, F.when(p < reach, -p - 1), F.when(n - p < reach, 2 * n + 1 - p)))
    return df.withColumn(axis, F.explode(copies))


def box_mean(df: DataFrame, columns: list[str], size: int = 7, planes: list[str] = ("scene", "band")) -> DataFrame:
    """Replaces ``columns`` by their mean over a size x size box: one pass along x, one along y."""
    reach, out = size // 2, df
    for axis, other in (("x", "y"), ("y", "x")):
        line = Window.partitionBy(*planes, other)
        ends = out.withColumn("_last", F.max(axis).over(line))
        run = line.orderBy(axis).rowsBetween(-reach, reach)
        meant = _mirrored(ends, axis, "_last", reach).withColumns({c: F.avg(c).over(run) for c in columns})
        out = meant.where((F.col(axis) >= 0) & (F.col(axis) <= F.col("_last"))).drop("_last")
    return out


def lee_filter(df: DataFrame, size: int = 7, planes: list[str] = ("scene", "band")) -> DataFrame:
    """value becomes m + v / (v + o) * (value - m), of local mean m and variance v and the plane's variance o; unchanged if o is 0."""
    local = box_mean(df.select(*planes, "y", "x", F.col("value").alias("m"), (F.col("value") * F.col("value")).alias("s")), ["m", "s"], size, planes)
    overall = df.groupBy(*planes).agg(F.var_pop("value").alias("o"))
    v = F.greatest(F.col("s") - F.col("m") * F.col("m"), F.lit(0.0))
    filtered = F.when(F.col("o") > 0, F.col("m") + v / (v + F.col("o")) * (F.col("value") - F.col("m"))).otherwise(F.col("value"))
    return df.join(local, [*planes, "y", "x"]).join(overall, [*planes]).withColumn("value", filtered).select(*df.columns)


def welch_t(df: DataFrame, period: str = "period") -> DataFrame:
    """Per pixel the greatest over bands of |mean(pre) - mean(post)| / sqrt(s0²/n0 + s1²/n1). n counts the scenes of a
    period, not the pixel's valid values; missing values are skipped; null where the denominator is 0."""
    scenes = df.groupBy().agg(*(F.countDistinct(F.when(F.col(period) == p, F.col("scene"))).alias(f"n_{p}") for p in ("pre", "post")))
    value = nan_to_null(F.col("value").cast("double"))
    stats = df.groupBy("y", "x", "band").agg(*(f(F.when(F.col(period) == p, value)).alias(f"{n}_{p}") for p in ("pre", "post") for n, f in (("mean", F.avg), ("std", F.stddev_samp))))
    below = F.sqrt(F.pow("std_pre", 2) / F.col("n_pre") + F.pow("std_post", 2) / F.col("n_post"))
    t = F.when(below > 0, F.abs(F.col("mean_pre") - F.col("mean_post")) / below)
    return stats.crossJoin(F.broadcast(scenes)).withColumn("t", t).groupBy("y", "x").agg(F.max("t").alias("t"))
