"""Connected components of a table of edges, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import written


def _to_least(pairs: DataFrame) -> DataFrame:
    """Adds the least neighbour of u (or u itself). The minimum is combined before the shuffle. The second key makes the
    join deal both sides anew instead of along the grouping, so adaptive execution can split a hub's pairs."""
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    again = F.shiftright("u", 1).alias("half")
    return pairs.select("u", "v", again).join(least.select("u", "m", again), ["u", "half"]).drop("half")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b), component being the least node it reaches.

    Each round leaves the edges in a written table; rounds end when the edges no longer change. Self-loops
    and null ends are ignored.
    """
    flat = edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    flat, before = written(flat, "edges"), None
    while True:
        both = flat.union(flat.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _to_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = _to_least(large)
        small = least.select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").where("u <> v").distinct()
        flat = written(small, "edges")
        now = tuple(flat.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    return flat.select(F.col("u").alias("node"), F.col("v").alias("component")).union(flat.select(F.col("v"), F.col("v"))).distinct()
