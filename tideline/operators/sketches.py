"""Profiles that are made once and merged: of each column counts, ends, moments, and sketches of distinct values and quantiles.

A sketch row is small whatever it stands for, and rows of parts (files, days, batches) merge into that of the whole: counts and ends
exactly, the mean and deviation up to rounding, distinct counts by HyperLogLog (``lg_k`` = 12, error about 1.6 %), quantiles by a KLL sketch
(rank error about 1.3 % at its default size). So a table's profile needs a pass only over files that have none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def sketch(df: DataFrame, columns: list[str], *by: str) -> DataFrame:
    """(by, column_name, column_type, count, nulls, lo, hi, mean, m2, distinct, ranks) in one pass; one row a column and group.

    Columns that are no numbers have counts, nulls and distinct values alone.
    """
    parts = []
    for c in columns:
        kind = df.schema[c].dataType
        number = isinstance(kind, NumericType)
        v = F.col(c).cast("double") if number else F.lit(None).cast("double")
        ranks = F.kll_sketch_agg_double(v) if number else F.lit(None).cast("binary")
        moments = (F.min(v), F.max(v), F.avg(v), F.var_pop(v) * F.count(v)) if number else (F.lit(None).cast("double"),) * 4
        parts.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(kind.simpleString()).alias("column_type"),
                F.count("*").alias("count"),
                F.count_if(F.col(c).isNull()).alias("nulls"),
                *(x.alias(n) for x, n in zip(moments, ("lo", "hi", "mean", "m2"), strict=True)),
                F.hll_sketch_agg(F.col(c).cast("string")).alias("distinct"),
                ranks.alias("ranks"),
            )
        )
    return df.groupBy(*by).agg(F.array(*parts).alias("_parts")).select(*by, F.inline("_parts"))


def merged(sketches: DataFrame, *by: str) -> DataFrame:
    """The profile of what the sketches stand for together: (by, column_name, column_type, min, max, approx_unique, avg, std, quartiles,
    count, null_percentage)."""
    seen = F.col("count") - F.col("nulls")
    total = F.sum(seen)
    mean = F.sum(seen * F.col("mean")) / total
    # Within parts and between their means.
    spread = F.sum("m2") + F.sum(seen * F.col("mean") * F.col("mean")) - total * mean * mean
    numbers = sketches.groupBy(*by, "column_name", "column_type").agg(
        F.min("lo").alias("min"),
        F.max("hi").alias("max"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("approx_unique"),
        mean.alias("avg"),
        F.when(total > 1, F.sqrt(F.greatest(spread, F.lit(0.0)) / (total - 1))).alias("std"),
        F.kll_merge_agg_double(F.when(seen > 0, F.col("ranks"))).alias("_ranks"),
        F.sum("count").alias("count"),
        F.round(100.0 * F.sum("nulls") / F.nullif(F.sum("count"), F.lit(0)), 2).alias("null_percentage"),
    )
    told = F.col("min").isNotNull()
    quartiles = [F.when(told, F.kll_sketch_get_quantile_double("_ranks", F.lit(q))).alias(n) for n, q in QUARTILES.items()]
    return numbers.select(*by, "column_name", "column_type", "min", "max", "approx_unique", "avg", "std", *quartiles, "count", "null_percentage")
