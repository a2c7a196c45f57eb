"""Projections, filters, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.spatial import hilbert_index


def select_as(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Columns under new names, {new: old}; an old name may be a path into structs."""
    return df.select(*(F.col(old).alias(new) for new, old in names.items()))


def cast_to(df: DataFrame, types: dict[str, str], strict: bool = True) -> DataFrame:
    """Casts in place; a value that does not fit is an error, or null unless ``strict``."""
    return df.withColumns({c: F.col(c).cast(t) if strict else F.col(c).try_cast(t) for c, t in types.items()})


def select_replace(df: DataFrame, **columns: Column) -> DataFrame:
    """Replaces values of existing columns and keeps their places."""
    missing = set(columns) - set(df.columns)
    if missing:
        raise ValueError(f"no such columns: {sorted(missing)}")
    return df.withColumns(columns)


def stamp(df: DataFrame, run_ts: str, with_date: bool = True) -> DataFrame:
    """Adds the run's constant snapshot_time (and snapshot_date); the value is given, so re-planning does not change it."""
    out = df.withColumn("snapshot_time", F.lit(run_ts).cast("timestamp_ntz"))
    return out.withColumn("snapshot_date", F.to_date("snapshot_time")) if with_date else out


def drop_columns(df: DataFrame, deny: list[str]) -> DataFrame:
    return df.drop(*deny)


def classify_tags(df: DataFrame, rules: dict[str, dict[str, list[str] | bool]], tags: str = "tags") -> DataFrame:
    """A row for each category of which any key matches: one of the listed values, or with True any value at all."""
    hits = []
    for category, keys in rules.items():
        hit = F.lit(False)
        for key, values in keys.items():
            value = F.col(tags)[key]
            hit = hit | (F.map_contains_key(tags, key) if values is True else F.coalesce(value.isin(list(values)), F.lit(False)))
        hits.append(F.when(hit, F.lit(category)))
    return df.withColumn("category", F.explode(F.array_compact(F.array(*hits))))


def tags_to_columns(df: DataFrame, keys: list[str], tags: str = "tags") -> DataFrame:
    return df.withColumns({k.replace(":", "_"): F.col(tags)[k] for k in keys})


def top_k(df: DataFrame, by: list, k: int) -> DataFrame:
    return df.orderBy(*by).limit(k)


def hilbert_sort(df: DataFrame, lon: str, lat: str, then: list | None = None) -> DataFrame:
    """Rows without a position last, the others along the curve."""
    keyed = df.withColumn("_h", hilbert_index(F.col(lon).cast("double"), F.col(lat).cast("double")))
    return keyed.orderBy(F.asc_nulls_last("_h"), *(then or [])).drop("_h")


def hash_sample(df: DataFrame, keys: list[str], rows: int | None = None, share: float = 1.0, seed: int = 0) -> DataFrame:
    """A sample that any run repeats: rows whose hashed keys lie in a ``share`` of all hashes, of which the ``rows`` with the
    smallest hashes if a number is asked for (equal keys go together into the share, and by the keys' order into the number)."""
    text = F.concat_ws("|", F.lit(str(seed)), *(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys))
    hashed = df.withColumn("_at", F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("bigint"))
    some = hashed.where(F.col("_at") < int(share * (1 << 48)))
    return (some if rows is None else some.orderBy("_at", *keys).limit(rows)).drop("_at")


def union_aligned(sources: dict[str, tuple[DataFrame, dict[str, Column]]], tag: str = "sensor") -> DataFrame:
    """UNION ALL of sources whose columns are first brought to the same names and types; ``tag`` names the source."""
    out = None
    for name, (df, columns) in sources.items():
        part = df.select(*(c.alias(n) for n, c in columns.items()), F.lit(name).alias(tag))
        out = part if out is None else out.unionByName(part)
    return out
