"""Versioned tables over a manifest: a table that lists data files, with what is known of each.

A row says what a version did with a file: ``append`` adds it, ``replace`` adds it and hides all that came before, ``remove`` takes
it away, and ``expired`` only remembers that it was there, so that it is not found anew. ``columns`` is the file's schema, ``stats`` the
bounds and nulls of its columns, ``source`` and ``run`` say which run of which lake or stream brought it, and ``place`` whose place in the
order of arrival a file takes that stands for others.

The operators here are DataFrame queries on a manifest; ``catalog.Catalog`` keeps one on disk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from ..sources.footers import read_footers
from .relate import dedup

STATS = "map<string, struct<lo: string, hi: string, nulls: bigint>>"
MANIFEST = f"schema string, table string, version int, ts timestamp_ntz, path string, bytes bigint, rows bigint, mode string, columns string, stats {STATS}, source string, run string, place string"


def new_files(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files on storage that no version lists."""
    return files.join(manifest.select("path").distinct(), "path", "left_anti")


def register_append(manifest: DataFrame, files: DataFrame, ts: str) -> DataFrame:
    """The manifest with all files that it lacks as one more version of their table. Registering twice adds nothing.

    ``files``: schema, table, path, bytes, rows.
    """
    latest = manifest.groupBy("schema", "table").agg(F.max("version").alias("last"))
    added = new_files(files, manifest).join(latest, ["schema", "table"], "left")
    rows = added.select("schema", "table", (F.coalesce("last", F.lit(0)) + 1).cast("int").alias("version"), F.lit(ts).cast("timestamp_ntz").alias("ts"), "path", "bytes", "rows", F.lit("append").alias("mode"))
    return manifest.unionByName(rows, allowMissingColumns=True)


def register_replace(files: DataFrame, by: str = "ts") -> DataFrame:
    """Of each table only the newest file."""
    return dedup(files, ["schema", "table"], [F.desc(by), F.desc("path")])


def manifest_duplicates(manifest: DataFrame) -> DataFrame:
    """Paths that one version lists more than once."""
    return manifest.groupBy("schema", "table", "version", "path").agg(F.count("*").alias("n")).where("n > 1")


def visible(manifest: DataFrame, version: int | None = None, ts: str | None = None) -> DataFrame:
    """Files of the state at a version or time: since the table's last replacing version, all up to the asked one that no later
    version removed."""
    upto = manifest.where("mode <> 'expired'")
    if version is not None:
        upto = upto.where(F.col("version") <= version)
    if ts is not None:
        upto = upto.where(F.col("ts") <= F.lit(ts).cast("timestamp_ntz"))
    reset = upto.groupBy("schema", "table").agg(F.max(F.when(F.col("mode") == "replace", F.col("version"))).alias("_reset"))
    removed = upto.where("mode = 'remove'").groupBy("schema", "table", "path").agg(F.max("version").alias("_removed"))
    live = upto.where("mode <> 'remove'").join(reset, ["schema", "table"]).where(F.col("version") >= F.coalesce("_reset", F.lit(0)))
    return live.join(removed, ["schema", "table", "path"], "left").where(F.col("_removed").isNull() | (F.col("_removed") < F.col("version"))).select(*manifest.columns)


def arrival() -> Column:
    """The place of a file among those of its table, in the order in which their rows came."""
    return F.coalesce("place", F.format_string("%09d %s", "version", "path"))


def file_changes(manifest: DataFrame, since: int, upto: int | None = None) -> DataFrame:
    """(schema, table, path, change) of the files that one state has and the other has not; files of both hold the same rows."""
    old, new = visible(manifest, version=since), visible(manifest, version=upto)
    keys = ["schema", "table", "path"]
    came = new.select(*keys).distinct().join(old.select(*keys), keys, "left_anti").withColumn("change", F.lit("insert"))
    return came.unionByName(old.select(*keys).distinct().join(new.select(*keys), keys, "left_anti").withColumn("change", F.lit("delete")))


def table_info(manifest: DataFrame) -> DataFrame:
    return manifest.groupBy("schema", "table").agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))


def list_snapshots(manifest: DataFrame, n: int = 20) -> DataFrame:
    return manifest.groupBy("schema", "table", "version").agg(F.max("ts").alias("ts"), F.count("*").alias("files")).orderBy(F.desc("ts"), F.desc("version"), "schema", "table").limit(n)


def expire_versions(manifest: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Without versions older than ``days``; the newest of a table always stays."""
    newest = F.max("version").over(Window.partitionBy("schema", "table"))
    cut = F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {days} DAYS")
    return manifest.withColumn("_newest", newest).where((F.col("ts") >= cut) | (F.col("version") == F.col("_newest"))).drop("_newest")


def orphan_files(files: DataFrame, manifest: DataFrame, as_of: str | None = None, days: int = 7) -> DataFrame:
    """Files that no version lists and, given a time, that are older than ``days``."""
    out = new_files(files, manifest.where("mode <> 'expired'") if "mode" in manifest.columns else manifest)
    return out if as_of is None else out.where(F.col("modified") < F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {days} DAYS"))


def rollback(manifest: DataFrame, to: int, ts: str) -> DataFrame:
    """One more version of each table with the files that were visible at version ``to``."""
    last = manifest.groupBy("schema", "table").agg((F.max("version") + 1).cast("int").alias("version"))
    old = visible(manifest, version=to).drop("version", "ts", "mode").join(last, ["schema", "table"])
    return manifest.unionByName(old.withColumn("ts", F.lit(ts).cast("timestamp_ntz")).withColumn("mode", F.lit("replace")).select(*manifest.columns))


def prune_files(stats: DataFrame, **bounds: tuple) -> DataFrame:
    """Files whose min_C..max_C can overlap the wanted (low, high) of every column C; files without statistics stay."""
    out = stats
    for column, (low, high) in bounds.items():
        lo, hi = F.col(f"min_{column}"), F.col(f"max_{column}")
        out = out.where(lo.isNull() | hi.isNull() | ((lo <= F.lit(high)) & (hi >= F.lit(low))))
    return out


def file_stats(spark: SparkSession, paths: list[str], columns: list[str]) -> DataFrame:
    """path, rows and min_C, max_C of files, from their footers; null where a file does not say."""
    rows = [(f.path, f.rows, *(v for c in columns for v in f.stats.get(c, (None, None))[:2])) for f in read_footers(spark, paths)]
    schema = spark.read.parquet(*paths).schema
    texts = spark.createDataFrame(rows, ", ".join(["path string", "rows bigint", *(f"`{n}_{c}` string" for c in columns for n in ("min", "max"))]))
    return texts.withColumns({f"{n}_{c}": F.col(f"{n}_{c}").cast(schema[c].dataType) for c in columns for n in ("min", "max")})


def may_hold(column: str, kind: DataType, low, high) -> Column:
    """Whether a file's ``stats`` leave room for values of a column from ``low`` to ``high``; a null bound is open. Files that do not
    say stay."""
    lo, hi = (F.col("stats")[column][k].cast(kind) for k in ("lo", "hi"))
    fits = F.lit(True) if high is None else lo.isNull() | (lo <= F.lit(high))
    return fits if low is None else fits & (hi.isNull() | (hi >= F.lit(low)))


def count_from_metadata(manifest: DataFrame) -> DataFrame:
    return visible(manifest).groupBy("schema", "table").agg(F.sum("rows").alias("n_rows"))


def evolve(*parts: DataFrame) -> DataFrame:
    """Union of versions of a table whose columns were added over time; old rows have nulls."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def merged_schema(schemas: list[StructType]) -> StructType:
    """Fields of all versions in the order in which they came; an error where one changes its type."""
    fields: dict[str, StructField] = {}
    for schema in schemas:
        for f in schema:
            if f.name in fields and fields[f.name].dataType != f.dataType:
                raise ValueError(f"column {f.name} changes from {fields[f.name].dataType.simpleString()} to {f.dataType.simpleString()}")
            fields.setdefault(f.name, StructField(f.name, f.dataType))
    return StructType(list(fields.values()))
