"""Sources: files and small in-memory rows as DataFrames. Schemas are explicit; inference only where none is given."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..session import hadoop_path


def scan_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)


def scan_hive(spark: SparkSession, base: str, predicate: Column | str | None = None, glob: str = "") -> DataFrame:
    """A partitioned folder: partition values become columns, and a predicate on them prunes folders."""
    df = spark.read.option("basePath", base).parquet(f"{base}/{glob}" if glob else base)
    return df if predicate is None else df.where(predicate)


def scan_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, line_breaks: bool = False) -> DataFrame:
    """CSV with a header, quoted and escaped by the double quote. With ``line_breaks`` values may hold some; then a file cannot be split."""
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", line_breaks)
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)


def scan_json_doc(spark: SparkSession, paths: str | list[str], schema: StructType | str | None = None) -> DataFrame:
    """Whole JSON documents, one or several pages."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(paths)


def scan_ndjson(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).json(path)


def read_any(spark: SparkSession, path: str, **options) -> DataFrame:
    """By extension: parquet, csv, json (documents), ndjson or jsonl (lines)."""
    kinds: dict[str, Callable] = {"parquet": scan_parquet, "csv": scan_csv, "json": scan_json_doc, "ndjson": scan_ndjson, "jsonl": scan_ndjson}
    kind = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if kind not in kinds:
        raise ValueError(f"no reader for {path!r}")
    return kinds[kind](spark, path, **options)


def list_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """(path, bytes, modified) of files under a folder; contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    return found.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def scan_latest_partition(spark: SparkSession, path: str, column: str) -> DataFrame:
    """Only the greatest value of a partition column (as text), which stays as a column. Finding it lists the folders of one
    level, and no other value's files are listed or opened."""
    where, fs = hadoop_path(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory()]
    names = [n for n in names if n.startswith(f"{column}=")]
    if not names:
        raise ValueError(f"no folder {column}=... under {path}")
    return spark.read.option("basePath", path).parquet(f"{path}/{max(names, key=unquote)}")


def rows_to_table(spark: SparkSession, rows: list[tuple], schema: StructType | str) -> DataFrame:
    """Small reference data such as lookups, as an Arrow table: it takes no Python worker to read."""
    kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(kind)
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)] if rows else [pa.array([], f.type) for f in arrow]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow), kind)


def generate(spark: SparkSession, n: int, seed: int = 0) -> DataFrame:
    """Synthetic rows: id, zero-padded labels, a class by remainder and two random columns."""
    ids = spark.range(n)
    return ids.select(
        "id",
        F.format_string("%06x", "id").alias("code"),
        F.format_string("item_%04d", "id").alias("name"),
        F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b").otherwise("c").alias("kind"),
        (F.rand(seed) * 180 - 90).alias("lat"),
        (F.rand(seed + 1) * 360 - 180).alias("lon"),
    )


def limited(df: DataFrame, n: int, order: list) -> DataFrame:
    """The first n rows in a total order, for trials."""
    return df.orderBy(*order).limit(n)


def union_tolerant(readers: Iterable[tuple[str, Callable[[], DataFrame]]]) -> tuple[DataFrame, dict[str, str]]:
    """(union of the sources that can be read, {name: error} of the others); an error if none can.

    Building a file source lists files and reads a schema, so a missing or broken one fails here.
    """
    good, skipped = [], {}
    for name, read in readers:
        try:
            df = read()
            df.schema  # noqa: B018  a broken source fails here
            good.append(df)
        except Exception as error:
            skipped[name] = str(error).splitlines()[0]
    if not good:
        raise ValueError(f"no source could be read: {skipped}")
    out = good[0]
    for df in good[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out, skipped
