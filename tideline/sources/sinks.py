"""Sinks: compressed Parquet, with points as WKB and bounds, sorted along the Hilbert curve where asked."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.spatial import hilbert_index, wkb_point
from ..operators.quality import Watched
from ..session import hadoop_path


def write_table(df: DataFrame, *roots: str, sort: list | None = None, on_empty: str = "write", rows_per_file: int = 0, mode: str = "error") -> bool:
    """Writes to every root; False if there was nothing to write and ``on_empty`` is "skip".

    An empty table is otherwise written with its schema. With several roots the first is written and copied from, so that all hold the
    same rows even where the input would not be the same if computed again.
    """
    if on_empty == "skip" and df.isEmpty():
        return False
    if sort:
        df = df.repartitionByRange(*sort).sortWithinPartitions(*sort)
    for k, root in enumerate(roots):
        if k:
            df = df.sparkSession.read.schema(df.schema).parquet(roots[0])
        writer = df.write.mode(mode).option("compression", "zstd").option("parquet.compression.codec.zstd.level", "15")
        (writer.option("maxRecordsPerFile", rows_per_file) if rows_per_file else writer).parquet(root)
    return True


def write_checked(df: DataFrame, path: str, spec: dict, **options) -> DataFrame:
    """Writes a table and reports its checks (``quality.check``'s), which the same job computes while it writes."""
    watched = Watched(df, spec)
    write_table(watched.df, path, **options)
    return watched.report(df.sparkSession.read.schema(df.schema).parquet(path))


def with_geometry(df: DataFrame, lon: str, lat: str) -> DataFrame:
    """Adds ``geometry`` (WKB) and bounds ``xmin ymin xmax ymax``, whose file statistics let readers skip."""
    x, y = F.col(lon).cast("double"), F.col(lat).cast("double")
    return df.withColumns({"geometry": wkb_point(x, y), "xmin": x, "ymin": y, "xmax": x, "ymax": y})


def write_geo(df: DataFrame, path: str, lon: str, lat: str, cluster: bool = False, then: list | None = None, **options) -> bool:
    """A table with points; with ``cluster`` in the order of the Hilbert curve, then of ``then``."""
    out = with_geometry(df, lon, lat)
    if not cluster:
        return write_table(out, path, **options)
    keyed = out.withColumn("_h", hilbert_index(F.col(lon).cast("double"), F.col(lat).cast("double")))
    return write_table(keyed.repartitionByRange("_h").sortWithinPartitions("_h", *(then or [])).drop("_h"), path, **options)


def write_all(tables: dict[str, DataFrame], root: str, run: str, schema: str = "main", **options) -> dict[str, str]:
    """One folder for each table, ``root/schema/table/run``: {name: path} of those written."""
    out = {}
    for name, df in tables.items():
        path = f"{root}/{schema}/{name}/{run}"
        if write_table(df, path, **options):
            out[name] = path
    return out


def write_split(df: DataFrame, root: str, run: str, by: str, schema: str = "main", sort: list | None = None) -> dict[str, str]:
    """One table with a text column ``by`` as a table for each of its values, ``root/schema/value/run``, by a single job: {value: path}.

    The job writes folders of a staging area, which are then moved to their places. Rows whose ``by`` is null or no name of a folder are an error.
    """
    spark = df.sparkSession
    stage = f"{root}/_staging-{uuid.uuid4().hex}"
    rows = df.withColumn("_split", F.col(by)).drop(by)
    rows = rows.repartitionByRange("_split", *(sort or [])).sortWithinPartitions("_split", *(sort or []))
    rows.write.partitionBy("_split").option("compression", "zstd").option("parquet.compression.codec.zstd.level", "15").parquet(stage)
    where, fs = hadoop_path(spark, stage)
    found = {s.getPath().getName().removeprefix("_split="): s.getPath() for s in fs.listStatus(where) if s.isDirectory()}
    odd = [n for n in found if not re.fullmatch(r"\w[\w.-]*", n) or n == "__HIVE_DEFAULT_PARTITION__"]
    if odd:
        fs.delete(where, True)
        raise ValueError(f"no names of tables: {', '.join(sorted(odd))}")
    out = {}
    for name, path in found.items():  # a folder a table
        to, _ = hadoop_path(spark, f"{root}/{schema}/{name}/{run}")
        fs.mkdirs(to.getParent())
        if fs.exists(to) or not fs.rename(path, to):
            raise ValueError(f"{to.toString()} is there already")
        out[name] = f"{root}/{schema}/{name}/{run}"
    fs.delete(where, True)
    return out
