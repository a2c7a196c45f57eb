"""Session settings and scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: Settings that the operators assume: naive UTC timestamps, runtime re-planning, compressed output.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(master: str = "local[*]", partitions: int | None = None, **more: str) -> SparkSession:
    """A session with the settings above; ``partitions`` sets the number of shuffle partitions."""
    builder = SparkSession.builder.master(master).appName("tideline")
    settings = SETTINGS | more | ({"spark.sql.shuffle.partitions": str(partitions)} if partitions else {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which driver and executors share. Where it is unset a temporary one is set, on a
    local master only: elsewhere executors could not see it."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="tideline-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def hadoop_path(spark: SparkSession, path: str):
    """(Path, FileSystem) of a path, on whatever store it is."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


_SCRATCH: list[str] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed by ``clear_scratch`` or when the driver's JVM ends."""
    path = f"{shared_folder(spark)}/tideline-{name}-{uuid.uuid4().hex}"
    where, fs = hadoop_path(spark, path)
    fs.deleteOnExit(where)
    _SCRATCH.append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Removes the intermediate tables made so far; for drivers that live long, once their results are written. How many there were."""
    paths, _SCRATCH[:] = list(_SCRATCH), []
    for path in paths:
        where, fs = hadoop_path(spark, path)
        fs.delete(where, True)
        fs.cancelDeleteOnExit(where)
    return len(paths)
