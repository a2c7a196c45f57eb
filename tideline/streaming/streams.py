"""Structured Streaming over folders of arriving Parquet files; each run takes what is new and stops."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.catalog import Catalog
from ..operators.relate import latest
from ..session import hadoop_path


def arrivals(spark: SparkSession, folder: str, schema: StructType, files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def _run(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def ingest(stream: DataFrame, target: str, checkpoint: str, shape: Callable[[DataFrame], DataFrame] = lambda df: df) -> None:
    """Appends newly arrived rows to ``target`` once: each batch writes a folder of its own, over what a failed try left."""

    def write(batch: DataFrame, number: int) -> None:
        shape(batch).write.mode("overwrite").parquet(f"{target}/batch={number}")

    _run(stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start())


def ingest_to(stream: DataFrame, catalog: Catalog, schema: str, table: str, ts: str, checkpoint: str, source: str, shape: Callable[[DataFrame], DataFrame] = lambda df: df) -> None:
    """Registers newly arrived rows as versions of a catalog table, each once.

    ``source`` names the stream, and a batch is committed under its number. A batch that is tried again after its files were written
    but before they were registered writes anew, and the old files belong to no version; one that was registered is left as it is.
    """

    def write(batch: DataFrame, number: int) -> None:
        Catalog(batch.sparkSession, catalog.root).commit(schema, table, shape(batch), ts, f"stream:{source}", f"{number:012d}")

    _run(stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start())


def append_to(df: DataFrame, target: str, checkpoint: str) -> None:
    _run(df.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start())


def without_repeats(stream: DataFrame, keys: list[str], ts: str, delay: str = "1 hour") -> DataFrame:
    """Drops repeats of a key within the watermark, as overlapping look-back windows send them."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def windowed(stream: DataFrame, ts: str, length: str, slide: str | None = None, delay: str = "1 hour", **aggregates) -> DataFrame:
    """Aggregates of tumbling or sliding windows; a window is final once the watermark has passed its end."""
    return stream.withWatermark(ts, delay).groupBy(F.window(ts, length, slide or length).alias("w")).agg(*(c.alias(n) for n, c in aggregates.items()))


def changes_to(df: DataFrame, target: str, checkpoint: str) -> None:
    """Writes the rows of an aggregation that changed, a folder for each batch: state is only kept within the watermark, and a
    batch that failed writes its own folder again and no other."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/changes={number}")

    _run(df.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start())


def latest_changes(spark: SparkSession, target: str, keys: list[str]) -> DataFrame:
    """What ``changes_to`` wrote, of each key as the last batch left it."""
    rows = spark.read.option("basePath", target).parquet(f"{target}/changes=*")
    return latest(rows, keys, ["changes"]).drop("changes")


def _numbers(spark: SparkSession, target: str, kind: str) -> list[int]:
    where, fs = hadoop_path(spark, target)
    names = [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []
    return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{kind}=") and fs.exists(hadoop_path(spark, f"{target}/{n}/_SUCCESS")[0]))


def read_state(spark: SparkSession, target: str, keys: list[str], by: list[str], upto: int | None = None) -> DataFrame:
    """The latest row of each key: the last whole state and the batches since, up to a batch."""
    within = lambda kind: [n for n in _numbers(spark, target, kind) if upto is None or n <= upto]
    base = max(within("state"), default=-1)
    paths = [f"{target}/state={base}"] * (base >= 0) + [f"{target}/changes={n}" for n in within("changes") if n > base]
    return latest(spark.read.parquet(*paths), keys, by)


def latest_state(stream: DataFrame, target: str, checkpoint: str, keys: list[str], by: list[str], every: int = 20) -> None:
    """Keeps the latest row of each key. A batch writes its own latest rows; every ``every`` batches these are merged into a whole
    state, the one before it stays for readers under way, and what is older goes."""

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        latest(batch, keys, by).write.mode("overwrite").parquet(f"{target}/changes={number}")
        if (number + 1) % every:
            return
        read_state(spark, target, keys, by, number).write.mode("overwrite").parquet(f"{target}/state={number}")
        states = [n for n in _numbers(spark, target, "state") if n < number]
        old = [("state", n) for n in states[:-1]] + [("changes", n) for n in _numbers(spark, target, "changes") if states and n <= states[-1]]
        for kind, n in old:
            where, fs = hadoop_path(spark, f"{target}/{kind}={n}")
            fs.delete(where, True)

    _run(stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(merge).start())
