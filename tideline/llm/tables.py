"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import scratch


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, read again: cuts lineage and survives lost executors.

    The table goes when ``session.clear_scratch`` is called or the driver's JVM ends.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
