"""What Parquet files say of themselves in their last bytes: rows, columns and bounds of columns. No data is read."""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import SparkSession

from ..session import hadoop_path

#: Bytes read at first; a longer footer takes a second read.
TAIL = 1 << 16
#: Bounds of longer texts are not kept.
LONGEST = 64


@dataclass
class Footer:
    """``path`` as Hadoop writes it, ``columns`` as Spark's schema in JSON (null for files of other writers), and of each flat
    column (least, greatest, nulls) as texts that a cast reads back; columns without known bounds are left out."""

    path: str
    bytes: int
    rows: int
    columns: str | None
    stats: dict[str, tuple[str | None, str | None, int]] = field(default_factory=dict)


def _tail(spark: SparkSession, path: str) -> tuple[str, int, bytes]:
    where, fs = hadoop_path(spark, path)
    status = fs.getFileStatus(where)
    size, n = status.getLen(), TAIL
    while True:
        stream = fs.open(where)
        try:
            stream.seek(max(0, size - n))
            data = bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream, min(size, n)))
        finally:
            stream.close()
        needed = int.from_bytes(data[-8:-4], "little") + 8
        if needed <= n or n >= size:
            return status.getPath().toString(), size, data
        n = needed


def _text(value) -> str | None:
    """A bound as text, None where it cannot be kept."""
    if value is None or isinstance(value, bytes):
        return None
    text = str(value)
    return text if len(text) <= LONGEST else None


def _nullable(schema):
    """A schema in JSON as readers see it: any value may be missing."""
    if isinstance(schema, dict):
        return {k: True if k in ("nullable", "containsNull", "valueContainsNull") else _nullable(v) if k != "metadata" else v for k, v in schema.items()}
    return [_nullable(v) for v in schema] if isinstance(schema, list) else schema


def parse(path: str, size: int, data: bytes) -> Footer:
    meta = pq.read_metadata(pa.BufferReader(data))
    spark_schema = (meta.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
    out = Footer(path, size, meta.num_rows, json.dumps(_nullable(json.loads(spark_schema))) if spark_schema else None)
    least, greatest, nulls, unknown = {}, {}, {}, set()
    for g in range(meta.num_row_groups):
        group = meta.row_group(g)
        for c in range(group.num_columns):
            column = group.column(c)
            name, s = column.path_in_schema, column.statistics
            if "." in name or s is None or not s.has_null_count:
                unknown.add(name)
                continue
            nulls[name] = nulls.get(name, 0) + s.null_count
            if s.null_count == group.num_rows:
                continue
            if not s.has_min_max or _text(s.min) is None or _text(s.max) is None:
                unknown.add(name)
                continue
            least[name] = min(least.get(name, s.min), s.min)
            greatest[name] = max(greatest.get(name, s.max), s.max)
    out.stats = {n: (_text(least.get(n)), _text(greatest.get(n)), k) for n, k in nulls.items() if n not in unknown}
    return out


def read_footers(spark: SparkSession, paths: list[str], threads: int = 16) -> list[Footer]:
    """The footers of files on any store that Spark reads; the driver holds what it is to register anyway, a row a file."""
    with ThreadPoolExecutor(threads) as pool:
        return [parse(*t) for t in pool.map(lambda p: _tail(spark, p), paths)]
