"""Small shared helpers: words of a text, hashes of word windows, Arrow plumbing and table access.

Words of the byte kind are found in UTF-8, where every byte of a character beyond ASCII is at least
0x80, so classes over code points become classes over bytes and only ``A-Z`` needs lower-casing.
"""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

#: ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z became a-z.
ALNUM = re.compile(rb"[0-9a-z\x80-\xff]+")

#: Most rows of an Arrow batch, and the setting that says so.
BATCH_ROWS, _ROWS = 1000, "spark.sql.execution.arrow.maxRecordsPerBatch"

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, by any path that Spark's readers open."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def alnum_words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z only) words of letters, digits and everything beyond ASCII; null has none."""
    return ALNUM.findall(utf8(text).lower())


def space_words(text: str | None) -> list[bytes]:
    """Words between the six ASCII white-space characters, unchanged; null has none."""
    return utf8(text).split()


def mix(h: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, element by element."""
    h = (h ^ (h >> _S30)) * _MIX1
    h = (h ^ (h >> _S27)) * _MIX2
    return h ^ (h >> _S31)


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words, the same in every process."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def windows(h: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all windows of ``length`` words, built by doubling: a window of 2k words joins two of k."""
    if len(h) < length:
        return h[:0]
    n = len(h) - length + 1
    size, level, done, at = 1, h, None, 0
    while True:
        if length & size:
            part = level[at : at + n]
            done = part if done is None else mix(done * _GOLDEN + part)
            at += size
        if size * 2 > length:
            return done if length > 1 else mix(done + _GOLDEN)
        level = mix(level[:-size] * _GOLDEN + level[size:] + np.uint64(size))
        size *= 2


def schema_of(ddl: str) -> pa.Schema:
    """The Arrow schema of a Spark DDL schema of flat and list columns."""
    kinds = {"bigint": pa.int64(), "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "float": pa.float32(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}
    fields = []
    for part in re.split(r",\s*(?![^<]*>)", ddl):
        name, kind = part.strip().split(" ", 1)
        inner = re.fullmatch(r"array<(\w+)>", kind)
        fields.append(pa.field(name, pa.list_(kinds[inner[1]]) if inner else kinds[kind]))
    return pa.schema(fields)


@lru_cache(maxsize=1)
def _trim():
    """glibc's ``malloc_trim``; None where the C library has none."""
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def release() -> None:
    """Gives freed memory back to the system: Python workers live on between tasks, beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    if _trim():
        _trim()(0)


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterable[list]], ddl: str) -> DataFrame:
    """``mapInArrow`` for a function that yields lists of columns in the order of ``ddl``.

    Rows hold texts, so the session's Arrow batches are limited to ``BATCH_ROWS`` rows: each exists in the JVM and in Python.
    """
    schema = schema_of(ddl)
    if not 0 < int(df.sparkSession.conf.get(_ROWS)) <= BATCH_ROWS:
        df.sparkSession.conf.set(_ROWS, str(BATCH_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for n, columns in enumerate(fn(batches), 1):
            if n % 16 == 0:
                release()
            yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, f.type) for x, f in zip(columns, schema, strict=True)], schema=schema)
        release()

    return df.mapInArrow(run, ddl)


def slices(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``rows`` rows, so that Python objects of few texts exist at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
