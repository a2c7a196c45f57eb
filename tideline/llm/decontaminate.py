"""Benchmark decontamination by Wu-Manber search over words.

The test strings are the windows of the benchmark texts. As in Wu-Manber, a shift table over blocks says how
far the search may jump, blocks that end a string select a bucket of strings, and only those are
compared. The alphabet is words: a block is two neighbouring words, and most blocks of a document occur
in no string, so the search looks at about every ninth word for windows of ten.

Tables have a fixed size whatever the benchmark's: blocks are hashed to ``SLOTS`` places for each length of windows, of
which each holds the least shift of its blocks, and a table of ``BITS`` bits tells most windows that are none
of the strings. Both only ever let too much through. They are built inside tasks and are all that is broadcast (at
most 2 MB for each of up to ten lengths, and 8 MB). What passes is joined by Spark to the bucket of its suffix hash, and
the join compares the words. So documents are read once, and the benchmark may be of any size.

Results of edge cases. Null texts have no words. An item without words has no window. An item whose id is null is not
searched. Repeated item rows count once; repeated document rows and rows whose doc_id is null are each reported. Texts of
any length are searched whole. An empty table of documents gives an empty result, an empty benchmark no hit. Columns
besides those named are ignored, those to ``carry`` may have any name.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import alnum_words, map_batches, slices, utf8
from .tables import written

#: Places of a shift table (bytes), and bits of the table of whole windows; powers of two.
SLOTS, BITS = 1 << 21, 1 << 26
#: Parts of these tables that one task merges.
FAN = 8

_hash = xxhash.xxh3_64_intdigest


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def _block(words: list[bytes], i: int, length: int) -> int:
    """Hash of the block that ends at word i of a window of ``length``."""
    return _hash(words[i]) if length == 1 else _hash(words[i - 1] + b" " + words[i])


def strings_of(benchmark: DataFrame, window: int) -> DataFrame:
    """(length, suffix, words, items) of every distinct window of the benchmark; an item shorter than ``window`` is one."""

    def cut(batches):
        for b in slices(batches, 64):
            for item, text in zip(b.column("item_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                words = alnum_words(text)
                n = min(window, len(words))
                ends = range(n - 1, len(words)) if n else ()
                yield [[n] * len(ends), [_signed(_block(words, i, n)) for i in ends], [b" ".join(words[i - n + 1 : i + 1]) for i in ends], [item] * len(ends)]

    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where("item_id is not null and text is not null")
    rows = map_batches(items, cut, "length int, suffix bigint, words binary, item_id string")
    return rows.groupBy("length", "suffix", "words").agg(F.collect_set("item_id").alias("items"))


def search_tables(strings: DataFrame, slots: int, bits: int) -> tuple[dict[int, bytes], bytes]:
    """({length: shift table}, bits of whole windows): made in parts, of which a task merges about ``FAN`` into one, again and again."""
    kinds = "length int, cells binary"

    def part(batches):
        shift: dict[int, np.ndarray] = {}
        seen = np.zeros(bits // 8, np.uint8)
        for b in slices(batches):
            for n, text in zip(b.column("length").to_pylist(), b.column("words").to_pylist(), strict=True):
                words, block = text.split(b" "), min(2, n)
                cells = shift.setdefault(n, np.full(slots, n - block + 1, np.uint8))
                for end in range(block - 1, n):
                    at = _block(words, end, n) % slots
                    cells[at] = min(cells[at], n - 1 - end)
                at = _hash(text) % bits
                seen[at >> 3] |= 1 << (at & 7)
        for n, cells in [*shift.items(), (0, seen)]:
            yield [[n], [cells.tobytes()]]

    def merge(batches):
        out: dict[int, np.ndarray] = {}
        for b in slices(batches, 1):
            n, cells = b.column("length")[0].as_py(), np.frombuffer(b.column("cells")[0].as_py(), np.uint8)
            out[n] = cells if n not in out else (np.minimum if n else np.bitwise_or)(out[n], cells)
        for n, cells in out.items():
            yield [[n], [cells.tobytes()]]

    parts = map_batches(strings.select("length", "words"), part, kinds)
    n = strings.rdd.getNumPartitions()
    while n > 1:
        n = -(-n // FAN)
        parts = map_batches(parts.repartition(n), merge, kinds)
    cells = {r.length: bytes(r.cells) for r in parts.collect()}
    return {n: c for n, c in sorted(cells.items()) if n}, cells.get(0, bytes(bits // 8))


def occurrences(words: list[bytes], shift: dict[int, bytes], seen: bytes):
    """(start, length, suffix, window) of the places that the tables let through."""
    last = 8 * len(seen) - 1
    for length, cells in shift.items():
        mask, i = len(cells) - 1, length - 1
        while i < len(words):
            suffix = _block(words, i, length)
            jump = cells[suffix & mask]
            if jump:
                i += jump
                continue
            window = b" ".join(words[i - length + 1 : i + 1])
            at = _hash(window) & last
            if seen[at >> 3] >> (at & 7) & 1:
                yield i - length + 1, length, _signed(suffix), window
            i += 1


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, carry: tuple[str, ...] = (), slots: int = SLOTS, bits: int = BITS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, item_ids (sorted as strings), hit_words (positions) and the columns to ``carry``."""
    strings = written(strings_of(benchmark, window), "strings")
    shared = docs.sparkSession.sparkContext.broadcast(search_tables(strings, slots, bits))

    def scan(batches):
        shift, seen = shared.value
        for b in slices(batches):
            n_words, keys, places = [], [], []
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                words = alnum_words(text)
                n_words.append(len(words))
                places.append(list(zip(*occurrences(words, shift, seen), strict=True)) or [(), (), (), ()])
                keys.append(f"{doc}:{hashlib.md5(utf8(text)).hexdigest()}" if places[-1][0] else None)
            yield [b.column("doc_id"), n_words, keys, *(pa.array([p[k] for p in places], pa.list_(t)) for k, t in enumerate((pa.int32(), pa.int32(), pa.int64(), pa.binary()))), *(b.column(f"_{c}") for c in carry)]

    kinds = dict(docs.dtypes)
    carried = "".join(f", _{c} {kinds[c]}" for c in carry)
    found = map_batches(docs.select("doc_id", "text", *(F.col(c).alias(f"_{c}") for c in carry)), scan, "doc_id bigint, n_words bigint, key string, start array<int>, length array<int>, suffix array<bigint>, words array<binary>" + carried)
    found = written(found, "searched")

    places = found.where("key is not null").select("key", F.inline(F.arrays_zip("start", "length", "suffix", "words"))).distinct()
    hits = places.join(strings, ["length", "suffix", "words"]).select("key", F.sequence("start", F.col("start") + F.col("length") - 1).alias("at"), "items")
    merged = lambda lists: F.array_sort(F.array_distinct(F.flatten(lists)))
    hits = hits.groupBy("key").agg(merged(F.collect_list("at")).alias("hit_words"), merged(F.collect_set("items")).alias("item_ids"))

    rest = [F.col(f"_{c}").alias(c) for c in carry]
    none = lambda kind: F.array().cast(f"array<{kind}>")
    clean = found.where("key is null").select("doc_id", "n_words", F.lit(0).cast("bigint").alias("n_hit"), none("string").alias("item_ids"), none("int").alias("hit_words"), *rest)
    marked = found.where("key is not null").join(hits, "key", "left").withColumns({"item_ids": F.coalesce("item_ids", none("string")), "hit_words": F.coalesce("hit_words", none("int"))})
    return clean.union(marked.select("doc_id", "n_words", F.size("hit_words").cast("bigint").alias("n_hit"), "item_ids", "hit_words", *rest))


def digest(found: DataFrame) -> DataFrame:
    """The columns of query op4 from what ``decontaminate`` returns."""
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("item_ids"), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
