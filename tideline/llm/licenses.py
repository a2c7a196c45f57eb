"""License scans by diagonal voting.

Templates are license texts, notices and short phrases. Every two neighbouring words of a document are one rolling hash, and Spark
joins all of them to the positions that the same pair has in the templates; the words of both are compared in the join,
so that a match is never a collision. Template positions are a table made by tasks, of any size: it is broadcast if it is
of at most ``MOST_CHARS`` characters, else the pairs are shuffled. A match votes for its diagonal, the difference of the
two positions. Votes are summed by diagonal; neighbouring diagonals, as an inserted or missing word leaves them, are merged. A
span is verified by the share of the template's pairs that its diagonals cover, each once.

A base phrase must stand whole: all its pairs on one diagonal. Every such diagonal is one place.

Results of edge cases. Null and empty texts have no words, no place and score 0. Rows that repeat an id, or are equal, are
each reported, as are rows whose doc_id is null. An empty table gives an empty result. The score is the largest verified
share, 1 for a base phrase and 0 without any span; of several spans all labels are given. Texts of any length are read
whole. Columns besides doc_id and text are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .arrays import alnum_words, map_batches, slices, utf8, windows, word_hashes
from .license_texts import BASE, NOTICES, TEXTS

#: Template text, in characters, that is broadcast.
MOST_CHARS = 2_000_000


def pairs_of(text: str | None) -> tuple[int, np.ndarray, list[bytes]]:
    """(number of words, hashes of all pairs of neighbouring words, the pairs)."""
    words = alnum_words(text)
    return len(words), windows(word_hashes(words), 2).view(np.int64), [a + b" " + b for a, b in zip(words, words[1:], strict=False)]


def template_table(spark: SparkSession, base: dict[str, str], notices: dict[str, str]) -> DataFrame:
    """(template, text, is_base, label) of phrases (by phrase) and of notices or texts (by label)."""
    rows = [(f"phrase {k}", t, True, label) for k, (t, label) in enumerate(base.items())] + [(f"text {k}", t, False, label) for k, (label, t) in enumerate(notices.items())]
    return spark.createDataFrame(rows, "template string, text string, is_base boolean, label string")


def positions(templates: DataFrame) -> DataFrame:
    """(hash, pair, template, place, pairs, is_base, label) of every pair of words of every template."""

    def cut(batches):
        for b in slices(batches, 16):
            for name, text, is_base, label in zip(*(b.column(c).to_pylist() for c in ("template", "text", "is_base", "label")), strict=True):
                _, hashes, pairs = pairs_of(text)
                n = len(pairs)
                yield [pa.array(hashes), pairs, [name] * n, pa.array(np.arange(n, dtype=np.int32)), [n] * n, [is_base] * n, [label] * n]

    return map_batches(templates, cut, "hash bigint, pair binary, template string, place int, pairs int, is_base boolean, label string")


def scan(docs: DataFrame, base: dict[str, str] | None = None, notices: dict[str, str] | None = None, share: float = 0.7, drift: int = 3, templates: DataFrame | None = None) -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``share``: pairs of a notice that a span must cover. ``drift``: words by which neighbouring diagonals may differ.
    ``templates``: instead of ``base`` and ``notices`` a table of (template, text, is_base, label), of any size.
    """
    if templates is None:
        templates = template_table(docs.sparkSession, BASE if base is None else base, NOTICES | TEXTS if notices is None else notices)
    known = positions(templates)
    if (templates.agg(F.sum(F.length("text"))).first()[0] or 0) <= MOST_CHARS:
        known = F.broadcast(known)

    def cut(batches):
        # A row's number comes from its content, and among equal rows of a task from their count, so that it is the
        # same when a lost task is run again, whatever the order of its rows.
        task, seen = TaskContext.get().partitionId(), Counter()
        for b in slices(batches):
            uid, at, found, pairs, sizes = [], [], [], [], []
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                n, hashes, ps = pairs_of(text)
                content = xxhash.xxh3_64_intdigest(b"%d " % (-1 if doc is None else doc) + (b"-" if text is None else utf8(text)))
                seen[content] += 1
                number = np.uint64(xxhash.xxh3_64_intdigest(f"{content} {task} {seen[content]}".encode())).astype(np.int64)
                uid.append(np.full(len(ps) + 1, number))
                at.append(np.append(np.arange(len(ps), dtype=np.int32), np.int32(n)))
                found += [hashes, np.array([number])]  # a document's last row holds its number of words
                pairs += [*ps, None]
                sizes.append(len(ps) + 1)
            ids = b.column("doc_id").take(pa.array(np.repeat(np.arange(len(sizes)), sizes)))
            head = np.zeros(sum(sizes), bool)
            head[np.cumsum(sizes) - 1] = True
            yield [pa.array(np.concatenate(uid)), ids, pa.array(np.concatenate(at)), pa.array(np.concatenate(found)), pa.array(pairs, pa.binary()), pa.array(head)]

    flat = map_batches(docs.select("doc_id", "text"), cut, "uid bigint, doc_id bigint, at int, hash bigint, pair binary, head boolean")
    votes = flat.join(known, ["hash", "pair"], "left").where(F.col("head") | F.col("template").isNotNull()).withColumn("place", F.coalesce("place", F.lit(0)))
    diagonals = votes.groupBy("uid", "doc_id", "template", "pairs", "is_base", "label", (F.col("at") - F.col("place")).alias("diagonal")).agg(F.count("*").alias("votes"), F.collect_set("place").alias("places"))
    # Single votes of a long notice are common pairs of words.
    diagonals = diagonals.where(F.col("template").isNull() | (F.col("is_base") & (F.col("votes") == F.col("pairs"))) | (~F.col("is_base") & (F.col("votes") >= 2)))
    run = Window.partitionBy("uid", "template").orderBy("diagonal")
    apart = F.coalesce((F.coalesce("is_base", F.lit(True)) | (F.col("diagonal") - F.lag("diagonal").over(run) > drift)).cast("int"), F.lit(1))
    spans = diagonals.withColumn("apart", apart).withColumn("span", F.sum("apart").over(run))
    covered = spans.groupBy("uid", "doc_id", "template", "span").agg(
        F.first("pairs").alias("pairs"), F.first("is_base").alias("is_base"), F.first("label").alias("label"), F.min("diagonal").alias("start"), F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("covered")
    )
    good = covered.withColumn("part", F.col("covered") / F.col("pairs"))
    based, named = F.col("is_base"), F.col("part") >= share
    out = good.groupBy("uid", "doc_id").agg(
        F.max(F.when(F.col("template").isNull(), F.col("start"))).cast("bigint").alias("n_words"),
        F.count(F.when(based, 1)).alias("n_base"),
        F.min(F.when(based, F.col("start"))).cast("bigint").alias("first_word"),
        F.max(F.when(based, F.col("start"))).cast("bigint").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(based, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set(F.when(named, F.col("label")))), ",").alias("labels"),
        F.coalesce(F.max(F.when(named, F.least(F.lit(1.0), F.col("part")))), F.lit(0.0)).alias("score"),
    )
    return out.drop("uid")
