"""Token counts as rollups that deltas maintain.

A delta is a signed count of one document: an insert adds its tokens, a delete takes them away, and a revised
count takes the old ones and adds the new. A commit sums a batch of deltas by source, language and tokenizer
version and writes the sums as one folder of the ledger, named by the batch. A batch that is there whole is left as
it is, and one that a failure left half is written again, so committing twice is committing once. Totals are the
sums over all batches: they are additive, and no batch is ever read to commit another.

``compact`` sums all batches into one folder that names them, so the ledger stays short; what it names counts as committed.

Results of edge cases. Null sources, languages and versions are groups of their own. Null texts have no tokens and still count
as a document, as do rows that repeat a document or have no doc_id. A group whose documents have all been deleted keeps a row
of zeros. Empty tables and batches add no group. Texts of any length are counted whole. Columns besides those named are ignored.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import hadoop_path, scratch
from .arrays import map_batches, slices

KEYS = ("source", "lang", "tokenizer_version")
WORD = r"[^\x20\x09-\x0D]+"
WORD_OR_MARK = r"[A-Za-z0-9\x{80}-\x{10FFFF}]+|[^A-Za-z0-9\x{80}-\x{10FFFF}\x20\x09-\x0D]"


#: Tokenizers that SQL can say, by version: bytes of UTF-8, words between white space, and runs of letters and digits
#: with every other mark as a token of its own.
VERSIONS = {
    "bytes-1": lambda text: F.octet_length(text),
    "words-1": lambda text: F.regexp_count(text, F.lit(WORD)),
    "words-2": lambda text: F.regexp_count(text, F.lit(WORD_OR_MARK)),
}


def token_counts(docs: DataFrame, versions: tuple[str, ...] = tuple(VERSIONS)) -> DataFrame:
    """(doc_id, source, lang, tokenizer_version, tokens) of every document by every version, in one pass over the texts."""
    text = F.coalesce("text", F.lit(""))
    counted = F.array(*(F.struct(F.lit(v).alias("tokenizer_version"), VERSIONS[v](text).cast("bigint").alias("tokens")) for v in versions))
    return docs.select("doc_id", "source", "lang", F.inline(counted))


def vocabulary_tokens(docs: DataFrame, vocabulary: str, version: str, ranks: str | None = None) -> DataFrame:
    """Tokens by a tokenizer file, as ``packing.encoder`` reads it (and ``ranks``)."""
    from .packing import encoder

    def count(batches):
        encode = encoder(vocabulary, ranks)
        for b in slices(batches, 256):
            yield [b.column("doc_id"), b.column("source"), b.column("lang"), [version] * b.num_rows, [len(encode(t)) if t else 0 for t in b.column("text").to_pylist()]]

    return map_batches(docs.select("doc_id", "source", "lang", "text"), count, "doc_id bigint, source string, lang string, tokenizer_version string, tokens bigint")


def inserts(counts: DataFrame) -> DataFrame:
    return counts.select(*KEYS, F.lit(1).alias("docs"), "tokens")


def deletes(counts: DataFrame) -> DataFrame:
    return counts.select(*KEYS, F.lit(-1).alias("docs"), (-F.col("tokens")).alias("tokens"))


def revisions(old: DataFrame, new: DataFrame) -> DataFrame:
    """The old counts go, the new ones come."""
    return deletes(old).union(inserts(new))


SUMS = "source string, lang string, tokenizer_version string, docs bigint, tokens bigint"


class Ledger:
    """Committed batches of summed deltas under one folder; without one, a scratch folder that goes with the driver."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = (folder or scratch(spark, "ledger")).rstrip("/")

    def _whole(self, kind: str) -> list[str]:
        """Names after ``kind=`` of the folders that have been written to their end."""
        path, fs = hadoop_path(self.spark, self.folder)
        found = sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []
        return [n[len(kind) + 1 :] for n in found if n.startswith(f"{kind}=") and fs.exists(hadoop_path(self.spark, f"{self.folder}/{n}/_SUCCESS")[0])]

    def _base(self) -> tuple[int, list[str]]:
        """(number of the latest compaction, the batches in it); 0 without any."""
        number = max(map(int, self._whole("base")), default=0)
        return number, json.loads(self.spark.read.text(f"{self.folder}/base={number}").first()[0]) if number else []

    def committed(self, batch: str) -> bool:
        return batch in self._base()[1] or batch in self._whole("batch")

    def commit(self, batch: str, deltas: DataFrame) -> bool:
        """Adds a batch; False if it had been committed before, in which case nothing is computed."""
        if self.committed(batch):
            return False
        sums = deltas.groupBy(*KEYS).agg(F.sum("docs").cast("bigint").alias("docs"), F.sum("tokens").cast("bigint").alias("tokens"))
        sums.write.mode("overwrite").parquet(f"{self.folder}/batch={batch}")
        return True

    def _rows(self) -> DataFrame:
        number, merged = self._base()
        paths = [f"{self.folder}/sums={number}"] * bool(number) + [f"{self.folder}/batch={b}" for b in self._whole("batch") if b not in set(merged)]
        return self.spark.read.schema(SUMS).parquet(*paths) if paths else self.spark.createDataFrame([], SUMS)

    def compact(self) -> int:
        """Sums all batches into one folder; how many there are in it. The names are written last, so a failure leaves the
        ledger as it was. Folders merged by the compaction before go, those merged now stay for readers under way."""
        number, before = self._base()
        batches = sorted({*before, *self._whole("batch")})
        self._rows().groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).write.mode("overwrite").parquet(f"{self.folder}/sums={number + 1}")
        self.spark.createDataFrame([(json.dumps(batches),)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.folder}/base={number + 1}")
        for name in [f"batch={b}" for b in before] + [f"{k}={number - 1}" for k in ("base", "sums")] * (number > 1):
            path, fs = hadoop_path(self.spark, f"{self.folder}/{name}")
            fs.delete(path, True)
        return len(batches)

    def totals(self) -> DataFrame:
        """source, lang, tokenizer_version, n_docs, n_tokens over all committed batches."""
        return self._rows().groupBy(*KEYS).agg(F.sum("docs").alias("n_docs"), F.sum("tokens").alias("n_tokens"))
