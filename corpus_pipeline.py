"""The corpus pipeline: five stages, each reading what the one before kept.

1. ``language``: documents whose language is unknown (no letter) or not told with more than ``LEAST_SCORE`` go;
   ``lang`` is kept where it was given and filled with the predicted one where it was null.
2. ``near_duplicates``: of each group of near-duplicates the document with the smallest id stays.
3. ``substrings``: passages of ``SPAN`` words or more that also start in a document of a smaller id are cut out; a
   document that loses all its words goes. ``n_chars`` follows the text.
4. ``benchmark``: documents that hold ten consecutive words of a benchmark item go.
5. ``packing``: what is left is packed into sequences of tokens; the rows are pieces.

Rows whose doc_id is null and rows that share a doc_id are documents of their own: stage 2 judges them by a key of 64
hashed bits, after documents with an id, and keeps rows of the same id and text once. Of an id's texts the first keeps
the id's place. Stage 3 takes passages from no row without an id, nor from one row of an id what another one has.

An empty table gives empty stages. Null, empty and blank texts go in stage 1; texts of any length are read whole. Columns
besides those of documents are dropped, whatever their names. Every stage may be run on its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import decontaminate, language, neardup, packing, substrings
from tideline.llm.queries import ranks, vocabulary
from tideline.llm.tables import written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: A language counts as told from this share of a text's letters on.
LEAST_SCORE = 0.4

#: Words in the shortest repeated passage that goes.
SPAN = 13


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    found = language.identify(docs, language.train(docs), carry=("text", "lang", "source", "n_chars"))
    told = found.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE))
    return told.select("doc_id", "text", F.coalesce("lang", "lang_pred").alias("lang"), "source", "n_chars")


def keyed(docs: DataFrame) -> DataFrame:
    """Rows with a ``key`` of their own: the id, but a hash above all usual ids for rows without one and for further texts
    under one id. Rows of the same id and text are one."""
    if docs.groupBy("doc_id").count().where("count > 1 or doc_id is null").isEmpty():
        return docs.withColumn("key", F.col("doc_id"))
    texts = written(docs.groupBy("doc_id", "text").agg(F.min(F.struct("lang", "source", "n_chars")).alias("first")).select("doc_id", "text", "first.*"), "texts")
    clashing = texts.where("doc_id is not null").groupBy("doc_id").agg(F.min("text").alias("least"), F.count("*").alias("n")).where("n > 1").drop("n")
    other = F.col("doc_id").isNull() | (F.col("least").isNotNull() & ~F.col("text").eqNullSafe(F.col("least")))
    hashed = F.lit(1 << 62) + F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 62))
    return written(texts.join(clashing, "doc_id", "left").select(*COLUMNS, F.when(other, hashed).otherwise(F.col("doc_id")).alias("key")), "documents")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = keyed(docs.select(*COLUMNS))
    gone = neardup.near_duplicates(docs.select(F.col("key").alias("doc_id"), "text")).where("not kept").select(F.col("doc_id").alias("key"))
    return docs.join(gone, "key", "left_anti").select(*COLUMNS)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = substrings.remove_repeats(docs, SPAN, keep_text=True, carry=("lang", "source", "n_chars"))
    n_chars = F.when(F.col("n_removed") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return cut.where("n_removed < n_words").select("doc_id", "text", "lang", "source", n_chars.alias("n_chars"))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.decontaminate(docs, benchmark, carry=("text", "lang", "source", "n_chars"))
    return found.where("n_hit = 0").select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, vocabulary(), ranks())


STAGES = [
    ("language", by_language),
    ("near_duplicates", near_duplicates),
    ("substrings", without_repeats),
    ("benchmark", without_benchmark),
    ("packing", packed),
]

#: The field of stage 1 and the tokens of stage 5 are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
