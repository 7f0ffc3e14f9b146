"""The corpus pipeline: stages over the documents table, each written and read again.

Language identification, near-duplicate removal, benchmark decontamination, mixing
to target weights, token files. All stages but the last return the columns of
``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.decontaminate import decontaminate
from plumbline.llm.language_id import UNDETERMINED, has_letters, identify_languages, learn
from plumbline.llm.mixing import domains_of_labels, mix, mixed_documents
from plumbline.llm.near_dedup import near_duplicates
from plumbline.llm.storage import small_side, stored
from plumbline.llm.token_files import encode_documents

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

SURE = 0.5
WINDOW = 10
MIX_WEIGHTS = {"good": 0.9, "poor": 0.07, "toxic": 0.03}


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts whose language cannot be told go: null, without letters, or no surer than a coin at some duel.

    A score is the weakest duel won, times levels, so below ``SURE`` one of them was a draw at best.
    """
    model = learn(docs)
    if not model.families:  # all are undetermined then, which says nothing about a text
        return docs.filter(has_letters(F.col("text")))
    found = identify_languages(docs, model, marked=True)
    return _without(docs, found.filter((F.col("lang_pred") == UNDETERMINED) | (F.col("score") < SURE)))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at 80 %, the one with the smallest id stays."""
    found = near_duplicates(docs, k=5, percent=80, marked=True).filter(~F.col("kept"))
    return _once(_without(docs, found))


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate(docs, benchmark, window=WINDOW, marked=True).filter("n_hit > 0")
    return _without(docs, found)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by their mixing rate: rare domains once, often or not at all, in proportion to the rate."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return mixed_documents(docs, mix(docs, domains_of_labels(labels), MIX_WEIGHTS))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of what is left, read back; workers remember less than they could, executors are full by then."""
    return encode_documents(docs, limit=60_000, slice_bytes=512 << 10)


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows but those gone, told by id and text: null and repeated ids hold other documents too."""
    gone = stored(gone.select(F.col("doc_id").alias("gone_id"), F.col("mark").alias("gone_mark")).distinct(), "gone")
    same = docs.doc_id.eqNullSafe(F.col("gone_id")) & (F.xxhash64(docs.text) == F.col("gone_mark"))
    return docs.join(small_side(gone), same, "left_anti")


def _once(docs: DataFrame) -> DataFrame:
    """Rows repeated in id and text only once; whole texts move only where ids repeat."""
    repeated = docs.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("repeated_id")).count()
    repeated = stored(repeated.filter("count > 1").select("repeated_id"), "repeated")
    if repeated.isEmpty():
        return docs
    same = docs.doc_id == F.col("repeated_id")
    alone = docs.join(small_side(repeated), same, "left_anti")
    return alone.union(docs.join(small_side(repeated), same, "left_semi").dropDuplicates(["doc_id", "text"]))


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("near_copies", near_copies),
    ("benchmark_passages", benchmark_passages),
    ("mixture", mixture),
    ("tokens", tokens),
]

#: The classifiers and the tokenizer cannot be written as SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
