"""The training-data pipeline: quality, near copies, benchmark passages, mixture, output.

Every stage takes the documents its predecessor kept, written as Parquet and read again. All
but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from shelfcast.llm import decontaminate, mixing, near_dedup, quality, token_output
from shelfcast.llm.common import recorded, release, stage
from shelfcast.session import scratch_path

SHINGLE = 5  # words; op4_near_dedup by itself has four

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_EARLIER: list[str] = []  # inner tables of the stages before


def _alone(function: Stage) -> Stage:
    """A stage whose documents are written and read again needs none of the inner tables of the
    stages before it: they are removed first, but for those its documents still read from."""

    @wraps(function)
    def call(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(spark, _EARLIER, docs)
        with recorded(_EARLIER):
            return function(spark, docs, sf_dir)

    return call


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@_alone
def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    scored = quality.score_quality(spark, docs, _table(spark, sf_dir, "labels"), whole_rows=True)
    return scored.filter("predicted = 1").select("row.*")


@_alone
def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, by shingles of ``SHINGLE`` words."""
    return near_dedup.distinct_documents(spark, docs, width=SHINGLE)


@_alone
def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean_documents(spark, docs, _table(spark, sf_dir, "benchmark"))


@_alone
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: documents as often as it takes them."""
    return mixing.mixed_documents(spark, docs)


@_alone
def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in training order; one row per sequence."""
    return token_output.write_training_order(spark, docs, scratch_path(spark, "training-order"))


STAGES = [
    ("quality", keep_good),
    ("near_dedup", keep_one_of_each),
    ("decontaminate", without_benchmark),
    ("mix", mix),
    ("tokens", write_tokens),
]

# Models, minwise paths and token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(spark, function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
