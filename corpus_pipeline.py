"""A training corpus from raw documents: language, exact copies, near copies, personal data, packing.

Each stage is a function (spark, docs, sf_dir) -> DataFrame and works on all rows that the stage
before kept; all but the last return the columns of ``documents``. ``run`` writes every stage as
Parquet to the shared scratch folder and reads it again for the next. When a stage begins, the scratch tables of the
stages before are deleted, as their results have been written. Stages that hand whole texts to Python in their last
step write it themselves, as small batches hold only while a step runs.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.exact_dedup import drop_exact_copies
from shelfwise.llm.lang_id import UNDETERMINED, fit, held_out, predicted
from shelfwise.llm.memory import text_batches
from shelfwise.llm.ngram_join import drop_near_copies
from shelfwise.llm.packing import pack_documents
from shelfwise.llm.pii import with_surrogates
from shelfwise.llm.settings import SURROGATE_KEY, bpe_file
from shelfwise.session import drop_scratch, materialize, scratch_scope

#: Below this score no language holds a fifth of the letters with any certainty.
LEAST_SCORE = 0.2


def _in_small_batches(stage: Callable) -> Callable:
    """The stage run to its end, and written, with small batches of texts."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with text_batches(spark):
            return materialize(stage(spark, docs, sf_dir), "stage")

    return run


@_in_small_batches
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a determined language; those without letters or without a leading language go.

    Nothing else goes: short, mixed and shouted texts stay. If no document has a language to learn
    from, every document is undetermined and goes.
    """
    model = fit(docs.filter(~held_out()))
    found = predicted(F.col("text"), model)
    rows = docs.select(F.struct("*").alias("row"), found.alias("found"))
    return rows.filter((F.col("found.lang_pred") != UNDETERMINED) & (F.col("found.score") >= LEAST_SCORE)).select("row.*")


@_in_small_batches
def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, that with the largest id."""
    return drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by similar word shingles, that with the smallest id."""
    return drop_near_copies(docs)


@_in_small_batches
def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for the personal data; n_chars follows the text."""
    out = with_surrogates(docs, SURROGATE_KEY)
    changed = F.when(F.size("entities") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", changed).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces with their places in training sequences of 1024 tokens."""
    return pack_documents(docs, bpe_file(), keep_vocabulary=False)


def _scoped(name: str, stage: Callable) -> Callable:
    """The stage with scratch tables of its own, after those of the other stages are deleted."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for other in NAMES:
            drop_scratch(spark, _scope(other))
        with scratch_scope(_scope(name)):
            return stage(spark, docs, sf_dir)

    return run


def _scope(name: str) -> str:
    return f"stage-{name.replace(' ', '-')}"


_STAGES = {"language": language, "exact copies": exact_copies, "near copies": near_copies, "personal data": personal_data, "packing": packing}
NAMES = list(_STAGES)
STAGES = [(name, _scoped(name, stage)) for name, stage in _STAGES.items()]

#: Identification, surrogates and packing are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
