"""A training corpus from raw documents: five stages, each on what the one before kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes each
result to the shared folder as Parquet and gives the next stage what it reads back. All
but the last return the columns of ``documents``. A stage that begins removes the
intermediate tables of the one before, whose result is stored by then.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from breachscope.llm import decontamination, jaccard, language, line_dedup, packing
from breachscope.llm.queries import table, tokenizer_path
from breachscope.session import release, settle, work

_WORK = "corpus_pipeline"

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

# Below this calibrated probability a text is in none of the languages learnt.
LEAST_SCORE = 0.5


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def stage(function: Stage) -> Stage:
    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with work(spark, _WORK, docs):
            return function(spark, docs, sf_dir)

    return run_stage


@stage
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learnt; the label is not changed."""
    predicted = language.predict(docs, language.fit(docs, ~language.held_out()))
    known = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    return predicted.where(known).select(*COLUMNS)


@stage
def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, less the lines that another occurrence stands for."""
    short = line_dedup.deduplicate_lines(docs)
    return short.withColumn("n_chars", F.char_length("text").cast("bigint")).select(*COLUMNS)


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a number for each row in ``_row``: ids may be null or repeated.
    Written, so that every reader sees the same numbers."""
    return settle(docs.withColumn("_row", F.monotonically_increasing_id()))


def _by_row(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("_row").alias("doc_id"), "text")


@stage
def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of each group of near copies, one row of those that
    share it; a null id comes last."""
    rows = _numbered(docs)
    found = settle(jaccard.jaccard_components(_by_row(rows)).select(F.col("doc_id").alias("_of"), "component_id"))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.xxhash64("text").alias("body"), "_row")
    first = (
        rows.select("doc_id", "text", "_row")
        .join(found, F.col("_row") == F.col("_of"))
        .groupBy("component_id")
        .agg(F.min(order).alias("first"))
        .select(F.col("first._row").alias("_kept"))
    )
    return rows.join(first, F.col("_row") == F.col("_kept"), "left_semi").select(*COLUMNS)


@stage
def remove_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item occurs."""
    rows = _numbered(docs)
    found = settle(decontamination.leaks(_by_row(rows), table(spark, sf_dir, "benchmark")))
    return decontamination.without_leaks(rows, found, "_row").select(*COLUMNS)


@stage
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training sequences: their token ids, as little-endian unsigned
    16-bit numbers, and the checksum of these."""
    return packing.wide_crc(packing.pack(docs, tokenizer_path()), keep_ids=True)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", remove_repeated_lines),
    ("jaccard_join", remove_near_copies),
    ("decontamination", remove_benchmarks),
    ("packing", pack_sequences),
]

# Neither the classifier nor the tokenizer can be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, step in STAGES:
        before, docs = docs, settle(step(spark, docs, sf_dir))
        release(before)
    with work(spark, _WORK):
        return docs
