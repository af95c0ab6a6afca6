"""Corpus pipeline: language ID, line dedup, near-duplicate removal, benchmark
decontamination, packing; and the registry of the training-data queries.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``.  All but the last return
the columns of ``documents``; a stage reads those columns of its input only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkiln.llm import (
    brown_lm, collocations, decontamination, language_id, line_dedup, minhash, packing,
    quality_classifier, quality_rules, sharding, suffix_dedup, url_filters, whitening,
)
from sparkiln.llm.columns import NON_BLANK
from sparkiln.llm.tables import load_table, materialize, ship_package

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
MIN_KNOWN = 0.55
NEAR_WORDS, NEAR_PERCENT = 5, 80


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps texts whose language is known: those with a letter whose n-grams
    are those of a learned language.  Learns from all rows with a label."""
    docs = docs.select(*COLUMNS)
    return language_id.keep_known(docs, language_id.train(docs), MIN_KNOWN)


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated three-line windows; a document that loses its last line
    with a word goes."""
    cut = line_dedup.dedup_lines(docs.select(*COLUMNS), carry=["lang", "source", "n_chars"])
    left = cut.where((F.col("n_removed") == 0) | F.col("text").rlike(NON_BLANK))
    n_chars = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", n_chars.cast("long")).select(*COLUMNS)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return minhash.keep_one(docs.select(*COLUMNS), NEAR_WORDS, NEAR_PERCENT).select(*COLUMNS)


def remove_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.remove_leaks(
        docs.select(*COLUMNS), load_table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 1024 tokens."""
    return packing.pack_documents(docs.select(*COLUMNS))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", remove_repeated_lines),
    ("minhash_dedup", remove_near_copies),
    ("decontamination", remove_benchmark_leaks),
    ("packing", pack_sequences),
]

#: Classifier, components and tokens have no SQL form; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next reads it."""
    docs = load_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


MODULES = (
    line_dedup, sharding, quality_rules, suffix_dedup, decontamination, url_filters,
    language_id, quality_classifier, minhash, packing, brown_lm, collocations, whitening,
)


def _registered(fn: Callable[[SparkSession, str], DataFrame]):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, sf_dir)
    return query


QUERIES = {name: _registered(fn) for m in MODULES for name, fn in m.QUERIES.items()}
QUERIES["pipeline"] = _registered(run)
ORACLE = {name: sql for m in MODULES for name, sql in m.ORACLE.items()}
