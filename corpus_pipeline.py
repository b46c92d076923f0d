"""The corpus pipeline: five stages over documents, each written as Parquet and
reread as the next one's input.

Each stage takes (spark, docs, sf_dir). All but the last return the columns
of documents: language identification drops what it can't place, the n-gram
join keeps one document of each group, decontamination drops contaminated documents,
personal data is replaced by marks (n_chars follows), and the rest is packed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendlake.llm import decontaminate, jaccard, langid, packing, pii
from lendlake.llm.tables import read, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    return langid.drop_rejected(docs.select(*COLUMNS), langid.fit(docs))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one of least doc_id."""
    return jaccard.keep_one(docs.select(*COLUMNS))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by benchmark items."""
    return decontaminate.drop_contaminated(docs.select(*COLUMNS), read(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with marks in place of personal data."""
    before = docs.select(*COLUMNS, F.col("text").alias("before"))
    changed = ~F.col("text").eqNullSafe(F.col("before"))
    n_chars = F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return pii.redact(before).withColumn("n_chars", n_chars).select(*COLUMNS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of the documents' pieces in sequences of at most 2048 tokens."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("personal_data", personal_data),
    ("best_fit_packing", best_fit_packing),
]

#: SQL expresses neither the language model nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
