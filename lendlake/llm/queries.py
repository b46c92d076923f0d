"""The operators as registered queries, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lendlake.llm import (
    ctw,
    decontaminate,
    jaccard,
    langid,
    licenses,
    oracle,
    oracle_text,
    packing,
    pii,
    repeats,
    resampling,
    sentencepieces,
    training_order,
    trie,
    vectors,
)
from lendlake.llm.tables import read


def _documents(operator: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: operator(read(spark, sf_dir, "documents"))


def _decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def _language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs))


def _near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(read(spark, sf_dir, "embeddings"))


def _resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def _prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.nodes(read(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": _decontaminate,
    "op2_jaccard_join": _documents(jaccard.near_duplicates),
    "op3_context_tree": _documents(ctw.score),
    "op4_training_order": _documents(training_order.materialise),
    "op5_personal_data": _documents(pii.find),
    "op6_language": _language,
    "op7_licences": _documents(licenses.scan),
    "op8_packing": _documents(packing.pack),
    "op9_repeats": _documents(repeats.remove_repeats),
    "op10_near_vectors": _near_vectors,
    "op11_sentencepieces": _documents(sentencepieces.digests),
    "op12_resampling": _resampling,
    "op13_prefix_trie": _prefix_trie,
}

#: SQL for those that it can express at a bearable cost on whole tables; tests hold
#: the others against brute force instead.
ORACLE: dict[str, str] = {
    "op1_decontaminate": oracle_text.DECONTAMINATE,
    "op2_jaccard_join": oracle_text.JACCARD,
    "op9_repeats": oracle_text.REPEATS,
    "op10_near_vectors": oracle_text.NEAR_VECTORS,
    "op12_resampling": oracle.RESAMPLING,
    "op13_prefix_trie": oracle.PREFIX_TRIE,
}
