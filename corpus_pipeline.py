"""A training corpus from `documents`: language ID, near-duplicates, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewell.llm import decontaminate, langid, mixing, near_copies, sharding
from tidewell.llm.common import docs_of, stored

N_SHARDS = 40


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a main language stay; those without letters, or with no language of half their text, go."""
    return langid.keep_identified(docs, langid.train(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies stays: five-word shingles with a Jaccard similarity of 0.8 or more."""
    return near_copies.keep_one(docs)


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; a document that is mostly such passages goes."""
    return decontaminate.decontaminate(docs, docs_of(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources come in their target shares: a row for each document and epoch that the mix takes words of."""
    return mixing.mixed_documents(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds shard and slot along the Hilbert curve of source, language and length."""
    return sharding.assign_shards(docs, ["source", "lang", "n_chars"], N_SHARDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("op9_language", language),
    ("op4_simhash", near_duplicates),
    ("op8_decontaminate", benchmarks),
    ("op7_mix", mix),
    ("op3_shards", shards),
]

#: SQL has neither XXH64 fingerprints nor their components; tests/llm holds the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents; each but the last is written to the shared folder."""
    docs = docs_of(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
