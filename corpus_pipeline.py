"""A training corpus from raw documents: the stages, and the run over all of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lodestone.llm.exact_dedup import keep_exact
from lodestone.llm.mixing import keep_mix
from lodestone.llm.packing import pack, word_bpe
from lodestone.llm.scratch import Scratch, documents
from lodestone.llm.simhash import keep_first
from lodestone.llm.toxicity import keep_clean

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator does not reject; it learns from the labels of `sf_dir`."""
    return keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), Scratch(spark, "pipeline-toxicity"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest doc_id."""
    return keep_exact(docs, Scratch(spark, "pipeline-exact"), keep="largest")


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, the document with the smallest doc_id."""
    return keep_first(docs, Scratch(spark, "pipeline-simhash"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources in their target shares: documents repeated, left out or cut as the mix takes them."""
    return keep_mix(docs, Scratch(spark, "pipeline-mixing"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return pack(docs, word_bpe())


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("simhash_dedup", simhash_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

# Fingerprints, token ids and the learned lexicon are beyond SQL; tests/llm compares the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written as Parquet and read again by the next."""
    docs, scratch = documents(spark, sf_dir), Scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
