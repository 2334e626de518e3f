"""The corpus pipeline: documents without toxic texts and near copies, secrets redacted, packed for training."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reelmetry.llm.nnls_packing import pack
from reelmetry.llm.odd_dedup import keep_one
from reelmetry.llm.queries import WORDS, tokenizer_path
from reelmetry.llm.secret_markov import redact
from reelmetry.llm.toxicity_chain import keep_civil
from reelmetry.operators.skew import store

#: Near copies share this percentage of their five-word shingles or more; op 2's contract has its own.
SIMILARITY = 80


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain doesn't call toxic."""
    return keep_civil(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return keep_one(docs, SIMILARITY)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets redacted."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences of at most 2048; one row per piece, with its ids."""
    return pack(docs, tokenizer_path(WORDS), with_ids=True)


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("secrets", secrets), ("packing", packing)]

#: Trained models and tokenizers are beyond SQL; the tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
