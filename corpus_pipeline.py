"""A corpus build of five stages: each reads what the one before it kept, as written Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import binary, decontam, language, mixing, neardup
from corpusloom.llm.common import table
from corpusloom.llm.queries import tokenizer_path
from corpusloom.session import materialize


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; texts without a letter and those the model is unsure of go."""
    return language.keep_identified(docs)


def neardup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five-word shingles, similarity 0.8), that of the smallest id."""
    return neardup.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the fitted mixture says; good documents stay at least once."""
    return mixing.mix(docs, mixing.labelled_documents(spark, sf_dir))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of what is left, read back: a row per document."""
    return binary.encode_documents(docs, tokenizer_path())


STAGES = [
    ("language", language_stage),
    ("neardup", neardup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("tokens", token_stage),
]

#: Trained models and tokenizers are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs, f"pipeline-{name}")
    return docs
