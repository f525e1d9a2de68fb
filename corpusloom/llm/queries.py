"""One query per operator over its whole table, and SQL that states the result where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import (
    binary,
    decontam,
    extraction,
    language,
    licenses,
    mixing,
    neardup,
    overlap,
    phrases,
    quality,
    resampling,
    sharding,
    urls,
)
from corpusloom.llm.common import table


def tokenizer_path() -> str:
    """The byte-level vocabulary of the installed tokenizer files."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_documents(table(spark, sf_dir, "documents"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract_pages(table(spark, sf_dir, "pages"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_documents(table(spark, sf_dir, "documents"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"), urls.labelled_urls(spark))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binary.encode_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), neardup.Settings(width=2))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_rates(table(spark, sf_dir, "documents"), mixing.labelled_documents(spark, sf_dir))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.overlap_groups(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_sharding,
        op2_quality_rules,
        op3_html_extraction,
        op4_license_scan,
        op5_url_filter,
        op6_token_files,
        op7_language_id,
        op8_minhash_dedup,
        op9_mixing,
        op10_decontamination,
        op11_phrase_mining,
        op12_importance_resampling,
        op13_jaccard_join,
    )
}
