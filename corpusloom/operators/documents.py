"""Row filters, label encoding and line grouping on raw corpora."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.operators.ordering import ID_BITS, Order, prefix_sums

# Corpus quality warnings that disqualify a document.
BAD_WARNINGS = ("noisy", "header", "footer", "short_sentences", "tiny", "adult")

# Annotation levels, lowest first.
SEVERITY_LEVELS = {"0-Kein": 0, "1-Gering": 1, "2-Vorhanden": 2, "3-Stark": 3, "4-Extrem": 4}

# Sentiment classes; anything else is 0.
SENTIMENT_LEVELS = {"positive": 2, "neutral": 1}

BREAK = "\n"


def nonempty(df: DataFrame, text: str = "text") -> DataFrame:
    """Drop null and empty texts; white-space-only texts stay."""
    return df.where(F.col(text) != "")


def without_blank_documents(df: DataFrame, text: str = "text") -> DataFrame:
    """Drop texts that are exactly empty or one newline."""
    return df.where(~F.col(text).isin("", BREAK))


def without_quality_warnings(df: DataFrame, meta: str = "meta") -> DataFrame:
    """Keep rows with no disqualifying warning; corpora without metadata pass unchanged."""
    if meta not in df.columns:
        return df
    warnings = F.col(meta)["quality_warnings"]
    bad = F.array(*[F.lit(w) for w in BAD_WARNINGS])
    return df.where(warnings.isNull() | ~F.coalesce(F.arrays_overlap(warnings, bad), F.lit(False)))


def binary_label(flag: Column) -> Column:
    return flag.cast("int")


def sentiment_label(sentiment: Column) -> Column:
    levels = F.lit(0)
    for name, level in SENTIMENT_LEVELS.items():
        levels = F.when(sentiment == name, level).otherwise(levels)
    return levels


def severity_level(label: Column) -> Column:
    """Level of a severity label; an unknown label is an error."""
    table = F.create_map(*[F.lit(x) for pair in SEVERITY_LEVELS.items() for x in pair])
    unknown = F.raise_error(F.concat(F.lit("unknown label: "), F.coalesce(label, F.lit("null")))).cast("int")
    return F.coalesce(F.element_at(table, label), unknown)


def majority_level(annotations: Column) -> Column:
    """Most frequent level among ``array<struct<label>>``; ties go to the lowest, no votes give null."""
    votes = F.transform(annotations, lambda a: severity_level(a["label"]))
    tally = F.transform(
        F.array(*[F.lit(v) for v in SEVERITY_LEVELS.values()]),
        lambda level: F.struct(F.size(F.filter(votes, lambda v: v == level)).alias("n"), (-level).alias("low")),
    )
    return F.when(F.size(annotations) > 0, -F.array_max(tally)["low"])


def lines_to_documents(
    lines: DataFrame, order_key: str = "line_id", text: str = "text", id_bits: int = ID_BITS
) -> DataFrame:
    """Join consecutive lines into documents; a row equal to a newline closes one.

    Two breaks in a row give an empty document, lines after the last break belong to none. ``doc_id`` is
    the number of breaks before the document. The break count is a bucketed prefix sum over (key, flag)
    only; every line then travels once, to its document.
    """
    is_break = F.col(text) == BREAK
    closed = lines.where(is_break).count()  # what follows the last break is left out before anything is gathered
    numbered = prefix_sums(lines, Order.of_id(order_key, id_bits), {"doc_id": is_break.cast("bigint")})
    parts = F.array_sort(F.collect_list(F.when(~is_break, F.struct(order_key, text))))
    return (
        numbered.where(F.col("doc_id") < closed)
        .groupBy("doc_id")
        .agg(parts.alias("parts"))
        .select("doc_id", F.array_join(F.transform("parts", lambda p: p[text]), "").alias("text"))
    )
