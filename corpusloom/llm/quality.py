"""Quality rules as a bitmask ledger, in column expressions only.

Every rule is evaluated once per document; the ledger keeps the measurements and one failure bit per rule. Policies
are masks over those bits, so a new version or an ablation reads the narrow ledger and never the texts.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.functions.arrays import let
from corpusloom.llm.common import BLANKS, narrow
from corpusloom.session import materialize

WINDOW = 5
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Rules in bit order: a document fails where the condition over the measurements holds.
RULES: Mapping[str, str] = {
    "few_words": "n_words < 10",
    "repeated_windows": "100 * n_repeat_words > 20 * n_words",
    "symbols": "10 * n_symbols > 3 * n_words",
    "duplicate_lines": "2 * n_dup_lines > n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 15 * n_words",
    "shouting": "2 * n_capitals > word_chars",
}
BASE = ("few_words", "repeated_windows")


@dataclass(frozen=True)
class Policy:
    """A named version: the rules it enforces and how many of them a document may fail."""

    name: str
    rules: tuple[str, ...]
    allowed: int = 0

    def mask(self, rules: Mapping[str, str] = RULES) -> int:
        order = list(rules)
        return sum(1 << order.index(r) for r in self.rules)


POLICIES = {
    p.name: p
    for p in (
        Policy("base-1", BASE),
        Policy("clean-1", (*BASE, "symbols", "duplicate_lines")),
        Policy("clean-2", tuple(RULES)),
    )
}


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _words_in_repeats(found: Column) -> Column:
    """Words covered by windows that occur twice or more, given all window hashes in order."""
    pairs = F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    repeated = let(
        pairs,
        lambda s: F.filter(
            s, lambda x, i: F.get(s, i - 1)["h"].eqNullSafe(x["h"]) | F.get(s, i + 1)["h"].eqNullSafe(x["h"])
        ),
    )
    starts = F.sort_array(F.transform(repeated, lambda x: x["i"]))
    steps = let(
        starts,
        lambda p: F.transform(p, lambda x, k: F.least(F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW)), F.lit(WINDOW))),
    )
    return F.aggregate(steps, F.lit(0), lambda a, x: a + x)


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_capitals and n_repeat_words.

    One narrow pass. Windows are compared by 64-bit hashes; only documents with a repeated one sort them.
    """
    text = narrow(docs, doc_id=id_col, text=text_col).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    trimmed = F.btrim("text", F.lit(BLANKS))
    words = text.withColumn("_words", F.split(trimmed, r"[\x20\x09-\x0D]+")).withColumn(
        "_n", F.when(F.get("_words", F.lit(0)) == "", 0).otherwise(F.size("_words"))
    )
    hashed = words.withColumn("_codes", F.transform("_words", lambda w: F.xxhash64(w)))
    found = hashed.withColumn(
        "_found",
        F.when(
            F.col("_n") >= WINDOW,
            F.transform(
                F.sequence(F.lit(0), F.col("_n") - WINDOW),
                lambda i: F.xxhash64(*[F.get("_codes", i + k) for k in range(WINDOW)]),
            ),
        ).otherwise(F.expr("cast(array() as array<bigint>)")),
    )
    lines = F.filter(F.split("text", "\n"), lambda x: F.length(F.translate(x, BLANKS, "")) > 0)
    measured = found.withColumn("_lines", lines).select(
        "doc_id",
        F.col("_n").cast("bigint").alias("n_words"),
        F.length(_without(F.col("text"), BLANKS)).cast("bigint").alias("word_chars"),
        (F.length("text") - F.length(_without(F.col("text"), SYMBOLS))).cast("bigint").alias("n_symbols"),
        F.size("_lines").cast("bigint").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        (F.length("text") - F.length(_without(F.col("text"), CAPITALS))).cast("bigint").alias("n_capitals"),
        F.when(F.size(F.array_distinct("_found")) == F.size("_found"), 0)
        .otherwise(_words_in_repeats(F.col("_found")))
        .cast("bigint")
        .alias("n_repeat_words"),
    )
    return measured


def ledger(measured: DataFrame, rules: Mapping[str, str] = RULES) -> DataFrame:
    """The measurements with ``failures``: bit k is set where rule k fails. Written once, read by every policy."""
    bits = [F.when(F.expr(condition), F.lit(1 << k)).otherwise(0) for k, condition in enumerate(rules.values())]
    failures = bits[0]
    for bit in bits[1:]:
        failures = failures.bitwiseOR(bit)
    return materialize(measured.withColumn("failures", failures.cast("bigint")), "quality-ledger")


def failed(policy: Policy, rules: Mapping[str, str] = RULES) -> Column:
    """Whether a ledger row breaks the policy."""
    return F.bit_count(F.col("failures").bitwiseAND(F.lit(policy.mask(rules)))) > policy.allowed


def apply_policy(rows: DataFrame, policy: Policy, rules: Mapping[str, str] = RULES) -> DataFrame:
    """Ledger rows with ``kept``."""
    return rows.withColumn("kept", ~failed(policy, rules))


def ablations(rows: DataFrame, policy: Policy, rules: Mapping[str, str] = RULES) -> DataFrame:
    """For each rule of the policy: rows that fail it, and rows the policy would keep without it.

    One aggregation over the bits; the result has a row per rule.
    """
    enforced = F.col("failures").bitwiseAND(F.lit(policy.mask(rules)))
    order = list(rules)
    entries = []
    for name in policy.rules:
        bit = 1 << order.index(name)
        rest = F.bit_count(enforced.bitwiseAND(F.lit(policy.mask(rules) & ~bit))) <= policy.allowed
        broken = F.bit_count(enforced) > policy.allowed
        entries.append(
            F.struct(
                F.lit(name).alias("rule"),
                F.count_if(enforced.bitwiseAND(F.lit(bit)) != 0).alias("fails"),
                F.count_if(broken & rest).alias("kept_without"),
            )
        )
    seen = F.bit_or(enforced).alias("_seen")
    return (
        rows.agg(F.array(*entries).alias("_rules"), seen)
        .select(F.explode("_rules").alias("_rule"), F.coalesce("_seen", F.lit(0)).alias("failures_seen"))
        .select("_rule.*", "failures_seen")
    )


def judge_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", policy: Policy = POLICIES["clean-2"]
) -> DataFrame:
    """Measurements, failure bits, the verdict of the base rules and that of the policy, per row.

    A null text is an empty one (no words, so the base rules fail it). Repeated rows are judged each on its own; an
    empty table gives no rows; other columns are ignored. Whole texts of any length are measured.
    """
    rows = ledger(measure(docs, id_col, text_col))
    base = failed(POLICIES["base-1"])
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base.alias("base_failed"),
        (~base & ~failed(policy)).alias("kept"),
        "n_lines",
        "n_capitals",
        "failures",
        F.lit(policy.name).alias("policy"),
    )
