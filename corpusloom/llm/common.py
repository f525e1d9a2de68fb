"""What the operators of this subpackage share: reading tables, null-safe inputs, word codes."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import cache

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from corpusloom.session import materialize

#: White space between words: the ASCII blanks only.
BLANKS = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables; read by Spark only, so any file system it knows will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def narrow(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names: extra or clashing columns cannot interfere."""
    return df.select(*[F.col(f"`{theirs}`").alias(ours) for ours, theirs in columns.items()])


def positions(rows: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Add a gapless position from 0 in the given order, which must be total.

    Rows are dealt into ranges of that order and numbered there; the ranges' sizes, a row for each, give their starts.
    """
    placed = materialize(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("_range").agg(F.count("*").alias("_size"))
    starts = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    return placed.withColumn("_within", within).join(starts, "_range").select(*rows.columns, (F.col("_start") + F.col("_within")).alias(name))


def crc32_utf8(text: Column) -> Column:
    """Unsigned crc32 of the UTF-8 bytes; null counts as empty."""
    return F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8"))


class Memo(dict):
    """Computed on first use, with bounded memory.

    When ``limit`` keys are held they become the older generation, in place of the one before; a key that is used again
    moves to the new one. What is in use thus stays, whatever passes through, and no value ever changes.
    """

    def __init__(self, make, limit: int = 200_000):
        self.make, self.limit, self.older = make, limit, {}

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value


@cache
def word_memo() -> Memo:
    """64-bit codes of words, remembered by each Python worker."""
    return Memo(xxhash.xxh3_64_intdigest)


def codes(words: Iterable[bytes], memo: Memo) -> np.ndarray:
    words = list(words)
    return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def windows(word_codes: np.ndarray, width: int) -> np.ndarray:
    """One code per run of ``width`` words, in order; fewer words give one code for all of them, none give none."""
    n = len(word_codes)
    if n == 0:
        return word_codes
    width = min(width, n)
    out = word_codes[: n - width + 1]
    for i in range(1, width):
        out = mixed(out) + word_codes[i : n - width + 1 + i]
    return mixed(out)
