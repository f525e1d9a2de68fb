"""Sharding by jump consistent hashing: stable keys to shards without a ring table.

Law ``key``: the key and the number of shards decide; adding a shard moves rows into the new one only.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from corpusloom.llm.common import crc32_utf8, narrow
from corpusloom.operators.ordering import Order, prefix_sums
from corpusloom.session import materialize

_STEP, _UNIT = np.uint64(2862933555777941757), float(1 << 31)
_BITS = 63


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of every 64-bit key: each key jumps forward until it leaves the range."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    state = keys.astype(np.int64).view(np.uint64).copy()
    at, ahead = np.zeros(len(state), np.int64), np.zeros(len(state), np.int64)
    moving = np.arange(len(state))
    while len(moving):
        at[moving] = ahead[moving]
        state[moving] = state[moving] * _STEP + np.uint64(1)
        reach = (state[moving] >> np.uint64(33)).astype(np.float64) + 1.0
        ahead[moving] = ((at[moving] + 1) * (_UNIT / reach)).astype(np.int64)
        moving = moving[ahead[moving] < shards]
    return at


def shard_of(shards: int):
    """A column function of a bigint key; null keys count as 0."""

    @F.pandas_udf("int")
    def shard(keys: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(keys.to_numpy(), shards).astype("int32"))

    # a null among the keys of a batch would turn all of them into floats
    return lambda key: shard(F.coalesce(key, F.lit(0).cast("bigint")))


def numbered(rows: DataFrame, key: str, group: str, name: str) -> DataFrame:
    """Add a gapless position from 0 within each ``group``, in ascending order of ``key`` (nulls first).

    Rows of one key are numbered by the input partition they lie in and then among themselves, so a key (or a shard)
    with any share of the rows spreads over all tasks. ``rows`` must come from a written table.
    """
    cell = [group, "_key", "_part"]
    placed = rows.withColumns(
        {"_key": F.coalesce(F.col(key), F.lit(-(2**63) + 1).cast("bigint")), "_part": F.spark_partition_id()}
    )
    placed = materialize(placed, "sharding-rows")
    levels = tuple(F.shiftright("_key", n) for n in (50, 36, 22, 8))
    order = Order((F.col("_key"), F.col("_part")), levels)
    cells = placed.groupBy(*cell).agg(F.count("*").alias("_rows"))
    starts = prefix_sums(cells, order, {"_start": F.col("_rows")}, by=(group,)).select(*cell, "_start")
    others = [F.col(c) for c in rows.columns if c not in (key, group)]
    within = F.row_number().over(Window.partitionBy(*cell).orderBy(*others)) - 1
    return (
        placed.withColumn("_within", within)
        .join(starts, cell)
        .select(*rows.columns, (F.col("_start") + F.col("_within")).cast("bigint").alias(name))
    )


def shard_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 16) -> DataFrame:
    """Place every row in a shard and give it a slot there.

    Returns doc_id, size (UTF-8 bytes of the text plus 1), text_crc32, law, shard, slot (gapless from 0 per shard, by
    doc_id) and grown_shard, the shard when there is one more. A null text counts as empty, a null id as key 0; repeated
    ids share a shard and take slots of their own; an empty table gives no rows; other columns are ignored.
    """
    rows = narrow(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
        crc32_utf8(F.col("text")).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(shards)(F.col("doc_id").cast("bigint")).alias("shard"),
        shard_of(shards + 1)(F.col("doc_id").cast("bigint")).alias("grown_shard"),
    )
    return numbered(rows, "doc_id", "shard", "slot")
