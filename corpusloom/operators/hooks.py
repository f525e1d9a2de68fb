"""Extension points for code that no built-in expression covers."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType


def map_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: StructType | str) -> DataFrame:
    """Apply ``fn`` to Arrow batches of rows; it may return more or fewer rows than it got."""

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield fn(frame)

    return df.mapInPandas(each, schema)


def collate(
    batched: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: StructType | str, batch: str = "batch"
) -> DataFrame:
    """Apply ``fn`` to each batch as a whole; batches are bounded by their size."""
    return batched.groupBy(batch).applyInPandas(fn, schema)


def collect_batches(batched: DataFrame, columns: Sequence[str], batch: str = "batch", pos: str = "pos") -> DataFrame:
    """One row per batch with its rows as an ordered array, for collation by expressions."""
    rows = F.array_sort(F.collect_list(F.struct(pos, *columns)))
    return batched.groupBy(batch).agg(rows.alias("rows"))
