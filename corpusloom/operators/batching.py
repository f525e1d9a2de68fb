"""Batches: padding, and within each row real positions, their values and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusloom.functions.arrays import let
from corpusloom.functions.scalars import round_up
from corpusloom.operators.masking import IGNORE


def with_batches(rows: DataFrame, size: int, idx: str = "idx") -> DataFrame:
    """Consecutive rows of a dense index form batches: adds ``batch`` and ``pos``."""
    return rows.withColumns({"batch": F.expr(f"{idx} div {size}"), "pos": F.col(idx) % size})


def padded(array: Column, length: Column, fill: int) -> Column:
    return F.concat(array, F.array_repeat(F.lit(fill), (length - F.size(array)).cast("int")))


def pad_batches(batched: DataFrame, pad_id: int, multiple: int | None = None, ids: str = "input_ids") -> DataFrame:
    """Right-pad ids (and an attention mask) to the longest row of the batch, rounded up to ``multiple``.

    Labels are padded with the ignore value; every other column passes through. A batch is a bounded group, so
    the window holds no more than one batch.
    """
    longest = F.max(F.size(ids)).over(Window.partitionBy("batch"))
    width = round_up(longest, multiple) if multiple else longest.cast("bigint")
    wide = batched.withColumn("width", width)
    out = wide.withColumn("attention_mask", padded(F.array_repeat(F.lit(1), F.size(ids)), F.col("width"), 0))
    if "labels" in batched.columns and dict(batched.dtypes)["labels"].startswith("array"):
        out = out.withColumn("labels", padded(F.col("labels"), F.col("width"), IGNORE))
    return out.withColumn(ids, padded(F.col(ids), F.col("width"), pad_id))


def sequence_offsets(batched: DataFrame, mask: str = "attention_mask") -> DataFrame:
    """Per row: ``len``, its exclusive running sum in the batch ``cu_len``, and ``max_len`` of the batch."""
    batch = Window.partitionBy("batch")
    upto = batch.orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    length = F.size(F.filter(F.col(mask), lambda m: m == 1)).cast("bigint")
    return batched.withColumn("len", length).withColumns(
        {"cu_len": F.sum("len").over(upto) - F.col("len"), "max_len": F.max("len").over(batch)}
    )


def real_places(mask: Column) -> Column:
    """Offsets of a row whose mask is 1."""
    return F.filter(F.transform(mask, lambda m, i: F.when(m == 1, i)), lambda i: i.isNotNull())


def gathered(values: Column, places: Column) -> Column:
    """The row's values at its places, 0 where there is none; a place may repeat."""
    # the values may be an expression, which must not be worked out again for every place
    return let(values, lambda held: F.transform(places, lambda i: F.coalesce(F.get(held, i), F.lit(0))))


def scattered(values: Column, places: Column, width: Column, fill: int = 0) -> Column:
    """An array of ``width`` with the values at their (ascending) places and ``fill`` elsewhere."""

    def with_gaps(at: Column) -> Column:
        def with_gap(v: Column, i: Column) -> Column:
            before = F.coalesce(F.get(at, i - 1), F.lit(-1))
            return F.concat(F.array_repeat(F.lit(fill), (F.get(at, i) - before - 1).cast("int")), F.array(v))

        return F.flatten(F.transform(values, with_gap))

    return let(let(places, with_gaps), lambda body: padded(body, width, fill))


def masked_positions(labels: Column, keep_first: bool = False) -> Column:
    """``array<struct<at, label>>``: positions whose label is above zero, optionally with position 0."""
    tagged = F.transform(labels, lambda x, i: F.struct(i.alias("at"), x.alias("label")))
    return F.filter(tagged, lambda s: (s["label"] > 0) | (F.lit(keep_first) & (s["at"] == 0)))
