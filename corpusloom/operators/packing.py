"""Packing token streams into rows of one length, and re-packing them to another."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.operators.ordering import Order, cut_into, grouped_offsets

# Fixed value: rows concatenated before a remainder is dropped.
GROUP_ROWS = 16_000


def pack(
    rows: DataFrame,
    order: Order,
    length: int | str,
    separator: int | None,
    ids: str = "input_ids",
    group_rows: int = GROUP_ROWS,
    by: Sequence[str] = (),
) -> DataFrame:
    """``by, grp, chunk, input_ids, n``: each run of ``group_rows`` rows as one stream cut into equal rows.

    The separator, if any, follows every input row. The last incomplete row of a run is dropped unless it is
    the only one. ``length`` may name an integer column that is constant within ``by``.

    Each input row is cut directly at the chunk borders it crosses (its place in the stream is a prefix sum),
    so tokens are never exploded one by one, and any run or group spreads over all tasks: the final grouping
    key is a single output row. Where the rows carry their length as ``n``, placing them does not read the tokens; rows
    with ``n`` alone give the rows' lengths alone.
    """
    held = ids in rows.columns or "n" not in rows.columns
    width = F.lit(length) if isinstance(length, int) else F.col(length)
    extra = 0 if separator is None else 1
    size = (F.col("n") if "n" in rows.columns else F.size(ids)) + extra
    keep = list(dict.fromkeys([*by, *([length] if isinstance(length, str) else [])]))

    placed = grouped_offsets(rows, order, size, group_rows, by).where(size > 0)
    first, last = F.col("_start"), F.col("_start") + size - 1

    def cut(chunk: Column) -> Column:
        low = F.greatest(first, chunk * width)
        high = F.least(last + 1, (chunk + 1) * width)
        place = (chunk.alias("chunk"), first.alias("at"), (high - low).alias("size"))
        if not held:
            return F.struct(*place)
        # only the piece that ends the row gets the separator: the row's ids are sliced as they are, never rebuilt
        own = F.least(high, last + 1 - extra) - low
        piece = F.slice(ids, (low - first + 1).cast("int"), own.cast("int"))
        if separator is not None:
            piece = F.when(high > last, F.concat(piece, F.array(F.lit(separator)))).otherwise(piece)
        return F.struct(*place, piece.alias("piece"))

    chunks = F.sequence(F.floor(first / width), F.floor(last / width))
    pieces = placed.select(*keep, F.col("_run").alias("grp"), F.inline(F.transform(chunks, cut)))
    joined = F.flatten(
        F.transform(F.array_sort(F.collect_list(F.struct("at", "piece"))), lambda part: part["piece"])
    )
    return (
        pieces.groupBy(*keep, "grp", "chunk")
        .agg(*([joined.alias("input_ids")] if held else []), F.sum("size").cast("int").alias("n"))
        .where((F.col("n") == width) | (F.col("chunk") == 0))
    )


PACKED_KEYS = ("grp", "chunk")


def packed_order(by: Sequence[str] = PACKED_KEYS) -> Order:
    """The stream order of packed rows."""
    group, chunk = by
    return Order((F.col(group), F.col(chunk)), (F.shiftright(group, 12), F.col(group), F.shiftright(chunk, 8)))


def repack(
    packed: DataFrame, order: Order, length: int | str, group_rows: int = GROUP_ROWS, by: Sequence[str] = ()
) -> DataFrame:
    """Packed rows cut again to another length; no separators are added."""
    return pack(packed, order, length, None, group_rows=group_rows, by=by)


def at_lengths(rows: DataFrame, order: Order, lengths: Sequence[int], group_rows: int = GROUP_ROWS) -> DataFrame:
    """The same rows at several lengths in one job, told apart by ``seq_len``."""
    wide = rows.withColumn("seq_len", F.explode(F.array(*[F.lit(n) for n in lengths])))
    return repack(wide, order, "seq_len", group_rows, by=["seq_len"])


def length_membership(rows: DataFrame, lengths: Sequence[int], ids: str = "input_ids") -> tuple[DataFrame, DataFrame]:
    """Rows whose length is one of ``lengths`` (with ``seq_len``), and all others."""
    n = F.col("n") if "n" in rows.columns else F.size(ids)
    return rows.where(n.isin(list(lengths))).withColumn("seq_len", n), rows.where(~n.isin(list(lengths)))


def curriculum_stages(
    rows: DataFrame,
    order: Order,
    keys: Sequence[str],
    fractions: Sequence[float],
    lengths: Sequence[int],
    max_length: int,
) -> DataFrame:
    """Split an ascending order on ``keys`` into stages taken from its end; adds ``stage`` and ``seq_len``.

    Stage i ends where stage i-1 begins and starts at ``int(end - n * fraction_i)``; the last stage is the rest at
    the front. Rows are told apart by comparing their keys with those at the bounds, so they do not move.
    """
    if len(fractions) != len(lengths):
        raise ValueError("one fraction per stage is needed")
    if abs(sum(fractions) - 1) > 1e-9:
        raise ValueError("the fractions must sum to 1")
    if any(n > max_length for n in lengths):
        raise ValueError("a stage cannot be longer than the packed rows")

    def begins(n: int) -> list[int]:
        out, end = [], n
        for fraction in fractions[:-1]:
            end = int(end - n * fraction)
            out.append(end)
        return out[::-1]

    lens = F.array(*[F.lit(v) for v in lengths])
    cut = cut_into(rows, order, keys, begins, "_piece")
    return (
        cut.withColumn("stage", F.lit(len(lengths) - 1) - F.col("_piece"))
        .withColumn("seq_len", F.get(lens, F.col("stage")))
        .drop("_piece")
    )


def repack_stages(
    staged: DataFrame, order: Order, max_length: int, group_rows: int = GROUP_ROWS
) -> tuple[DataFrame, DataFrame]:
    """Stages cut to their own length (``stage, seq_len, grp, chunk, input_ids, n``), and the rows of those that keep it."""
    keep = F.col("seq_len") == max_length
    return repack(staged.where(~keep), order, "seq_len", group_rows, by=["stage", "seq_len"]), staged.where(keep)
