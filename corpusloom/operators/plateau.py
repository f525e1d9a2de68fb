"""Plateau detection on logs of validation losses."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from corpusloom.operators.ordering import Order, dense_index, prefix_sums
from corpusloom.session import materialize

INFINITY = float("inf")
#: Losses of a block, and nodes of a group in the tree over the blocks, as bits of their position.
BLOCK_BITS, GROUP_BITS = 12, 6


def _following(losses: np.ndarray, min_delta: float) -> np.ndarray:
    """For falling losses, the place of the next one that beats each by more than the delta; their number if none does."""
    return np.searchsorted(-(losses + min_delta), -losses, side="right")


def _passage(losses: np.ndarray, min_delta: float) -> tuple[np.ndarray, np.ndarray]:
    """What a block of falling losses makes of the best one before it.

    The first limit below that best tells its exit: the best after the block. With no such limit it passes unchanged.
    """
    after = _following(losses, min_delta)
    last = np.where(after < len(losses), after, np.arange(len(losses)))
    while (last != last[last]).any():
        last = last[last]
    exits = losses[last]
    ends = np.flatnonzero(np.append(exits[1:] != exits[:-1], True))
    return (losses + min_delta)[ends], exits[ends]


def _sorted_groups(frames: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[dict[str, np.ndarray]]:
    """The columns of every run of rows with equal keys, from frames sorted by them; a group may lie in several frames."""
    held: list[dict[str, np.ndarray]] = []

    def whole() -> dict[str, np.ndarray]:
        return held[0] if len(held) == 1 else {c: np.concatenate([part[c] for part in held]) for c in held[0]}

    for frame in frames:
        columns = {c: frame[c].to_numpy() for c in frame.columns}
        changes = np.logical_or.reduce([columns[k][1:] != columns[k][:-1] for k in keys])
        cuts = [0, *(np.flatnonzero(changes) + 1).tolist(), len(frame)] if len(frame) else []
        for begin, end in zip(cuts[:-1], cuts[1:]):
            part = {c: v[begin:end] for c, v in columns.items()}
            if held and any(held[0][k][0] != part[k][0] for k in keys):
                yield whole()
                held = []
            held.append(part)
    if held:
        yield whole()


def _dealt(rows: DataFrame, group: str, order: str) -> DataFrame:
    """Every group of a run in one partition, sorted.

    Dealt by a hash of the keys: dealt by the keys alone, the step would be left out after a join on them, whose own
    partitions may still give way to a broadcast while the query runs.
    """
    return rows.repartition(F.xxhash64("run", group)).sortWithinPartitions("run", group, order)


def _gathered(rows: Iterator[tuple], columns: list[str], size: int = 100_000) -> Iterator[pd.DataFrame]:
    """Frames of many rows; ``size`` bounds the numbers that their arrays hold."""
    held, numbers = [], 0
    for row in rows:
        held.append(row)
        numbers += sum(np.size(v) for v in row)
        if numbers >= size:
            yield pd.DataFrame(held, columns=columns)
            held, numbers = [], 0
    if held:
        yield pd.DataFrame(held, columns=columns)


def _through(best, limits: np.ndarray, exits: np.ndarray):
    """The best loss after a passage, for one or many before it."""
    at = np.searchsorted(-limits, -np.asarray(best), side="right")
    passed = at >= len(limits)
    return np.where(passed, best, exits[np.minimum(at, len(limits) - 1)])


def _composed(first: tuple[np.ndarray, np.ndarray], then: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """One passage for two that follow each other; limits with equal exits are one step."""
    limits = np.concatenate([first[0], then[0]])
    exits = np.concatenate([_through(first[1], *then), then[1]])
    ends = np.flatnonzero(np.append(exits[1:] != exits[:-1], True))
    return limits[ends], exits[ends]


def _passages(min_delta: float):
    """The passage of every block, from rows sorted by run, block and position."""

    def passages(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        groups = _sorted_groups(frames, ["run", "block"])
        return _gathered(((g["run"][0], g["block"][0], *_passage(g["loss"], min_delta)) for g in groups), PASSAGE)

    return passages


#: Columns of a table of passages.
PASSAGE = ["run", "node", "limits", "exits"]


def _of_groups(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One passage for every group, from the passages of its nodes in order."""

    def whole(group: dict[str, np.ndarray]) -> tuple:
        return reduce(_composed, zip(group["limits"], group["exits"]))

    return _gathered(((g["run"][0], g["above"][0], *whole(g)) for g in _sorted_groups(frames, ["run", "above"])), PASSAGE)


def _to_nodes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The best loss before every node, from the one before its group and the passages of the nodes before it."""

    def entries(group: dict[str, np.ndarray]) -> Iterator[tuple]:
        best = group["entry"][0]
        for node, limits, exits in zip(group["node"], group["limits"], group["exits"]):
            yield group["run"][0], node, best
            best = float(_through(best, limits, exits))

    return _gathered((row for g in _sorted_groups(frames, ["run", "above"]) for row in entries(g)), ["run", "node", "entry"])


def _entries(passages: DataFrame, run: str) -> DataFrame:
    """The best loss before every block (``run, node, entry``).

    Passages are composed up a tree of groups of ``2^GROUP_BITS`` nodes, then entries go down it: a task reads the
    passages of one group, whatever share of the rows a run has.
    """
    shape = f"{run}, node bigint, limits array<double>, exits array<double>"
    levels = [passages]
    deepest = passages.agg(F.max("node")).first()[0] or 0
    while deepest:
        nodes = levels[-1].withColumn("above", F.shiftright("node", GROUP_BITS))
        deepest >>= GROUP_BITS
        if not deepest:
            break
        levels.append(materialize(_dealt(nodes, "above", "node").mapInPandas(_of_groups, shape), "passages"))
    entries = levels[-1].select("run", F.shiftright("node", GROUP_BITS).alias("above"), F.lit(INFINITY).alias("entry")).distinct()
    for nodes in reversed(levels):
        nodes = nodes.withColumn("above", F.shiftright("node", GROUP_BITS)).join(entries, ["run", "above"])
        below = _dealt(nodes, "above", "node").mapInPandas(_to_nodes, f"{run}, node bigint, entry double")
        entries = below.withColumnRenamed("node", "above")
    return entries.withColumnRenamed("above", "node")


def _improvements(min_delta: float):
    """The losses of a block that beat the last such one (or the block's entry) by more than the delta, from sorted rows."""

    def improved(block: dict[str, np.ndarray]) -> Iterator[tuple]:
        losses = block["loss"]
        after = _following(losses, min_delta)
        at = int(np.searchsorted(-(losses + min_delta), -block["entry"][0], side="right"))
        while at < len(losses):
            yield block["run"][0], block["idx"][at]
            at = int(after[at])

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _gathered((row for g in _sorted_groups(frames, ["run", "block"]) for row in improved(g)), ["run", "idx"])

    return scan


def plateau_switches(
    losses: DataFrame, order: Order, patience: int, min_delta: float, datasets: int, mode: str = "min"
) -> DataFrame:
    """``run, step, switch_no``: where a run moves on to its next dataset.

    A loss improves on the best so far if it beats it by more than ``min_delta``; after ``patience`` losses in a row that
    do not, a switch is due and the count starts over. A run has ``datasets - 1`` switches at most.

    Only new minima can improve on the best, so the losses are first reduced to those (a bucketed running minimum) and cut
    into blocks of positions. What a block makes of any best before it is a falling step function, found for all blocks at
    once; a tree over groups of blocks composes these and hands every block its entry. Then every block is scanned
    on its own, so a run of any length spreads over all tasks. Switch positions follow by arithmetic on the gaps
    between improvements. ``losses`` has ``run, step`` and a ``loss`` without nulls.
    """
    run = f"run {dict(losses.dtypes)['run']}"
    if datasets < 2:
        return losses.select("run", "step", F.lit(0).cast("bigint").alias("switch_no")).where("false")
    indexed = materialize(dense_index(losses, order, "idx", by=["run"]), "losses")
    signed = (F.col("loss") if mode == "min" else -F.col("loss")).cast("double")
    falling = (
        running_minimum(indexed.withColumn("_signed", signed), "_signed")
        .where("(_before is null or _signed < _before) and not isnan(_signed)")
        .select("run", F.shiftright("idx", BLOCK_BITS).alias("block"), "idx", F.col("_signed").alias("loss"))
    )
    falling = materialize(falling, "minima")
    passages = _dealt(falling, "block", "idx").mapInPandas(_passages(min_delta), f"{run}, node bigint, limits array<double>, exits array<double>")
    entries = _entries(materialize(passages, "passages"), run).withColumnRenamed("node", "block")
    improved = _dealt(falling.join(entries, ["run", "block"]), "block", "idx").mapInPandas(_improvements(min_delta), f"{run}, idx bigint")
    # an improvement holds until the next one
    numbered = materialize(dense_index(improved, Order.of_id("idx"), "place", by=["run"]), "improvements")
    following = numbered.select("run", (F.col("place") - 1).alias("place"), F.col("idx").alias("next_idx"))
    lengths = indexed.groupBy("run").agg(F.count(F.lit(1)).alias("n"))
    gaps = (
        numbered.join(following, ["run", "place"], "left")
        .join(lengths, "run")
        .withColumn("until", F.coalesce("next_idx", "n"))
        .withColumn("due", F.expr(f"(until - idx - 1) div {patience}"))
        .where("due > 0")
        .select("run", "idx", "due")
    )
    placed = prefix_sums(gaps, Order.of_id("idx"), {"earlier": F.col("due")}, by=["run"])
    room = F.least("due", F.lit(datasets - 1) - F.col("earlier"))
    return (
        placed.withColumn("room", room)
        .where("room > 0")
        .select("run", "idx", "earlier", F.explode(F.sequence(F.lit(1).cast("bigint"), "room")).alias("k"))
        .select("run", (F.col("idx") + F.col("k") * patience).alias("idx"), (F.col("earlier") + F.col("k")).alias("switch_no"))
        .join(indexed.select("run", "idx", "step"), ["run", "idx"])
        .select("run", "step", "switch_no")
    )


def running_minimum(rows: DataFrame, value: str, by: str = "run", idx: str = "idx") -> DataFrame:
    """Add ``_before``: the minimum over the earlier rows of the run, null for the first.

    Same buckets as the prefix sums: minima per bucket, a running minimum over those, then a scan inside each bucket.
    """
    coarse, fine = F.shiftright(idx, 24).alias("_c"), F.shiftright(idx, 12).alias("_f")
    cells = rows.groupBy(by, coarse, fine).agg(F.min(value).alias("_m"))
    tops = cells.groupBy(by, "_c").agg(F.min("_m").alias("_m"))
    earlier = lambda *keys: Window.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.select(by, "_c", F.min("_m").over(earlier(by, "_c")).alias("_top"))
    cells = cells.select(by, "_c", "_f", F.min("_m").over(earlier(by, "_c", "_f")).alias("_cell")).join(tops, [by, "_c"])
    local = F.min(value).over(earlier(by, "_c", "_f", idx))
    return (
        rows.withColumns({"_c": F.shiftright(idx, 24), "_f": F.shiftright(idx, 12)})
        .join(cells, [by, "_c", "_f"])
        .withColumn("_before", F.least(local, "_cell", "_top"))
        .drop("_c", "_f", "_cell", "_top")
    )
