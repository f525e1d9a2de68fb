"""Dense positions, prefix sums, shuffles and exact splits over an explicit total order.

Rows of a DataFrame have no order, so every operator names one: ``order`` (the sort columns, unique
together) and ``levels`` (bucket columns from coarse to fine that are monotone in that order). Prefix
sums are taken bucket by bucket: totals per bucket are summed on a table that is smaller by the bucket
width, and each bucket is scanned on its own. No window ever spans the data, whatever share of the rows
one group holds.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window, functions as F

from corpusloom.functions.hashing import hash32


# Ids are bucketed by dropping low bits: 256 rows in a fine bucket, 2^14 buckets in each above it. 36 bits suit
# dense ids up to 68 billion with two levels; sparse ids need the bits of the largest one, so that the top level
# stays at 2^14 buckets.
FINE_BITS, FAN_OUT_BITS, ID_BITS = 8, 14, 36


def _id_levels(column: Column, bits: int) -> tuple[Column, ...]:
    """Buckets of an id; a null would have no place in the order, so it stops the job instead of being lost."""
    column = F.coalesce(column, F.raise_error(F.lit("null order key")).cast("bigint"))
    return tuple(F.shiftright(column, n) for n in reversed(range(FINE_BITS, max(bits - FAN_OUT_BITS, FINE_BITS) + 1, FAN_OUT_BITS)))


@dataclass(frozen=True)
class Order:
    """A total order: sort columns plus monotone bucket columns, coarse to fine."""

    by: tuple[Column, ...]
    levels: tuple[Column, ...]

    @staticmethod
    def of_id(column: str, bits: int = ID_BITS) -> "Order":
        """Ascending order of a unique bigint id below 2^bits; a fine bucket holds 256 rows at most."""
        return Order((F.col(column),), _id_levels(F.col(column), bits))

    @staticmethod
    def of_hash(hash_column: str, *ties: str) -> "Order":
        """Order of a 32-bit hash column; buckets fill evenly."""
        c = F.col(hash_column)
        return Order((c, *[F.col(t) for t in ties]), (F.shiftright(c, 20), F.shiftright(c, 8)))

    @staticmethod
    def longest_first(length_column: str, id_column: str, bits: int = ID_BITS) -> "Order":
        """Longest rows first, ties by id; a popular length is split further by id."""
        n, i = F.col(length_column), F.col(id_column)
        return Order((n.desc(), i), (-n, *_id_levels(i, bits)))


def _level_names(order: Order) -> list[str]:
    return [f"_level{i}" for i in range(len(order.levels))]


def _with_levels(df: DataFrame, order: Order) -> DataFrame:
    return df.withColumns(dict(zip(_level_names(order), order.levels)))


def _offsets(cells: DataFrame, by: Sequence[str], levels: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Exclusive prefix sums of bucket totals, one level of the hierarchy at a time."""
    parents = [*by, *levels[:-1]]
    before = Window.partitionBy(*parents).orderBy(levels[-1]).rowsBetween(Window.unboundedPreceding, -1)
    local = cells.select(
        *by, *levels, *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_before_{n}") for n in names]
    )
    if len(levels) == 1:
        return local
    upper = cells.groupBy(*parents).agg(*[F.sum(n).alias(n) for n in names])
    upper = _offsets(upper, by, levels[:-1], names).withColumnsRenamed({f"_before_{n}": f"_upper_{n}" for n in names})
    return local.join(upper, parents).select(
        *by, *levels, *[(F.col(f"_before_{n}") + F.col(f"_upper_{n}")).alias(f"_before_{n}") for n in names]
    )


def _cells(df: DataFrame, order: Order, values: Mapping[str, Column], by: Sequence[str]) -> DataFrame:
    return (
        _with_levels(df, order)
        .groupBy(*by, *_level_names(order))
        .agg(*[F.sum(v).alias(n) for n, v in values.items()])
    )


def prefix_sums(
    df: DataFrame, order: Order, values: Mapping[str, Column], by: Sequence[str] = (), inclusive: bool = False
) -> DataFrame:
    """Add one running sum per entry of ``values``, restarting in every ``by`` group.

    Exclusive by default: a row's value is the sum over the rows before it. Columns in ``by`` and the
    summed values must not be null.
    """
    names = list(values)
    offsets = _offsets(_cells(df, order, values, by), by, _level_names(order), names)
    placed = _placed(df, order, values, by, offsets)
    if inclusive:
        placed = placed.withColumns({n: F.col(n) + F.col(f"_value_{n}") for n in names})
    return placed.select(*[c for c in df.columns if c not in names], *names)


def _placed(
    df: DataFrame, order: Order, values: Mapping[str, Column], by: Sequence[str], offsets: DataFrame
) -> DataFrame:
    """Rows with their exclusive running sums: the bucket's offset plus a scan of the bucket."""
    levels = _level_names(order)
    cell = Window.partitionBy(*by, *levels).orderBy(*order.by)
    upto = cell.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = _with_levels(df, order).withColumns({f"_value_{n}": v for n, v in values.items()})
    return rows.join(offsets, [*by, *levels]).withColumns(
        {n: F.col(f"_before_{n}") + F.sum(f"_value_{n}").over(upto) - F.col(f"_value_{n}") for n in values}
    )


def dense_index(df: DataFrame, order: Order, name: str = "idx", by: Sequence[str] = ()) -> DataFrame:
    """Zero-based position of every row in the order, without gaps."""
    return prefix_sums(df, order, {name: F.lit(1).cast("bigint")}, by)


def grouped_offsets(
    df: DataFrame, order: Order, weight: Column, group_rows: int, by: Sequence[str] = ()
) -> DataFrame:
    """Cut the order into runs of ``group_rows`` rows; adds ``_run`` and ``_start``.

    ``_start`` is the sum of ``weight`` over the earlier rows of the same run. A run may be far larger than
    a task: only buckets are ever sorted, and the weight at each run's first row travels through the small
    bucket table.
    """
    levels = _level_names(order)
    values = {"_idx": F.lit(1).cast("bigint"), "_sum": weight.cast("bigint")}
    offsets = _offsets(_cells(df, order, values, by), by, levels, list(values))
    opens_run = F.col("_idx") % group_rows == 0

    # the sum at the first row of every run, then the run that each bucket starts in
    opening = _placed(df, order, values, by, offsets).where(opens_run)
    bases = opening.select(*by, F.expr(f"_idx div {group_rows}").alias("_entry"), F.col("_sum").alias("_entry_sum"))
    offsets = offsets.withColumn("_entry", F.expr(f"_before__idx div {group_rows}")).join(bases, [*by, "_entry"])

    upto = (
        Window.partitionBy(*by, *levels).orderBy(*order.by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    base = F.greatest("_entry_sum", F.max(F.when(opens_run, F.col("_sum"))).over(upto))
    return (
        _placed(df, order, values, by, offsets)
        .withColumn("_base", base)
        .select(
            *df.columns, F.expr(f"_idx div {group_rows}").alias("_run"), (F.col("_sum") - F.col("_base")).alias("_start")
        )
    )


def shuffle_order(df: DataFrame, keys: Sequence[str], seed: int = 42, epoch: int | None = None) -> DataFrame:
    """Add ``shuffle_key``: a fixed pseudo-random position drawn from the row's key.

    The same seed always gives the same order; each ``epoch`` gives another one.
    """
    salt = [F.lit(str(seed))] + ([] if epoch is None else [F.lit(str(epoch))])
    return df.withColumn("shuffle_key", hash32(*[F.col(k) for k in keys], *salt))


def rank_cutoffs(df: DataFrame, order: Order, keys: Sequence[str], ranks: Sequence[int]) -> dict[int, Row]:
    """The ``keys`` of the rows at the given 1-based ranks that exist; a row per rank is all that reaches the driver.

    Bucket counts find the buckets that hold the ranks; only those are sorted.
    """
    levels = _level_names(order)
    cells = _cells(df, order, {"_rows": F.lit(1).cast("bigint")}, ())
    wanted = F.array(*[F.lit(r).cast("bigint") for r in sorted(set(ranks))])
    hits = (
        cells.join(_offsets(cells, (), levels, ["_rows"]), levels)
        .select(*levels, "_rows", "_before__rows", F.explode(wanted).alias("_rank"))
        .where("_before__rows < _rank and _rank <= _before__rows + _rows")
        .select(*levels, "_rank", (F.col("_rank") - F.col("_before__rows")).alias("_need"))
    )
    position = F.row_number().over(Window.partitionBy("_rank", *levels).orderBy(*order.by))
    # one row per rank at most, so broadcasting the hits is safe at any scale
    found = (
        _with_levels(df, order)
        .join(F.broadcast(hits), levels)
        .withColumn("_position", position)
        .where("_position = _need")
        .select("_rank", F.struct(*keys).alias("_keys"))
    )
    return {row["_rank"]: row["_keys"] for row in found.collect()}


def cut_into(
    df: DataFrame, order: Order, keys: Sequence[str], ranks: Callable[[int], Sequence[int]], name: str
) -> DataFrame:
    """Number the pieces of an ascending order: the first ``ranks[0]`` rows are 0, those up to ``ranks[1]`` 1, and so on.

    ``ranks`` gets the row count. The bounds are found first (they are a few numbers); comparing each row's keys with
    them then splits the rows where they are, without moving any. Read from a written table where ``df`` is costly.
    """
    n = df.count()
    at = [min(max(int(r), 0), n) for r in ranks(n)]
    if any(b < a for a, b in zip(at, at[1:])):
        raise ValueError("ranks must not fall")
    inner = [r for r in at if 0 < r < n]
    cuts = rank_cutoffs(df, order, keys, inner) if inner else {}
    types = dict(df.dtypes)
    piece = F.lit(len(at))
    for i, rank in reversed(list(enumerate(at))):
        if rank == n:
            piece = F.lit(i)
        elif rank > 0:
            bound = [F.lit(v).cast(types[k]) for k, v in zip(keys, cuts[rank])]
            inside = F.col(keys[0]) <= bound[0] if len(keys) == 1 else F.struct(*keys) <= F.struct(*bound)
            piece = F.when(inside, i).otherwise(piece)
    return df.withColumn(name, piece)


def head(df: DataFrame, order: Order, keys: Sequence[str], rank: Callable[[int], int]) -> DataFrame:
    """Exactly the first ``rank(n)`` rows of an ascending order on ``keys``; a filter, not a sort."""
    return head_and_tail(df, order, keys, rank)[0]


def head_and_tail(
    df: DataFrame, order: Order, keys: Sequence[str], rank: Callable[[int], int]
) -> tuple[DataFrame, DataFrame]:
    """The first ``rank(n)`` rows and the rest."""
    cut = cut_into(df, order, keys, lambda n: [rank(n)], "_piece")
    return cut.where("_piece = 0").drop("_piece"), cut.where("_piece = 1").drop("_piece")


def discard_fraction(df: DataFrame, keys: Sequence[str], fraction: float, seed: int = 42) -> DataFrame:
    """Keep exactly ``int((1 - fraction) * n)`` rows, chosen by the shuffled order."""
    mixed = shuffle_order(df, keys, seed)
    names = ["shuffle_key", *keys]
    return head(mixed, Order.of_hash(*names), names, lambda n: int((1 - fraction) * n)).select(*df.columns)


def tail_split(df: DataFrame, order: Order, keys: Sequence[str], dev_rows: int) -> tuple[DataFrame, DataFrame]:
    """Train and dev: dev is the last ``dev_rows`` rows of the order. Asking for more than there are is an error."""

    def train_rows(n: int) -> int:
        if dev_rows > n:
            raise ValueError(f"a dev set of {dev_rows} rows is larger than the data ({n} rows)")
        return n - dev_rows

    return head_and_tail(df, order, keys, train_rows)


def cap_rows(df: DataFrame, order: Order, keys: Sequence[str], max_rows: int | None) -> DataFrame:
    """At most ``max_rows`` rows from the front of the order; None, 0 and -1 switch the cap off."""
    if max_rows in (None, 0, -1):
        return df
    return head(df, order, keys, lambda n: max_rows)
