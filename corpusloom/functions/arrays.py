"""Array helpers that stay inside one row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running_sum(values: Column) -> Column:
    """Inclusive running sum of an int array.

    Built from blocks of about sqrt(n) elements, because appending to one growing array would copy it
    once per element: n * sqrt(n) work keeps very long documents affordable.
    """
    empty = F.expr("cast(array() as array<int>)")

    def scan(items: Column) -> Column:
        return F.aggregate(
            items, empty, lambda out, x: F.concat(out, F.array(x + F.coalesce(F.get(out, F.size(out) - 1), F.lit(0))))
        )

    def blocks_of(items: Column) -> Column:
        return let(
            F.greatest(F.ceil(F.sqrt(F.size(items))).cast("int"), F.lit(1)),
            lambda width: F.transform(
                F.sequence(F.lit(0), width - 1), lambda b: scan(F.slice(items, b * width + 1, width))
            ),
        )

    def join_blocks(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda b: F.coalesce(F.get(b, F.size(b) - 1), F.lit(0)))
        return let(
            scan(totals),
            lambda ends: F.flatten(
                F.transform(
                    blocks,
                    lambda b, i: F.transform(b, lambda x: x + F.when(i == 0, 0).otherwise(F.get(ends, i - 1))),
                )
            ),
        )

    return let(values, lambda items: let(blocks_of(items), join_blocks))


def joined(array: Column) -> Column:
    """An array as comma-separated text; nulls become empty."""
    return F.array_join(F.transform(array, lambda x: F.coalesce(x.cast("string"), F.lit(""))), ",")
