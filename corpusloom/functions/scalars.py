"""Small scalar expressions: rounding, list parsing, and the printed forms of metrics."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_up(n: Column, k: int) -> Column:
    """The next multiple of ``k`` at or above ``n``."""
    if k <= 0:
        raise ValueError("k must be positive")
    return (F.ceil(n / k) * k).cast("bigint")


def _fixed(x: Column, pattern: str) -> Column:
    """Fixed decimals of the exact binary value, ties to even (printf-style rounds the shortest decimal form)."""
    return F.call_function("format_number", x, F.lit(pattern))


def elapsed_text(seconds: Column) -> Column:
    """``0ms``, ``12.50s``, ``1:15m``, ``1:01:01h`` or ``1:01:01:01d`` by magnitude; the largest unit is unpadded."""
    whole = F.floor(seconds)
    part = {"s": whole % 60, "m": F.floor(whole / 60) % 60, "h": F.floor(whole / 3600) % 24, "d": F.floor(whole / 86400)}
    return (
        F.when(seconds < 0.001, F.format_string("%dms", F.floor(seconds * 1000)))
        .when(seconds < 60, F.concat(_fixed(seconds, "0.00"), F.lit("s")))
        .when(seconds < 3600, F.format_string("%d:%02dm", part["m"], part["s"]))
        .when(seconds < 86400, F.format_string("%d:%02d:%02dh", part["h"], part["m"], part["s"]))
        .otherwise(F.format_string("%d:%02d:%02d:%02dd", part["d"], part["h"], part["m"], part["s"]))
    )


def metrics_text(metrics: Column, prefix: str = "") -> Column:
    """``name: value`` pairs of a ``map<string,double>`` in key order, joined by commas.

    Names containing ``time`` print as elapsed time, the rest with three decimals; only the part of a name after
    its last slash is shown.
    """
    entries = F.array_sort(F.map_entries(metrics))
    pairs = F.transform(
        entries,
        lambda e: F.concat(
            F.element_at(F.split(e["key"], "/"), -1),
            F.lit(": "),
            F.when(F.contains(e["key"], F.lit("time")), elapsed_text(e["value"])).otherwise(
                _fixed(e["value"], "0.000")
            ),
        ),
    )
    return F.concat(F.lit(prefix + " " if prefix else ""), F.array_join(pairs, ", "))


def int_list(text: Column) -> Column:
    return F.transform(F.split(text, ","), lambda x: F.trim(x).cast("int"))


def float_list(text: Column) -> Column:
    return F.transform(F.split(text, ","), lambda x: F.trim(x).cast("double"))


def equal_shares(k: int) -> list[float]:
    """Default stage fractions: 1/k each."""
    return [1 / k] * k
