"""Event-time order within a stream: rows wait in keyed state until the watermark has passed them.

Rows may arrive in any order within the watermark's delay, over any number of micro-batches. Once the watermark is past a
row, none before it can come any more: it is released, in order of time, together with what the key carries along. Keys
without new rows are released by the timer of their group. Rows that come later than that are dropped; ``late_rows`` counts them.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: A heartbeat is a row whose time moves the watermark and that says nothing else; its key must not be null.
NO_STEP = -1
_KINDS = {"bigint": "int64", "double": "float64"}

#: Keys share this many groups by hash: a group's fixed cost in Python, tens of milliseconds a micro-batch, is then paid for many
#: keys. Raise it where a group's keys and the rows within the delay outgrow a task.
GROUPS = 256

Step = Callable[[Sequence[np.ndarray], pd.DataFrame, np.ndarray], tuple[Sequence[np.ndarray], pd.DataFrame, np.ndarray]]


def in_event_order(
    stream: DataFrame,
    key: str,
    values: Sequence[tuple[str, str]],
    carried: Sequence[tuple[str, str]],
    start: tuple,
    advance: Step,
    out: str,
    delay: str,
    time: str = "ts",
    expire: str | None = None,
    groups: int = GROUPS,
) -> DataFrame:
    """Apply ``advance(entries, rows, stretch) -> (ends, rows out, places)`` to the rows of every key in order of time and ``values``.

    ``advance`` gets many stretches of rows at once, one or more a key: ``stretch`` numbers each row's, without gaps and rising,
    ``entries`` and ``ends`` hold what each stretch carries at its begin and end (an array per name), and ``places`` are
    the rows that the rows out belong to, for their key. ``out`` names the columns out without the key.

    ``values`` and ``carried`` name bigint or double columns without nulls; ``start`` is what a key carries before its first row. The
    first of ``values`` is the step: rows below 0 are heartbeats. Keys are dealt to ``groups`` groups of state (fixed for a
    checkpoint); the state of a key is what it carries and the rows within the delay. With ``expire`` a key starts anew
    when two of its rows are further apart in time, and its state goes once the watermark is that far past its last row.
    """
    names, kinds = [n for n, _ in values], {"_at": "int64"} | {n: _KINDS[kind] for n, kind in values}
    silent = pd.Timedelta(expire).value // 1_000_000 if expire else None
    held = {"_last": "int64"} | {f"_held_{n}": _KINDS[kind] for n, kind in carried}
    keys_of = {"_known": held, "_of": kinds}
    sql = {v: k for k, v in _KINDS.items()}
    fields = [f"{k} array<{'string' if c is None else sql[c]}>" for k, cs in keys_of.items() for k, c in {k: None, **cs}.items()]

    def update(group: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentWatermarkMs()
        stored = list(state.get) if state.exists else [[] for _ in fields]
        known, waiting = stored[: len(held) + 1], stored[len(held) + 1 :]
        parts = [pd.DataFrame({"_of": pd.Series(waiting[0], dtype=object)} | {c: pd.Series(v, dtype=kinds[c]) for c, v in zip(kinds, waiting[1:])})]
        parts += [f[f[names[0]] >= 0][["_of", *kinds]] for f in frames]
        rows = pd.concat([part for part in parts if len(part)] or parts[:1], ignore_index=True)
        # a key's number is its place among the known ones, new ones after them
        codes, keys = pd.factorize(np.concatenate([_texts(known[0]), _texts(rows["_of"])]), use_na_sentinel=False)
        rows["_of"] = codes[len(known[0]) :]
        new = len(keys) - len(known[0])
        holds = [np.array([*v, *[s] * new], dtype=kind) for v, s, kind in zip(known[1:], (0, *start), held.values())]
        rows = rows.sort_values(["_of", *kinds], ignore_index=True)
        due = rows["_at"] <= now * 1000
        released, rows = rows[due].reset_index(drop=True), rows[~due]
        if len(released):
            code, times = released["_of"].to_numpy(), released["_at"].to_numpy() // 1000
            first = np.r_[True, code[1:] != code[:-1]]
            before = np.where(first, holds[0][code], np.r_[0, times[:-1]])
            # a key starts anew after a silence, whether its state was still there or not
            anew = times - before > silent if silent is not None else np.zeros(len(times), bool)
            begins = np.flatnonzero(first | anew)
            entries = [np.where(anew[begins], s, h[code[begins]]).astype(h.dtype) for s, h in zip(start, holds[1:])]
            ends, found, places = advance(entries, released, np.cumsum(first | anew) - 1)
            last = np.flatnonzero(np.r_[code[1:] != code[:-1], True])
            holds[0][code[last]] = times[last]
            for h, end in zip(holds[1:], ends):
                h[code[last]] = end[np.searchsorted(begins, last, side="right") - 1]
            if len(found):
                found.insert(0, "_of", _texts(keys[code[places]]))
                yield found
        held_back, firsts = np.unique(rows["_of"].to_numpy(), return_index=True)
        wakes = [rows["_at"].to_numpy()[firsts] // 1000]
        kept = np.ones(len(keys), bool)
        if silent is not None:
            idle = np.ones(len(keys), bool)
            idle[held_back] = False
            kept = ~(idle & (holds[0] + silent < now))
            wakes.append(holds[0][idle & kept] + silent)
        if not kept.any():
            if state.exists:
                state.remove()
            return
        texts = _texts(keys)
        of = [texts[c] for c in rows["_of"]]
        state.update(([t for t, k in zip(texts, kept) if k], *[h[kept].tolist() for h in holds], of, *[rows[c].tolist() for c in kinds]))
        wakes = np.concatenate(wakes)
        if len(wakes):
            state.setTimeoutTimestamp(max(int(wakes.min()), now) + 1)

    # keys travel as text, as a null among numbers would make them floats
    kind = stream.schema[key].dataType
    timed = stream.withWatermark(time, delay).select(
        F.pmod(F.hash(key), F.lit(groups)).alias("_group"), F.col(key).cast("string").alias("_of"), time, F.unix_micros(time).alias("_at"), *names
    )
    found = timed.groupBy("_group").applyInPandasWithState(
        update, f"_of string, {out}", ", ".join(fields), "append", GroupStateTimeout.EventTimeTimeout
    )
    return found.select(F.col("_of").cast(kind).alias(key), *[c for c in found.columns if c != "_of"])


def _texts(keys: Sequence) -> np.ndarray:
    """Keys with None for null, whatever pandas made of it."""
    return np.array([None if k is None or k != k else k for k in keys], dtype=object)


def heartbeat(stream: DataFrame, at: Column, key: str, values: Sequence[tuple[str, str]], time: str = "ts") -> DataFrame:
    """One row that tells a stream of these columns that time has come to ``at``."""
    row = stream.sparkSession.range(1).select(
        F.lit(NO_STEP).cast(stream.schema[key].dataType).alias(key),
        at.alias(time),
        *[F.lit(NO_STEP).cast(kind).alias(name) for name, kind in values],
    )
    rest = [F.lit(None).cast(f.dataType).alias(f.name) for f in stream.schema.fields if f.name not in row.columns]
    return row.select("*", *rest).select(*stream.columns)


def late_rows(stream: DataFrame, key: str, delay: str, time: str = "ts", step: str = "step", groups: int = GROUPS) -> DataFrame:
    """``key, late``: how many rows of each key came after the watermark had passed them, as a stream of new counts.

    The watermark is the same as that of a stream with the same ``delay``, so these are the rows that it drops. State per key
    with late rows is one number, in ``groups`` groups. The newest count of a key is its largest.
    """

    def update(group: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        passed = state.getCurrentWatermarkMs() * 1000
        late = Counter(k for f in frames for k in _texts(f["_of"][(f["_at"] <= passed) & (f[step] >= 0)]))
        if late:
            counts = dict(zip(*state.get)) if state.exists else {}
            counts |= {k: n + counts.get(k, 0) for k, n in late.items()}
            state.update(([*counts], [*counts.values()]))
            yield pd.DataFrame({"_of": [*late], "late": [counts[k] for k in late]})

    timed = stream.withWatermark(time, delay).select(
        F.pmod(F.hash(key), F.lit(groups)).alias("_group"), F.col(key).cast("string").alias("_of"), time, step, F.unix_micros(time).alias("_at")
    )
    # without timers Spark hands late rows to the function instead of dropping them
    found = timed.groupBy("_group").applyInPandasWithState(
        update, "_of string, late bigint", "_of array<string>, late array<bigint>", "append", GroupStateTimeout.NoTimeout
    )
    return found.select(F.col("_of").cast(stream.schema[key].dataType).alias(key), "late")
