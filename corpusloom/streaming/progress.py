"""Running progress totals on a stream of training steps."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from corpusloom.streaming.reorder import in_event_order

VALUES = (("step", "bigint"), ("rows", "bigint"), ("width", "bigint"), ("masked", "bigint"))
TOTALS = (("samples", "bigint"), ("tokens", "bigint"), ("masked_tokens", "bigint"))
TOTALS_OUT = "step bigint, samples bigint, tokens bigint, masked_tokens bigint"
PROGRESS = f"run bigint, {TOTALS_OUT}"


def stream_progress(steps: DataFrame, devices: int, delay: str = "10 minutes", expire: str | None = None) -> DataFrame:
    """Every step with its run's totals so far, as a stream, from steps in any order within ``delay``.

    Totals are keyed state: a restart goes on from its checkpoint, nothing is left behind per micro-batch, and with ``expire`` runs that
    have ended are forgotten. Steps count in order of time once the watermark has passed them.
    """

    def advance(entries: tuple, rows: pd.DataFrame, stretch: np.ndarray) -> tuple[list, pd.DataFrame, np.ndarray]:
        added = (rows["rows"] * devices, rows["rows"] * rows["width"] * devices, rows["masked"])
        begins = np.flatnonzero(np.r_[True, stretch[1:] != stretch[:-1]])
        upto = []
        for entry, values in zip(entries, (a.to_numpy() for a in added)):
            sums = values.cumsum()
            upto.append(sums + (entry - sums[begins] + values[begins])[stretch])
        ends = np.r_[begins[1:], len(rows)] - 1
        found = pd.DataFrame({"step": rows["step"]} | {name: sums for (name, _), sums in zip(TOTALS, upto)})
        return [sums[ends] for sums in upto], found, np.arange(len(rows))

    return in_event_order(steps, "run", VALUES, TOTALS, (0, 0, 0), advance, TOTALS_OUT, delay, expire=expire)
