"""Plateau detection on a stream of validation losses."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from corpusloom.streaming.reorder import in_event_order

SWITCHES_OUT = "step bigint, switch_no bigint"
SWITCHES = f"run bigint, {SWITCHES_OUT}"
VALUES = (("step", "bigint"), ("loss", "double"))
STATE = (("best", "double"), ("wait", "bigint"), ("switches", "bigint"))


def _detector(patience: int, min_delta: float, datasets: int, mode: str):
    sign = 1.0 if mode == "min" else -1.0

    def advance(entries: tuple, losses: pd.DataFrame, stretch: np.ndarray) -> tuple[list, pd.DataFrame, np.ndarray]:
        ends = [entry.tolist() for entry in entries]
        due, at, (best, wait, switches) = [], None, (0.0, 0, 0)
        for place, (number, step, loss) in enumerate(zip(stretch.tolist(), losses["step"].tolist(), (losses["loss"] * sign).tolist())):
            if number != at:
                at, (best, wait, switches) = number, (end[number] for end in ends)
            if loss + min_delta < best:
                best, wait = loss, 0
            else:
                wait += 1
                if wait >= patience:
                    wait = 0
                    if switches < datasets - 1:
                        switches += 1
                        due.append((place, step, switches))
            ends[0][number], ends[1][number], ends[2][number] = best, wait, switches
        found = pd.DataFrame(due, columns=["place", "step", "switch_no"]).astype("int64")
        return [np.array(end, dtype=entry.dtype) for end, entry in zip(ends, entries)], found[["step", "switch_no"]].copy(), found["place"].to_numpy()

    return advance


def plateau_stream(losses: DataFrame, patience: int, min_delta: float, datasets: int, mode: str = "min", delay: str = "10 minutes") -> DataFrame:
    """``run, step, switch_no`` as a stream, from ``run, ts, step, loss`` in any order within ``delay``.

    The losses of a run are taken in order of time and step, once the watermark has passed them. State per run is three numbers and the
    losses within the delay.
    """
    return in_event_order(losses, "run", VALUES, STATE, (float("inf"), 0, 0), _detector(patience, min_delta, datasets, mode), SWITCHES_OUT, delay)


def write_rows(rows: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append what a stream releases to a folder, up to all that is there now."""
    return (
        rows.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
