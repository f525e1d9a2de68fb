"""Dataset statistics, training-log aggregates and evaluation measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.operators.ordering import Order, prefix_sums


def length_stats(rows: DataFrame, ids: str = "input_ids") -> DataFrame:
    """Count, minimum, maximum, mean and upper median of the row lengths.

    The upper median ascending is the discrete median descending; its aggregate keeps one counter per distinct
    length, which partial aggregation combines.
    """
    size = F.col("n") if "n" in rows.columns else F.size(ids)
    return rows.select(size.cast("bigint").alias("len")).agg(
        F.count("len").alias("n"),
        F.min("len").alias("min_len"),
        F.max("len").alias("max_len"),
        F.avg("len").alias("mean_len"),
        F.expr("percentile_disc(0.5) within group (order by len desc)").cast("bigint").alias("median_len"),
    )


def split_counts(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("size"))


def accuracy(rows: DataFrame, prediction: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    return rows.groupBy(*by).agg(
        F.avg((F.col(prediction) == F.col(label)).cast("double")).alias("accuracy"), F.count(F.lit(1)).alias("n")
    )


def argmax(scores: Column) -> Column:
    """Zero-based position of the first maximum."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def agreement(predictions: DataFrame, gold: DataFrame, key: str) -> DataFrame:
    """``key, prediction, label, correct``: one row per rated item."""
    return predictions.join(gold, key).select(
        key, "prediction", "label", (F.col("prediction") == F.col("label")).alias("correct")
    )


def masked_mean(rows: DataFrame, vector: str, mask: Column, by: Sequence[str]) -> DataFrame:
    """Mean of the vectors whose mask is 1, per group that has any, as one array.

    Vectors are summed as wholes: every task sends one sum and count per group, so a group of any size is cheap. Null
    vectors are left out; those of one group have equal lengths and no null elements.
    """
    chosen = F.when(mask.cast("boolean") & F.col(vector).isNotNull(), F.col(vector))
    chosen_rows = rows.select(*by, chosen.cast("array<double>").alias("_v")).where("_v is not null")
    return chosen_rows.groupBy(*by).agg(vector_to_array(Summarizer.mean(array_to_vector("_v"))).alias("mean"))


def mean_by_set(log: DataFrame, by: Sequence[str], value: str = "value") -> DataFrame:
    """Mean loss per validation set."""
    return log.groupBy(*by).agg(F.avg(value).alias("mean_loss"), F.count(F.lit(1)).alias("n"))


def throughput(steps: DataFrame, by: Sequence[str], tokens: str = "tokens", millis: str = "millis") -> DataFrame:
    """Tokens per second of elapsed time; null where no time passed."""
    total = F.sum(millis) / 1000
    return steps.groupBy(*by).agg(
        F.sum(tokens).alias("tokens"), F.when(total > 0, F.sum(tokens) / total).alias("tokens_per_sec")
    )


def best_checkpoint(log: DataFrame, by: Sequence[str], value: str = "value", step: str = "step", mode: str = "min") -> DataFrame:
    """The step with the best monitored value per run, the earliest on ties."""
    sign = 1 if mode == "min" else -1
    best = F.min(F.struct((sign * F.col(value)).alias("value"), F.col(step).alias("step")))
    return (
        log.groupBy(*by)
        .agg(best.alias("_best"))
        .select(*by, (sign * F.col("_best.value")).alias("best"), F.col("_best.step").alias("step"))
    )


def device_reduce(log: DataFrame, by: Sequence[str]) -> DataFrame:
    """Across devices: the largest peak memory and the mean elapsed time."""
    return log.groupBy(*by).agg(F.max("memory").alias("max_memory"), F.avg("seconds").alias("avg_seconds"))


def at_interval(log: DataFrame, interval: Column | int, step: str = "step") -> DataFrame:
    """Rows whose step is a multiple of the interval."""
    return log.where(F.col(step) % interval == 0)


def interval_steps(setting: float, goal: int) -> int:
    """An interval below one is a share of the goal."""
    return int(setting * goal) if setting < 1 else int(setting)


def step_budget(manifest: DataFrame, batch_size: int, epochs: int, warmup: float) -> DataFrame:
    """``steps_per_epoch, max_steps, warmup_steps`` per training file."""
    per_epoch = F.ceil(F.col("size") / batch_size)
    return manifest.withColumn("steps_per_epoch", per_epoch).withColumns(
        {
            "max_steps": F.col("steps_per_epoch") * epochs,
            "warmup_steps": F.floor(F.lit(warmup) * (F.col("steps_per_epoch") * epochs)),
        }
    )


# Names of the units a training goal may be given in.
UNITS = ("samples", "tokens", "iters", "optimizer-steps")


def units_per_step(unit: str, batch_size: int, block_size: int | None = None, accumulation: int = 1) -> int:
    """How many of a unit one optimizer step consumes."""
    if unit not in UNITS:
        raise ValueError(f"unknown unit: {unit}")
    if unit == "tokens" and block_size is None:
        raise ValueError("tokens need a block size")
    sizes = {
        "samples": batch_size,
        "tokens": batch_size * (block_size or 0),
        "iters": accumulation,
        "optimizer-steps": 1,
    }
    return sizes[unit]


def in_steps(amount: Column, per_step: int) -> Column:
    """An amount of some unit as whole optimizer steps."""
    return F.floor(amount / per_step)


def running_progress(batches: DataFrame, order: Order, devices: int, by: Sequence[str] = ("run",)) -> DataFrame:
    """Running totals over training steps: samples and tokens count every device, masked tokens do not.

    Reads ``rows, width, masked`` and adds ``samples, tokens, masked_tokens``. Rows of another kind (validation) carry
    zero rows and so repeat the totals reached before them.
    """
    values = {
        "samples": (F.col("rows") * devices).cast("bigint"),
        "tokens": (F.col("rows") * F.col("width") * devices).cast("bigint"),
        "masked_tokens": F.col("masked").cast("bigint"),
    }
    return prefix_sums(batches, order, values, by, inclusive=True)
