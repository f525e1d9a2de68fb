"""Tokens per second per interval on a stream."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

VALUES = ("tokens", "millis")


def windowed_throughput(steps: DataFrame, interval: str = "1 hour", delay: str | None = "10 minutes") -> DataFrame:
    """``run, window, tokens, millis, tokens_per_sec`` per event-time interval; rows later than ``delay`` are dropped.

    Pass ``delay=None`` for a stream that already carries a watermark.
    """
    timed = steps.withWatermark("ts", delay) if steps.isStreaming and delay else steps
    sums = timed.groupBy(F.window("ts", interval), "run").agg(*[F.sum(v).alias(v) for v in VALUES])
    return sums.withColumn("tokens_per_sec", F.when(F.col("millis") > 0, F.col("tokens") / (F.col("millis") / 1000)))


def write_throughput(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Write each micro-batch's changed intervals; ``read_throughput`` keeps the newest version of each."""

    def step(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(os.path.join(out, f"batch={batch_id}"))

    return (
        stream.writeStream.outputMode("update")
        .foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_throughput(spark, out: str) -> DataFrame:
    rows = spark.read.parquet(out)
    newest = F.max_by(F.struct(*VALUES, "tokens_per_sec"), "batch").alias("newest")
    return rows.groupBy("run", "window").agg(newest).select("run", "window", "newest.*")
