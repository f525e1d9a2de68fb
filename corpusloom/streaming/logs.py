"""The metric log as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

METRIC_LOG = "run bigint, step bigint, ts timestamp, metric string, value double"


def read_metric_stream(spark: SparkSession, path: str, schema: str = METRIC_LOG, files_per_trigger: int | None = None) -> DataFrame:
    """Rows of parquet files as they appear in a folder."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def deduplicated(stream: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Drop repeated (run, step, metric) rows and rows that arrive later than ``delay``."""
    return stream.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["run", "step", "metric"])
