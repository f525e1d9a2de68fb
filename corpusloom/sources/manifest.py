"""The manifest: which split file holds how many rows of which length."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F


def file_name(role: Column, part: Column, alone: Column) -> Column:
    """``train.jsonl`` for a single part, ``train_0.jsonl`` and so on otherwise."""
    return F.concat(role, F.when(alone, F.lit("")).otherwise(F.concat(F.lit("_"), part.cast("string"))), F.lit(".jsonl"))


def build_manifest(rows: DataFrame) -> DataFrame:
    """``file, role, part, seq_len, size`` from rows tagged with role, part and seq_len."""
    counts = rows.groupBy("role", "part", "seq_len").agg(F.count(F.lit(1)).alias("size"))
    alone = F.count(F.lit(1)).over(Window.partitionBy("role")) == 1
    return counts.select(file_name(F.col("role"), F.col("part"), alone).alias("file"), "role", "part", "seq_len", "size")


def with_paths(manifest: DataFrame) -> DataFrame:
    """Add ``path``, the split's folder below the data folder."""
    return manifest.withColumn("path", F.format_string("role=%s/part=%d", "role", "part"))


def write_manifest(manifest: DataFrame, path: str) -> None:
    manifest.coalesce(1).write.mode("overwrite").json(path)  # a handful of rows


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("file string, role string, part int, seq_len int, size bigint, path string").json(path)


def route(manifest: DataFrame) -> DataFrame:
    """Add the role's file position, the metric of each dev file and whether it is monitored.

    Files are taken in name order; the last dev file is the monitored one.
    """
    role = F.when(F.startswith("file", F.lit("train")), "train").when(F.startswith("file", F.lit("dev")), "dev")
    by_name = Window.partitionBy("role").orderBy("file")  # a manifest has a handful of rows
    metric = F.when(F.col("role") == "dev", F.concat(F.lit("val/loss_"), F.col("seq_len").cast("string")))
    return (
        manifest.withColumn("role", role)
        .where("role is not null")
        .withColumns({"position": (F.row_number().over(by_name) - 1).cast("bigint"), "metric": metric})
        .withColumn(
            "monitored",
            (F.col("role") == "dev") & (F.col("position") == F.max("position").over(Window.partitionBy("role"))),
        )
    )
