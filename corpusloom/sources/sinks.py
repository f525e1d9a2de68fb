"""Writers: split files, run records and result lines."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F


def write_splits(
    rows: DataFrame,
    path: str,
    fmt: str = "parquet",
    by: tuple[str, ...] = ("role", "part"),
    order: tuple[str, ...] = (),
) -> None:
    """One folder per split (``role=train/part=0`` and so on); ``fmt`` is ``parquet`` or ``json``.

    With ``order``, a folder's files taken by name hold its rows in that order: rows are dealt by ranges and sorted in
    each. Pass a written table then, as the ranges are found by reading it once more.
    """
    if order:
        rows = rows.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order)
    rows.write.mode("overwrite").partitionBy(*by).format(fmt).save(path)


def with_role(train: DataFrame | None, dev: DataFrame | None, part: int = 0) -> DataFrame:
    """Tag and unite the two sides; at least one is needed."""
    sides = [
        side.withColumns({"role": F.lit(role), "part": F.lit(part)})
        for role, side in (("train", train), ("dev", dev))
        if side is not None
    ]
    if not sides:
        raise ValueError("at least one of train and dev is needed")
    out = sides[0]
    for side in sides[1:]:
        out = out.unionByName(side)
    return out


def append_results(results: DataFrame, path: str) -> None:
    """Append ``run_name,result`` lines."""
    results.select("run_name", "result").write.mode("append").csv(path)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("run_name string, result double").csv(path)


def write_parameters(spark: SparkSession, parameters: Mapping[str, object], path: str) -> None:
    """The parameters of a run as one JSON row."""
    row = {k: None if v is None else str(v) for k, v in parameters.items()}
    spark.createDataFrame([(row,)], "parameters map<string,string>").coalesce(1).write.mode("overwrite").json(path)


def read_parameters(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("parameters map<string,string>").json(path).select(
        F.explode("parameters").alias("name", "value")
    )
