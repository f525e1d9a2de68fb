"""Named datasets: where they lie, their schema, and the task they are prepared for."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from corpusloom.operators.documents import (
    binary_label,
    majority_level,
    nonempty,
    sentiment_label,
    without_quality_warnings,
)
from corpusloom.sources import readers

# Dataset names and the task each is prepared for.
TASKS = {
    "c4": "pre-training",
    "cc100": "pre-training",
    "CulturaX": "pre-training",
    "germanquad": "question-answering",
    "germeval_A": "sequence-classification",
    "germeval_B": "sequence-classification",
    "germeval_24": "sequence-classification",
    "wikipedia": "pre-training",
    "oscar2023": "pre-training",
}


#: Fields that files may lack: keys are numbered on read, metadata is a filter's.
KEYS = ("doc_id", "line_id", "id", "meta")


@dataclass(frozen=True)
class Location:
    """Paths of a dataset; ``dev`` only where a development set is provided."""

    train: str
    dev: str | None = None
    format: str = "json"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path matches anything, on whatever file system it names."""
    jvm = spark._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(path)
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return found is not None and len(found) > 0


def task_of(name: str) -> str:
    if name not in TASKS:
        raise ValueError(f"unknown dataset: {name}")
    return TASKS[name]


def load_dataset(
    spark: SparkSession, name: str, locations: Mapping[str, Location]
) -> tuple[DataFrame, DataFrame | None]:
    """Train and, where provided, dev rows of a named dataset, cleaned and labelled for its task."""
    task_of(name)
    if name not in locations:
        raise ValueError(f"no location for dataset {name}")
    place = locations[name]
    for path in filter(None, (place.train, place.dev)):
        if not exists(spark, path):
            raise FileNotFoundError(f"{path}: please put the {name} files there first")
    prepare = _PREPARE.get(name, _corpus)
    return prepare(spark, name, place.train, place), (
        prepare(spark, name, place.dev, place) if place.dev else None
    )


def _read(spark: SparkSession, path: str, place: Location, schema: str) -> DataFrame:
    if place.format == "json":
        rows = readers.read_jsonl(spark, path, schema)
        return readers.refuse_misfits(rows, path, [f for f in rows.columns if f not in KEYS])
    if place.format == "csv":
        return readers.read_tsv(spark, path, schema)
    return spark.read.schema(schema).format(place.format).load(path)


def _corpus(spark, name, path, place):
    return readers.keyed(_read(spark, path, place, readers.CORPUS), "doc_id")


def _lines(spark, name, path, place):
    return readers.keyed(_read(spark, path, place, readers.LINES), "line_id")


def _with_meta(spark, name, path, place):
    rows = readers.keyed(_read(spark, path, place, readers.CORPUS_WITH_META), "doc_id")
    return without_quality_warnings(rows).select("doc_id", "text")


def _reviews(spark, name, path, place):
    rows = nonempty(readers.with_row_ids(_read(spark, path, place, readers.REVIEWS)))
    label = binary_label(rows["relevance"]) if name == "germeval_A" else sentiment_label(rows["sentiment"])
    return rows.select("text", label.alias("label"), "doc_id")


def _annotated(spark, name, path, place):
    rows = readers.keyed(_read(spark, path, place, readers.ANNOTATED), "doc_id")
    return rows.withColumn("label", majority_level(rows["annotations"]))


def _qa(spark, name, path, place):
    return readers.keyed(_read(spark, path, place, readers.QA), "id")


_PREPARE = {
    "cc100": _lines,
    "oscar2023": _with_meta,
    "germeval_A": _reviews,
    "germeval_B": _reviews,
    "germeval_24": _annotated,
    "germanquad": _qa,
}
