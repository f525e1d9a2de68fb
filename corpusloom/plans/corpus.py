"""From a named dataset to files on disk: the whole build in one call."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.operators.documents import lines_to_documents
from corpusloom.operators.metrics import length_stats
from corpusloom.operators.ordering import Order, discard_fraction
from corpusloom.operators.tokenizer import WordPiece, encode_pretraining
from corpusloom.plans.finetuning import build_finetuning, encode_for_task
from corpusloom.plans.pretraining import build_pretraining, pretraining_manifest
from corpusloom.plans.settings import BuildSettings
from corpusloom.session import materialize
from corpusloom.sources.manifest import with_paths, write_manifest
from corpusloom.sources.readers import leading_percent
from corpusloom.sources.registry import Location, load_dataset, task_of
from corpusloom.sources.sinks import with_role, write_parameters, write_splits

# Fixed value: the dataset that comes as one row per line.
LINE_CORPUS = "cc100"


def _loaded(spark, name, locations, settings) -> tuple[DataFrame, DataFrame | None, str]:
    train, dev = load_dataset(spark, name, locations)
    key = "line_id" if name == LINE_CORPUS else "id" if task_of(name) == "question-answering" else "doc_id"
    if settings.percent < 100:
        train = leading_percent(train, settings.percent, Order.of_id(key, bits=64), [key])
    if settings.discard:
        train = discard_fraction(train, [key], settings.discard, settings.seed)
        dev = None if dev is None else discard_fraction(dev, [key], settings.discard, settings.seed)
    return train, dev, key


def write_raw(
    spark: SparkSession, name: str, locations: Mapping[str, Location], settings: BuildSettings, out: str, fmt: str = "json"
) -> None:
    """Write the loaded rows as they are (after any discarding)."""
    train, dev, _ = _loaded(spark, name, locations, settings)
    write_splits(with_role(train, dev), os.path.join(out, "data"), fmt)


def dataset_stats(
    spark: SparkSession, name: str, locations: Mapping[str, Location], tokenizer: WordPiece, settings: BuildSettings
) -> DataFrame:
    """Length statistics of the encoded rows, with their ``role``: train, and dev where the dataset comes with one."""
    train, dev, _ = _loaded(spark, name, locations, settings)
    if task_of(name) == "pre-training":
        encoded = encode_pretraining(lines_to_documents(train, id_bits=settings.id_bits) if name == LINE_CORPUS else train, tokenizer)
        return length_stats(encoded).withColumn("role", F.lit("train"))
    sides = {"train": train} if dev is None else {"train": train, "dev": dev}
    stats = [
        length_stats(encode_for_task(rows, tokenizer, task_of(name), settings)).withColumn("role", F.lit(role))
        for role, rows in sides.items()
    ]
    return stats[0] if len(stats) == 1 else stats[0].unionByName(stats[1])


def prepare_dataset(
    spark: SparkSession,
    name: str,
    locations: Mapping[str, Location],
    tokenizer: WordPiece,
    settings: BuildSettings,
    out: str,
    fmt: str = "parquet",
) -> None:
    """Load, encode, split and write ``out/data``, ``out/manifest`` (pre-training) and ``out/parameters``."""
    train, dev, key = _loaded(spark, name, locations, settings)
    task = task_of(name)
    if task == "pre-training":
        docs = lines_to_documents(train, id_bits=settings.id_bits) if name == LINE_CORPUS else train
        splits = materialize(build_pretraining(docs, tokenizer, settings), "splits")
        write_splits(splits, os.path.join(out, "data"), fmt, order=("row_key",))
        write_manifest(with_paths(pretraining_manifest(splits)), os.path.join(out, "manifest"))
    else:
        keys = (key, "window") if task == "question-answering" else (key,)
        rows = with_role(*build_finetuning(train, dev, tokenizer, task, settings, keys))
        rows = materialize(rows, "finetune-splits")
        write_splits(rows, os.path.join(out, "data"), fmt, order=("shuffle_key", *keys))
    write_parameters(spark, {"dataset": name, **asdict(settings)}, os.path.join(out, "parameters"))
