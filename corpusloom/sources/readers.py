"""Readers for the corpus formats. Schemas are given, so no pass is spent on inference; files that do not fit are refused."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from corpusloom.functions.text import without_rule_lines
from corpusloom.operators.ordering import Order, head

CORPUS = "doc_id bigint, text string"
LINES = "line_id bigint, text string"
CORPUS_WITH_META = "doc_id bigint, text string, meta struct<quality_warnings:array<string>>"
# Column names of the review files, which have no header.
REVIEWS = "url string, text string, relevance boolean, sentiment string, aspect string"
ANNOTATED = "doc_id bigint, text string, annotations array<struct<user:string,label:string>>"
QA = "id bigint, question string, context string, answers struct<text:array<string>,answer_start:array<int>>"
TOKENS = "doc_id bigint, input_ids array<int>"


def read_jsonl(spark: SparkSession, path: str, schema: str = CORPUS) -> DataFrame:
    return spark.read.schema(schema).json(path)


def field_types(lines: DataFrame, column: str = "value") -> DataFrame:
    """The fields of JSON lines as they are: ``field``, ``n_rows`` that have it, ``type`` that holds all its values.

    Types of rows merge pairwise on the way to the shuffle: VOID (null) gives way to any other, numbers widen, objects and
    arrays merge by field and element, and what else differs is VARIANT. Lines that are no JSON object count under the
    null field, with type INVALID; blank lines are nothing.
    """
    parsed = lines.where(F.trim(column) != "").select(F.try_parse_json(column).alias("_row"))
    whole = F.schema_of_variant("_row").startswith("OBJECT<")
    fields = parsed.where(whole).lateralJoin(lines.sparkSession.tvf.variant_explode(F.col("_row").outer()))
    found = fields.groupBy(F.col("key").alias("field")).agg(F.count("*").alias("n_rows"), F.schema_of_variant_agg("value").alias("type"))
    invalid = parsed.where(~F.coalesce(whole, F.lit(False))).agg(F.count("*").alias("n_rows")).where("n_rows > 0")
    return found.unionByName(invalid.select(F.lit(None).cast("string").alias("field"), "n_rows", F.lit("INVALID").alias("type")))


def _fits(found: str, wanted: T.DataType) -> bool:
    """Whether the reader can take values of a found type as the wanted one; strings take no objects or arrays."""
    if found == "VOID":
        return True
    if isinstance(wanted, T.ArrayType):
        return found.startswith("ARRAY<")
    if isinstance(wanted, T.StructType):
        return found.startswith("OBJECT<")
    return found == wanted.simpleString().upper()


def refuse_misfits(rows: DataFrame, path: str, fields: list[str]) -> DataFrame:
    """The rows of JSON lines, or a ValueError that names what their files hold instead of ``fields``.

    A field with a value in any row is taken as there, which the first rows tell. Only otherwise are the files read
    through, for their fields and types. Files without rows, or with nulls alone, are no error.
    """
    unseen = [f for f in fields if not rows.where(F.col(f).isNotNull()).select(F.lit(1)).head(1)]
    if not unseen:
        return rows
    found = {r.field: (r.n_rows, r.type) for r in field_types(rows.sparkSession.read.text(path)).collect()}
    wrong = [f for f in unseen if found and (f not in found or not _fits(found[f][1], rows.schema[f].dataType))]
    if wrong:
        held = ", ".join(f"{k} {t} ({n} rows)" for k, (n, t) in sorted(found.items(), key=str))
        raise ValueError(f"{path}: no usable field {', '.join(wrong)}; the files hold {held}")
    return rows


def read_tsv(spark: SparkSession, path: str | list[str], schema: str = REVIEWS) -> DataFrame:
    """Tab-separated rows without a header."""
    return spark.read.schema(schema).option("sep", "\t").option("multiLine", True).option("escape", '"').csv(path)


def _place_in_split(split: Column) -> Column:
    """The number of earlier rows of the same split in the task, which reads a split from end to end before the next."""

    def places(splits: Iterator[pa.Array]) -> Iterator[pa.Array]:
        last, seen = None, 0
        for batch in splits:
            names = batch.to_numpy(zero_copy_only=False)
            begins = np.flatnonzero(np.r_[len(names) > 0, names[1:] != names[:-1]])
            ends = np.r_[begins[1:], len(names)] if len(begins) else begins
            place = np.arange(len(names)) - np.repeat(begins, ends - begins)
            if len(names):
                if names[0] == last:
                    place[: ends[0]] += seen
                last, seen = names[-1], int(place[-1]) + 1
            yield pa.array(place, pa.int64())

    return F.arrow_udf(places, "bigint").asNondeterministic()(split)


def with_row_ids(rows: DataFrame, name: str = "doc_id") -> DataFrame:
    """Number the rows of a file scan from 0 without gaps: by path, place in the file, and row.

    Spark deals file splits to tasks in any order, but the rows of a split follow each other. One scan counts the rows of
    each split, another numbers them, so the rows themselves are not written; a split that was not counted is an error.
    """
    placed = rows.withColumns({"_file": F.col("_metadata.file_path"), "_block": F.col("_metadata.file_block_start")})
    splits = placed.groupBy("_file", "_block").agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)  # a row per file split
    starts = splits.withColumn("_start", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    numbered = placed.withColumn("_at", _place_in_split(F.xxhash64("_file", "_block")))
    lost = F.raise_error(F.lit("the files were split otherwise when their rows were counted")).cast("bigint")
    number = F.when(F.col("_at") < F.col("_rows"), F.col("_start") + F.col("_at")).otherwise(lost).alias(name)
    return numbered.join(F.broadcast(starts), ["_file", "_block"], "left").select(number, *rows.columns)


def keyed(rows: DataFrame, key: str) -> DataFrame:
    """The rows of a file scan with their key; files without one have their rows numbered.

    Files have the key in all rows or in none: the first row tells, and a null among given keys is an error later.
    """
    first = rows.select(key).head(1)
    return with_row_ids(rows.drop(key), key).select(*rows.columns) if first and first[0][0] is None else rows


def read_text_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every file below ``folder`` whose name ends in ``txt`` as one row, rule lines removed; adds ``path``."""
    files = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*txt")
        .text(folder, wholetext=True)
    )
    return files.select(without_rule_lines(F.col("value")).alias("text"), F.input_file_name().alias("path"))


def merge_books_and_articles(books: DataFrame, articles: DataFrame | None) -> DataFrame:
    """One corpus of ``text`` with its ``origin``; books come first when ordered by ``part``."""
    out = books.select("text", F.lit("books").alias("origin"), F.lit(0).alias("part"))
    if articles is None:
        return out
    return out.unionByName(articles.select("text", F.lit("articles").alias("origin"), F.lit(1).alias("part")))


def leading_percent(df: DataFrame, percent: float, order: Order, keys: list[str]) -> DataFrame:
    """The first ``percent`` of the rows in the given order, rounded to whole rows (half to even)."""
    return head(df, order, keys, lambda n: round(n * percent / 100))
