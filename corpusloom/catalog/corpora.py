"""Reading, writing, cleaning and labelling corpora."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from corpusloom.catalog.inputs import QUESTIONS_SQL, REVIEWS_SQL, annotations, documents, lines, questions, reviews, table
from corpusloom.catalog.registry import query
from corpusloom.functions.text import RULE_LINE
from corpusloom.operators.documents import (
    binary_label,
    lines_to_documents,
    majority_level,
    nonempty,
    sentiment_label,
    without_blank_documents,
    without_quality_warnings,
)
from corpusloom.operators.ordering import Order
from corpusloom.session import scratch_path
from corpusloom.sources import readers
from corpusloom.sources.registry import TASKS, Location, load_dataset
from corpusloom.sources.sinks import append_results, read_parameters, read_results, with_role, write_parameters, write_splits


@query("SELECT 'train' AS role, doc_id, text FROM documents WHERE lang <> 'de' UNION ALL SELECT 'dev', doc_id, text FROM documents WHERE lang = 'de'")
def jsonl_roundtrip(spark, sf_dir):
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    german = F.col("lang") == "de"
    path = scratch_path(spark, "jsonl")
    write_splits(with_role(docs.where(~german).drop("lang"), docs.where(german).drop("lang")), path, "json")
    return spark.read.schema(f"{readers.CORPUS}, role string, part int").json(path).select("role", "doc_id", "text")


@query(
    """SELECT 'doc_id' AS field, count(*) AS n_rows, 'VARIANT' AS type FROM documents WHERE lang IS NOT NULL
    UNION ALL SELECT 'text', count(text), 'STRING' FROM documents WHERE lang <> 'de' HAVING count(text) > 0
    UNION ALL SELECT 'body', count(text), 'STRING' FROM documents WHERE lang = 'de' HAVING count(text) > 0
    UNION ALL SELECT 'about', count(*), 'OBJECT<chars: BIGINT, lang: STRING>' FROM documents WHERE lang = 'de' HAVING count(*) > 0"""
)
def field_types(spark, sf_dir):
    """German documents come with another key, text field and an object more."""
    docs = documents(spark, sf_dir, "doc_id", "text", "lang").where("lang is not null")
    german = F.col("lang") == "de"
    about = F.struct(F.length("text").cast("bigint").alias("chars"), "lang").alias("about")
    other = docs.where(german).select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").alias("body"), about)
    plain = docs.where(~german).select("doc_id", "text")
    lines = [F.to_json(F.struct(*[F.col(c) for c in d.columns])) for d in (plain, other)]
    path = scratch_path(spark, "mixed")
    plain.select(lines[0].alias("value")).union(other.select(lines[1].alias("value"))).write.text(path)
    return readers.field_types(spark.read.text(path))


def _write_reviews(rows, path):
    rows.write.options(
        sep="\t", quoteAll=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)


@query(
    f"""SELECT 'doc/'||doc_id AS url, text, CAST(relevance AS BIGINT) AS relevance, sentiment, lang AS aspect
    FROM {REVIEWS_SQL} r"""
)
def tsv_scan(spark, sf_dir):
    path = scratch_path(spark, "reviews")
    for side, toxic in (("train", "sentiment <> 'neutral'"), ("dev", "sentiment = 'neutral'")):
        _write_reviews(reviews(spark, sf_dir).where(toxic), os.path.join(path, side))
    rows = readers.read_tsv(spark, [os.path.join(path, "train"), os.path.join(path, "dev")])
    return nonempty(rows).withColumn("relevance", binary_label(F.col("relevance")).cast("bigint"))


@query(
    """SELECT 'books' AS origin, text||' end'||chr(10) AS text FROM documents WHERE lang = 'de'
    UNION ALL SELECT 'articles', text FROM documents WHERE lang <> 'de'"""
)
def wholetext_union(spark, sf_dir):
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    path = scratch_path(spark, "books")
    with_rule = F.concat("text", F.lit(RULE_LINE), F.lit(" end"))
    docs.where("lang = 'de'").select("doc_id", with_rule).write.partitionBy("doc_id").text(os.path.join(path, "books"))
    docs.where("lang <> 'de'").select("doc_id", "text").write.json(os.path.join(path, "articles"))
    books = readers.read_text_files(spark, os.path.join(path, "books"))
    articles = readers.read_jsonl(spark, os.path.join(path, "articles"))
    return readers.merge_books_and_articles(books, articles).select("origin", "text")


@query(
    """SELECT lang AS run_name, CAST(count(*) AS DOUBLE) AS result FROM documents GROUP BY 1
    UNION ALL SELECT source, CAST(sum(n_chars) AS DOUBLE) FROM documents GROUP BY 1"""
)
def results_append(spark, sf_dir):
    docs = documents(spark, sf_dir, "lang", "source", "n_chars", "doc_id")
    path = scratch_path(spark, "results")
    append_results(docs.groupBy(F.col("lang").alias("run_name")).agg(F.count("*").cast("double").alias("result")), path)
    append_results(docs.groupBy(F.col("source").alias("run_name")).agg(F.sum("n_chars").cast("double").alias("result")), path)
    return read_results(spark, path)


_META_SQL = """(
  SELECT doc_id, text, source, n_chars < 200 AS tiny,
    length(text) - length(replace(replace(replace(text, '#', ''), '%', ''), '*', '')) > 0.02 * length(text) AS noisy,
    n_chars < 40 * len(string_split(text, chr(10))) AS short
  FROM documents)"""


def _with_meta(spark, sf_dir):
    marks = F.length("text") - F.length(F.translate("text", "#%*", ""))
    found = F.array_compact(
        F.array(
            F.when(F.col("n_chars") < 200, "tiny"),
            F.when(marks > 0.02 * F.length("text"), "noisy"),
            F.when(F.col("n_chars") < 40 * F.size(F.split("text", "\n")), "short_sentences"),
            F.when(F.col("lang") == "de", "language"),
        )
    )
    meta = F.struct(F.when(F.size(found) > 0, found).alias("quality_warnings"))
    return documents(spark, sf_dir, "doc_id", "text", "n_chars", "lang").select("doc_id", "text", meta.alias("meta"))


@query(f"SELECT doc_id, text FROM {_META_SQL} m WHERE NOT tiny AND NOT noisy AND NOT short")
def quality_warning_filter(spark, sf_dir):
    return without_quality_warnings(_with_meta(spark, sf_dir)).select("doc_id", "text")


@query(
    f"""SELECT name, task, n, chars FROM (
      SELECT count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars FROM documents) d,
      (VALUES ('c4','pre-training'),('CulturaX','pre-training'),('wikipedia','pre-training')) t(name, task)
    UNION ALL
    SELECT 'oscar2023', 'pre-training', count(*), CAST(sum(length(text)) AS BIGINT)
    FROM {_META_SQL} m WHERE NOT tiny AND NOT noisy AND NOT short
    UNION ALL
    SELECT 'cc100', 'pre-training', CAST(sum(len(string_split(text, chr(10))) + 1) AS BIGINT), CAST(sum(length(text) + 2) AS BIGINT)
    FROM documents
    UNION ALL
    SELECT name, 'sequence-classification', n, chars FROM (
      SELECT count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars FROM {REVIEWS_SQL} r) d,
      (VALUES ('germeval_A'),('germeval_B'),('germeval_24')) t(name)
    UNION ALL
    SELECT 'germanquad', 'question-answering', count(*), CAST(sum(length(context)) AS BIGINT) FROM {QUESTIONS_SQL} q"""
)
def source_registry(spark, sf_dir):
    """All named datasets, read from files without key columns; every row has a key of its own afterwards."""
    path = scratch_path(spark, "registry")

    def placed(rows, name):
        rows.write.json(os.path.join(path, name))
        return Location(os.path.join(path, name))

    _write_reviews(reviews(spark, sf_dir), os.path.join(path, "reviews"))
    plain = placed(documents(spark, sf_dir, "text"), "plain")
    labelled = Location(os.path.join(path, "reviews"), format="csv")
    answers = F.struct(F.array("answer_text").alias("text"), F.array("answer_start").alias("answer_start"))
    places = {
        "c4": plain,
        "CulturaX": plain,
        "wikipedia": plain,
        "oscar2023": placed(_with_meta(spark, sf_dir).drop("doc_id"), "meta"),
        "cc100": placed(lines(spark, sf_dir).select("text"), "lines"),
        "germeval_A": labelled,
        "germeval_B": labelled,
        "germeval_24": placed(annotations(spark, sf_dir).drop("doc_id"), "votes"),
        "germanquad": placed(questions(spark, sf_dir).select("question", "context", answers.alias("answers")), "questions"),
    }
    out = None
    for name in places:
        train, _ = load_dataset(spark, name, places)
        key = next(c for c in ("doc_id", "line_id", "id") if c in train.columns)
        text = "context" if "context" in train.columns else "text"
        row = train.agg(F.count_distinct(key).alias("n"), F.sum(F.length(text)).alias("chars")).select(
            F.lit(name).alias("name"), F.lit(TASKS[name]).alias("task"), "n", "chars"
        )
        out = row if out is None else out.unionByName(row)
    return out


@query(
    """SELECT doc_id, n_chars FROM (SELECT *, row_number() OVER (ORDER BY doc_id) AS rn, count(*) OVER () AS n FROM documents)
    WHERE rn <= round_even(n * 0.35, 0)"""
)
def head_percent(spark, sf_dir):
    docs = documents(spark, sf_dir, "doc_id", "n_chars")
    return readers.leading_percent(docs, 35, Order.of_id("doc_id"), ["doc_id"])


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def raw_passthrough(spark, sf_dir):
    path = scratch_path(spark, "raw")
    write_splits(with_role(table(spark, sf_dir, "documents"), None), path)
    return spark.read.parquet(path).select("doc_id", "text", "lang", "source", "n_chars")


@query(
    """SELECT 'seed' AS name, '42' AS value UNION ALL SELECT 'strategy', 'naive'
    UNION ALL SELECT 'documents', CAST(count(*) AS VARCHAR) FROM documents"""
)
def run_params(spark, sf_dir):
    path = scratch_path(spark, "params")
    size = table(spark, sf_dir, "documents").count()
    write_parameters(spark, {"seed": 42, "strategy": "naive", "documents": size}, path)
    return read_parameters(spark, path)


@query("SELECT text FROM documents")
def project_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("text")


# blank rows do not occur in the test table, so four per hundred are made from its own rows
_BLANKED_SQL = """(
  SELECT doc_id, CASE n_chars % 100 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN chr(10) WHEN 3 THEN '  ' ELSE text END AS text
  FROM documents)"""


def _with_blanks(spark, sf_dir):
    kind = F.col("n_chars") % 100
    text = (
        F.when(kind == 0, F.lit(None)).when(kind == 1, "").when(kind == 2, "\n").when(kind == 3, "  ").otherwise(F.col("text"))
    )
    return table(spark, sf_dir, "documents").select("doc_id", text.alias("text"))


@query(f"SELECT doc_id, text FROM {_BLANKED_SQL} b WHERE text IS NOT NULL AND text <> ''")
def nonempty_filter(spark, sf_dir):
    return nonempty(_with_blanks(spark, sf_dir))


@query(f"SELECT doc_id, text FROM {_BLANKED_SQL} b WHERE text NOT IN ('', chr(10))")
def blank_doc_filter(spark, sf_dir):
    return without_blank_documents(_with_blanks(spark, sf_dir))


@query(f"SELECT doc_id, CAST(relevance AS BIGINT) AS label FROM {REVIEWS_SQL} r WHERE text <> ''")
def label_binary(spark, sf_dir):
    rows = nonempty(reviews(spark, sf_dir))
    doc_id = F.substring_index("url", "/", -1).cast("bigint").alias("doc_id")
    return rows.select(doc_id, binary_label(F.col("relevance")).cast("bigint").alias("label"))


@query(
    f"""SELECT doc_id, CAST(CASE WHEN sentiment = 'positive' THEN 2 WHEN sentiment = 'neutral' THEN 1 ELSE 0 END AS BIGINT) AS label
    FROM {REVIEWS_SQL} r WHERE text <> ''"""
)
def label_sentiment(spark, sf_dir):
    rows = nonempty(reviews(spark, sf_dir))
    doc_id = F.substring_index("url", "/", -1).cast("bigint").alias("doc_id")
    return rows.select(doc_id, sentiment_label(F.col("sentiment")).cast("bigint").alias("label"))


VOTES_SQL = """(
  SELECT doc_id, level, count(*) AS n FROM (
    SELECT doc_id, (('0x'||substr(md5(doc_id||'|'||k),1,8))::BIGINT) % 5 AS level
    FROM documents JOIN labels USING (doc_id), (VALUES (0),(1),(2),(3),(4)) t(k))
  GROUP BY ALL)"""

MAJORITY_SQL = f"""(
  SELECT doc_id, level AS label FROM (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, level) AS rn FROM {VOTES_SQL} v) WHERE rn = 1)"""


@query(f"SELECT doc_id, CAST(label AS BIGINT) AS label FROM {MAJORITY_SQL} m")
def label_majority_vote(spark, sf_dir):
    return annotations(spark, sf_dir).select("doc_id", majority_level(F.col("annotations")).cast("bigint").alias("label"))


@query("SELECT row_number() OVER (ORDER BY doc_id) - 1 AS doc_id, text||chr(10) AS text FROM documents")
def lines_to_documents_query(spark, sf_dir):
    return lines_to_documents(lines(spark, sf_dir), id_bits=50)
