import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from corpusloom.functions.text import RULE_LINE, WHITESPACE, document_text, strip_accents, without_rule_lines, words
from corpusloom.operators.documents import (
    lines_to_documents,
    majority_level,
    nonempty,
    sentiment_label,
    without_blank_documents,
    without_quality_warnings,
)


def one(spark, column, *values, schema="x string"):
    return spark.createDataFrame([values], schema).select(column).first()[0]


def test_lines_close_at_breaks_and_the_tail_is_dropped(spark):
    texts = ["a\n", "b\n", "\n", "c\n", "\n", "\n", "d\n"]
    lines = spark.createDataFrame(list(enumerate(texts)), "line_id bigint, text string").repartition(5)
    got = {r.doc_id: r.text for r in lines_to_documents(lines).collect()}
    assert got == {0: "a\nb\n", 1: "c\n", 2: ""}


def test_lines_are_grouped_across_bucket_borders(spark):
    texts = [("\n" if i % 7 == 6 else f"{i};") for i in range(2000)]
    lines = spark.createDataFrame(list(enumerate(texts)), "line_id bigint, text string").repartition(9)
    want, doc = [], ""
    for t in texts:
        if t == "\n":
            want.append(doc)
            doc = ""
        else:
            doc += t
    got = [r.text for r in lines_to_documents(lines).orderBy("doc_id").collect()]
    assert got == want


def test_blank_rules(spark):
    rows = spark.createDataFrame([(None,), ("",), ("\n",), ("  ",), ("x",)], "text string")
    assert [r.text for r in nonempty(rows).collect()] == ["\n", "  ", "x"]
    assert sorted(r.text for r in without_blank_documents(rows).collect()) == ["  ", "x"]


def test_quality_warnings(spark):
    rows = spark.createDataFrame(
        [(0, (None,)), (1, ([],)), (2, (["tiny"],)), (3, (["other"],)), (4, None), (5, (["other", "adult"],))],
        "doc_id int, meta struct<quality_warnings:array<string>>",
    )
    assert [r.doc_id for r in without_quality_warnings(rows).orderBy("doc_id").collect()] == [0, 1, 3, 4]
    assert without_quality_warnings(rows.select("doc_id")).count() == 6


def test_majority_vote(spark):
    names = ["0-Kein", "1-Gering", "2-Vorhanden", "3-Stark", "4-Extrem"]
    schema = "x array<struct<user:string,label:string>>"

    def vote(levels):
        return one(spark, majority_level(F.col("x")), [("u", names[v]) for v in levels], schema=schema)

    assert vote([0, 2, 2, 0, 4]) == 0
    assert vote([3, 3, 1]) == 3
    assert vote([]) is None
    with pytest.raises(PySparkException):
        one(spark, majority_level(F.col("x")), [("u", "5-Mehr")], schema=schema)


def test_sentiment(spark):
    got = [one(spark, sentiment_label(F.col("x")), s) for s in ("positive", "neutral", "negative", "other", None)]
    assert got == [2, 1, 0, 0, 0]


def test_document_text_strips_like_the_standard_library(spark):
    assert set(WHITESPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}
    for text in ("　 a b\r\n\t", "  ", "x"):
        assert one(spark, document_text(F.col("x")), text) == text.strip() + "\n"


def test_rule_lines_are_literal(spark):
    text = f"a{RULE_LINE}b{RULE_LINE[2:]}c"
    assert one(spark, without_rule_lines(F.col("x")), text) == text.replace(RULE_LINE, "")


def test_words(spark):
    assert one(spark, words(F.col("x")), "Übergrößen, l'été!") == ["ubergroßen", ",", "l", "'", "ete", "!"]
    assert one(spark, words(F.col("x"), True), "Été​ 中文a") == ["été", "中", "文", "a"]
    assert one(spark, strip_accents(F.col("x")), "éǆ") == "eǆ"
