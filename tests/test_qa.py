import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from corpusloom.operators.qa import (
    best_spans,
    context_windows,
    mean_scores,
    normalized_answer,
    rekeyed_answers,
    span_labels,
    span_mismatch,
    squad_scores,
    top_positions,
)

ENCODED = (
    "id bigint, question_ids array<int>, tokens array<struct<id:int,s:int,e:int>>, answer_start int, answer_text string"
)


def encoded(spark, n, start=9, text="dddeee", question=(5, 6)):
    """Context tokens of three characters each."""
    tokens = [(100 + i, 3 * i, 3 * i + 3) for i in range(n)]
    return spark.createDataFrame([(1, list(question), tokens, start, text)], ENCODED)


def test_windows_and_labels(spark):
    rows = span_labels(context_windows(encoded(spark, 6), 9, stride=2)).orderBy("window").collect()
    assert [r.input_ids for r in rows] == [[2, 5, 6, 2, 100, 101, 102, 103, 2], [2, 5, 6, 2, 102, 103, 104, 105, 2]]
    assert [(r.start_position, r.end_position) for r in rows] == [(0, 0), (5, 6)]
    assert [o is None for o in rows[0].offsets] == [True] * 4 + [False] * 4 + [True]


@pytest.mark.parametrize("n", [1, 4, 5, 6, 7, 8, 9, 30])
def test_windows_cover_the_context(spark, n):
    rows = context_windows(encoded(spark, n), 9, stride=2).orderBy("window").collect()
    parts = [r.input_ids[4:-1] for r in rows]
    want, at = [], 0
    while True:
        want.append(list(range(100 + at, 100 + min(at + 4, n))))
        if at + 4 >= n:
            break
        at += 2
    assert parts == want


def test_whole_context(spark):
    row = span_labels(context_windows(encoded(spark, 30), None)).first()
    assert len(row.input_ids) == 35 and (row.start_position, row.end_position) == (7, 8)


def test_answer_edges_inside_tokens(spark):
    """An answer from the middle of one token to the middle of another takes both tokens; its own blanks do not count."""
    row = span_labels(context_windows(encoded(spark, 6, start=4, text="xxxx "), None)).first()
    assert (row.start_position, row.end_position) == (4 + 1, 4 + 2)


def test_question_without_room_is_an_error(spark):
    with pytest.raises(PySparkException):
        context_windows(encoded(spark, 6, question=(1, 2, 3, 4, 5)), 9, stride=2).collect()


def features(spark, starts, ends, offsets, window=0):
    return spark.createDataFrame(
        [(1, window, starts, ends, offsets)],
        "id bigint, window int, start_logits array<double>, end_logits array<double>, offsets array<struct<s:int,e:int>>",
    )


CONTEXT = "abcdefghi"


def contexts(spark):
    return spark.createDataFrame([(1, CONTEXT), (2, "zz")], "id bigint, context string")


def test_best_span_skips_reversed_pairs(spark):
    rows = features(spark, [0.1, 0.9, 0.2], [0.8, 0.3, 0.4], [(0, 3), (3, 6), (6, 9)])
    got = {r.id: r for r in best_spans(rows, contexts(spark)).collect()}
    assert got[1].prediction == "defghi" and abs(got[1].score - 1.3) < 1e-9
    assert got[2].prediction == "" and got[2].score is None


def test_best_span_needs_offsets_and_a_short_answer(spark):
    rows = features(spark, [9.0, 0.5, 0.2], [0.1, 0.3, 0.4], [None, (3, 6), (6, 9)])
    assert best_spans(rows, contexts(spark)).where("id = 1").first().prediction == "defghi"
    assert best_spans(rows, contexts(spark), max_answer=1).where("id = 1").first().prediction == "def"


def test_best_span_over_windows_by_brute_force(spark):
    rng = random.Random(5)
    offsets = [(i, i + 1) for i in range(9)]
    windows = [([rng.random() for _ in range(9)], [rng.random() for _ in range(9)]) for _ in range(4)]
    rows = None
    for w, (s, e) in enumerate(windows):
        one = features(spark, s, e, offsets, w)
        rows = one if rows is None else rows.unionByName(one)
    pairs = [
        (s[i] + e[j], CONTEXT[i : j + 1]) for s, e in windows
        for i in sorted(range(9), key=lambda i: -s[i])[:4] for j in sorted(range(9), key=lambda j: -e[j])[:4]
        if i <= j < i + 5
    ]
    got = best_spans(rows, contexts(spark), n_best=3, max_answer=5).where("id = 1").first()
    assert got.prediction == max(pairs)[1]


def test_top_positions_keep_one_more_than_n_best(spark):
    logits = F.array(*[F.lit(float(i % 7)) for i in range(40)])
    top = spark.range(1).select(top_positions(logits)).first()[0]
    assert len(top) == 21 and [t.at for t in top[:6]] == [6, 13, 20, 27, 34, 5]


def test_scores(spark):
    predictions = spark.createDataFrame(
        [(1, "the Cat sat."), (2, "a dog"), (3, ""), (4, "x x y")], "id bigint, prediction string"
    )
    references = spark.createDataFrame(
        [(1, ["cat sat down"]), (2, ["bird", "The dog!"]), (3, ["something"]), (4, ["x y y"])], "id bigint, answers array<string>"
    )
    got = {r.id: (r.exact_match, round(r.f1, 6)) for r in squad_scores(predictions, references).collect()}
    assert got == {1: (0.0, 80.0), 2: (100.0, 100.0), 3: (0.0, 0.0), 4: (0.0, 66.666667)}
    means = mean_scores(squad_scores(predictions, references)).first()
    assert means.exact_match == 25.0


def test_normalized_answer(spark):
    rows = spark.createDataFrame([("An  A-Team, the éa a the an!",)], "x string")
    assert rows.select(normalized_answer(F.col("x"))).first()[0] == "ateam éa"


def test_small_forms(spark):
    row = spark.range(1).select(
        span_mismatch(F.lit("abcdef"), F.lit(2), F.lit("cd")), span_mismatch(F.lit("abcdef"), F.lit(1), F.lit("cd")),
        rekeyed_answers(F.struct(F.array(F.lit("t")).alias("text")), F.lit(7)),
    ).first()
    assert row[0] is False and row[1] is True and row[2].id == "7" and row[2].answers.text == ["t"]
