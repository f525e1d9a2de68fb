"""Extractive question answering: windows, span labels, span extraction and scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.functions.arrays import let
from corpusloom.functions.text import strip
from corpusloom.operators.tokenizer import WordPiece

# Window overlap, candidates per side, longest answer in tokens.
STRIDE = 50
N_BEST = 20
MAX_ANSWER = 100


def encode_examples(examples: DataFrame, tokenizer: WordPiece) -> DataFrame:
    """Add ``question_ids`` of the stripped question and ``tokens`` (ids with offsets) of the context."""
    return examples.withColumns(
        {
            "question_ids": tokenizer.token_ids(strip(F.col("question"))),
            "tokens": tokenizer.token_spans(F.col("context")),
        }
    )


def context_windows(encoded: DataFrame, max_length: int | None, stride: int = STRIDE, sep: int = 2) -> DataFrame:
    """One feature row per window: ``id, window, input_ids, offsets, context_begin`` and the example's answer.

    The whole question is kept; the context is cut into windows of the remaining capacity that overlap by ``stride``
    tokens. ``max_length=None`` keeps the context whole. Offsets are null outside the context. The text itself is
    not copied into the windows; join on ``id`` where it is needed.
    """
    n = F.size("tokens")
    if max_length is None:
        capacity, step = F.greatest(n, F.lit(1)), F.greatest(n, F.lit(1))
        last = F.lit(0)
    else:
        room = max_length - F.size("question_ids") - 3
        fits = F.lit(f"the question leaves no room beyond the overlap of {stride} tokens")
        capacity = F.when(room > stride, room).otherwise(F.raise_error(fits).cast("int"))
        step = capacity - stride
        last = F.when(n <= capacity, 0).otherwise(F.greatest(n - stride - 1, F.lit(0)))
    begins = F.sequence(F.lit(0), last, step)
    windows = F.transform(begins, lambda b, i: F.struct(i.alias("window"), F.slice("tokens", b + 1, capacity).alias("part")))
    answer = [c for c in ("answer_start", "answer_text") if c in encoded.columns]
    cut = encoded.select("id", "question_ids", *answer, F.inline(windows))
    one = F.array(F.lit(sep))
    nothing = F.expr("cast(null as struct<s:int,e:int>)")
    return cut.select(
        "id",
        "window",
        F.concat(one, "question_ids", one, F.transform("part", lambda t: t["id"]), one).alias("input_ids"),
        F.concat(
            F.array_repeat(nothing, F.size("question_ids") + 2),
            F.transform("part", lambda t: F.struct(t["s"].alias("s"), t["e"].alias("e"))),
            F.array(nothing),
        ).alias("offsets"),
        (F.size("question_ids") + 2).alias("context_begin"),
        *answer,
    )


def span_labels(windows: DataFrame) -> DataFrame:
    """Add ``start_position`` and ``end_position`` of the first answer, (0, 0) where the window does not hold it all."""
    first = F.col("answer_start")
    after = first + F.length(strip(F.col("answer_text")))
    spans = F.filter("offsets", lambda o: o.isNotNull())
    inside = (F.size(spans) > 0) & (F.get(spans, F.lit(0))["s"] <= first) & (F.element_at(spans, -1)["e"] >= after)
    start = F.col("context_begin") + F.size(F.filter(spans, lambda o: o["s"] <= first)) - 1
    end = F.col("context_begin") + F.size(F.filter(spans, lambda o: o["e"] < after))
    return windows.withColumns(
        {
            "start_position": F.when(inside, start).otherwise(0),
            "end_position": F.when(inside, end).otherwise(0),
        }
    )


def rekeyed_answers(answers: Column, example_id: Column) -> Column:
    """``struct<answers, id:string>``, the form in which references are scored."""
    return F.struct(answers.alias("answers"), example_id.cast("string").alias("id"))


def span_mismatch(context: Column, start: Column, answer: Column) -> Column:
    """True where the context at ``start`` does not read as the answer."""
    return F.substring(context, start + 1, F.length(answer)) != answer


def top_positions(logits: Column, k: int = N_BEST + 1) -> Column:
    """``array<struct<score, at>>``: the k highest logits, ties to the earlier position."""
    keyed = F.transform(logits, lambda x, i: F.struct((-x).alias("neg"), i.alias("at")))
    return F.transform(
        F.slice(F.array_sort(keyed), 1, k), lambda s: F.struct((-s["neg"]).alias("score"), s["at"].alias("at"))
    )


def best_spans(
    features: DataFrame, contexts: DataFrame, n_best: int = N_BEST, max_answer: int = MAX_ANSWER
) -> DataFrame:
    """``id, score, prediction``: the best answer span over all windows of each example.

    ``features`` has ``id, window, start_logits, end_logits, offsets``. At most (n_best+1)^2 pairs are tried, inside the
    row; one candidate per window leaves it and the maximum per example is combined before the shuffle. Examples without a
    valid span predict the empty text.
    """
    starts, ends = top_positions(F.col("start_logits"), n_best + 1), top_positions(F.col("end_logits"), n_best + 1)

    def usable(points: Column) -> Column:
        return F.filter(points, lambda p: F.get("offsets", p["at"]).isNotNull())

    def pairs(tops: Column) -> Column:
        return F.flatten(
            F.transform(
                tops["starts"],
                lambda s: F.transform(
                    F.filter(
                        tops["ends"], lambda e: (e["at"] >= s["at"]) & (e["at"] - s["at"] + 1 <= max_answer)
                    ),
                    lambda e: F.struct(
                        (s["score"] + e["score"]).alias("score"), (-s["at"]).alias("ns"), (-e["at"]).alias("ne")
                    ),
                ),
            )
        )

    best = let(F.struct(usable(starts).alias("starts"), usable(ends).alias("ends")), lambda t: F.array_max(pairs(t)))
    span = F.struct(
        F.col("_best.score").alias("score"),
        (-F.col("window")).alias("nw"),
        F.get("offsets", -F.col("_best.ns"))["s"].alias("s"),
        F.get("offsets", -F.col("_best.ne"))["e"].alias("e"),
    )
    # windows without a span stay as nulls: a filter would score them a second time
    chosen = (
        features.withColumn("_best", best)
        .select("id", F.when(F.col("_best").isNotNull(), span).alias("_span"))
        .groupBy("id")
        .agg(F.max("_span").alias("_span"))
    )
    text = F.substring(F.col("context"), F.col("_span.s") + 1, F.col("_span.e") - F.col("_span.s"))
    return contexts.join(chosen, "id", "left").select(
        "id", F.col("_span.score").alias("score"), F.coalesce(text, F.lit("")).alias("prediction")
    )


def normalized_answer(text: Column) -> Column:
    """Lower-case, no ASCII punctuation, no articles, single spaces."""
    # The punctuation and articles of the standard scoring script.
    plain = F.regexp_replace(F.lower(text), r"[!-/:-@\[-`{-~]", "")
    plain = F.regexp_replace(plain, r"(?<![\p{L}\p{N}_])(?:a|an|the)(?![\p{L}\p{N}_])", " ")
    return strip(F.regexp_replace(plain, r"[\s\p{Z}]+", " "))


def squad_scores(predictions: DataFrame, references: DataFrame) -> DataFrame:
    """``id, exact_match, f1`` per example, each the best over its gold answers, in percent.

    ``predictions``: ``id, prediction``; ``references``: ``id, answers array<string>``. Token overlap is counted by grouping
    tokens of both sides together, so the cost is linear in the text.
    """
    pairs = (
        predictions.join(references, "id")
        .select("id", F.posexplode("answers").alias("gold_no", "gold"), "prediction")
        .select(
            "id", "gold_no", normalized_answer(F.col("gold")).alias("g"), normalized_answer(F.col("prediction")).alias("p")
        )
    )
    split = lambda c: F.filter(F.split(c, " "), lambda t: t != "")
    sides = F.array(
        F.struct(split("p").alias("tokens"), F.lit(1).alias("np"), F.lit(0).alias("ng")),
        F.struct(split("g").alias("tokens"), F.lit(0).alias("np"), F.lit(1).alias("ng")),
    )
    overlap = (
        pairs.select("id", "gold_no", F.inline(sides))
        .select("id", "gold_no", F.explode("tokens").alias("token"), "np", "ng")
        .groupBy("id", "gold_no", "token")
        .agg(F.sum("np").alias("np"), F.sum("ng").alias("ng"))
        .groupBy("id", "gold_no")
        .agg(F.sum(F.least("np", "ng")).alias("same"), F.sum("np").alias("n_p"), F.sum("ng").alias("n_g"))
    )
    f1 = F.when(F.coalesce("same", F.lit(0)) > 0, 200.0 * F.col("same") / (F.col("n_p") + F.col("n_g"))).otherwise(0.0)
    exact = F.when(F.col("p") == F.col("g"), 100.0).otherwise(0.0)
    return (
        pairs.join(overlap, ["id", "gold_no"], "left")
        .select("id", exact.alias("exact_match"), f1.alias("f1"))
        .groupBy("id")
        .agg(F.max("exact_match").alias("exact_match"), F.max("f1").alias("f1"))
    )


def mean_scores(scores: DataFrame) -> DataFrame:
    return scores.agg(F.avg("exact_match").alias("exact_match"), F.avg("f1").alias("f1"))
