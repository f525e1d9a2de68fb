"""Importance resampling towards a target collection, without replacement.

Every hash bucket of word runs has a gain, the logarithm of its share of the target over its share of the corpus; a text is
weighed by one lookup per run in the array of gains. Gumbel noise drawn from the id makes the highest scores a sample
drawn in proportion to the weights. The last score that is drawn lies in a bracket between two quantiles of a sketch;
exact counts of the scores outside tell whether it does, else a wider bracket is taken; only the bracket is sorted.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpusloom.llm.common import Memo, narrow, positions
from corpusloom.session import materialize

#: Hash buckets, longest run of words, seed of the noise, words a text needs to be drawn, percent that is drawn.
BUCKETS, LONGEST, SEED, LEAST_WORDS, PERCENT = 10_000, 1, 2024, 20, 10
#: Accuracy of the quantile sketch (its ranks are off by the table's rows over this) and half widths of the brackets.
ACCURACY, BRACKETS = 10_000, (0.0005, 0.002, 0.01, 0.05, 0.25)

_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))
_LAST = 2**63 - 1


def words_of(text: str | None) -> list[bytes]:
    """Runs of letters, digits and anything beyond ASCII, A-Z lower-cased."""
    return text.encode().translate(_BYTES).split() if text else []


@cache
def bucket_memo(buckets: int) -> Memo:
    """Buckets of features, remembered by each Python worker."""
    return Memo(lambda feature: zlib.crc32(feature) % buckets)


def features(words: list[bytes], longest: int, buckets: int) -> np.ndarray:
    """The bucket of every run of 1 to ``longest`` words."""
    memo, runs = bucket_memo(buckets), list(words)
    for k in range(2, longest + 1):
        runs += [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)]
    return np.fromiter(map(memo.__getitem__, runs), np.int64, len(runs))


def bucket_counts(texts: DataFrame, longest: int, buckets: int) -> np.ndarray:
    """How many features of all texts fall into each bucket; a row per bucket comes to the driver."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch["text"]:
                total += np.bincount(features(words_of(text), longest, buckets), minlength=buckets)
        used = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": used, "n": total[used]})

    out = np.zeros(buckets, object)
    for r in texts.mapInPandas(counted, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of each bucket's smoothed share of the target over that of the corpus."""
    buckets = len(corpus)
    all_corpus, all_target = int(corpus.sum()), int(target.sum())
    ratios = (
        float(t + 1) * float(all_corpus + buckets) / (float(s + 1) * float(all_target + buckets)) for s, t in zip(corpus, target)
    )
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], np.int64)


def noise(key: int | None, seed: int) -> int:
    """Gumbel noise in thousandths, drawn from the id; a null id counts as an empty one."""
    h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(rows: DataFrame, gain: np.ndarray, longest: int, seed: int) -> DataFrame:
    """doc_id, n_words, n_features, weight (floored mean gain) and score of every row."""
    buckets = len(gain)

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("doc_id")
            n_words, n_features, weights, scores = [], [], [], []
            for key, text in zip(keys.to_pylist(), batch.column("text").to_pylist()):
                words = words_of(text)
                found = features(words, longest, buckets)
                weight = int(gain[found].sum()) // len(found) if len(found) else 0
                n_words.append(len(words))
                n_features.append(len(found))
                weights.append(weight)
                scores.append(weight + noise(key, seed))
            columns = [pa.array(c, pa.int64()) for c in (n_words, n_features, weights, scores)]
            yield pa.RecordBatch.from_arrays([keys, *columns], ["doc_id", "n_words", "n_features", "weight", "score"])

    return rows.mapInArrow(weighed, "doc_id bigint, n_words bigint, n_features bigint, weight bigint, score bigint")


def bracket(rows: DataFrame, k: int, n: int) -> tuple[int | None, int | None, int]:
    """(lowest, highest, above): the k-th highest score lies between the two, and ``above`` scores lie over them.

    Nested brackets around the sketch's quantile are all checked by one pass of exact counts, and the narrowest that
    holds is taken; None stands for an open end.
    """
    middle = (n - k + 0.5) / n
    lows, highs = ([min(1.0, max(0.0, middle + side * width)) for width in BRACKETS] for side in (-1, 1))
    found = rows.agg(F.percentile_approx("score", [*lows, *highs], ACCURACY).alias("q")).first().q
    bounds = list(zip(found[: len(lows)], found[len(lows) :]))
    counts = []
    for i, (low, high) in enumerate(bounds):
        counts += [F.count_if(F.col("score") > high).alias(f"above{i}"), F.count_if(F.col("score") >= low).alias(f"from{i}")]
    exact = rows.agg(*counts).first()
    for i, (low, high) in enumerate(bounds):
        if exact[f"above{i}"] < k <= exact[f"from{i}"]:
            return low, high, exact[f"above{i}"]
    return None, None, 0


def drawn_rows(rows: DataFrame, k: int, n: int) -> DataFrame:
    """The k rows of ``rows`` (of n, written) with the highest scores; ties go to the smaller id, then to the earlier row."""
    if k <= 0:
        return rows.where("false")
    low, high, above = bracket(rows, k, n)
    inside = rows if low is None else rows.where(F.col("score").between(low, high))
    order = [F.desc("score"), F.asc("_key"), F.asc("_row")]
    last = positions(inside, order, "_at").where(F.col("_at") == k - above - 1).select("score", "_key", "_row").first()
    better = F.col("score") > last.score
    tied = (F.col("score") == last.score) & ((F.col("_key") < last._key) | ((F.col("_key") == last._key) & (F.col("_row") <= last._row)))
    return rows.where(better | tied)


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    buckets: int = BUCKETS,
    longest: int = LONGEST,
    seed: int = SEED,
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row; the rank, from 1, is null for rows that are not drawn.

    Of the N rows with ``least_words`` words or more, floor(percent N / 100) are drawn: the highest scores, ties to the smaller
    id. Null and empty texts have no features and weight 0; a null id counts as an empty one for the noise
    and comes last in ties; rows of one id are drawn one by one; other columns are ignored. Without a target all gains
    come from the corpus alone; an empty table gives no rows. A task holds the words of one text at a time.
    """
    rows = narrow(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    gain = gains(bucket_counts(rows.select("text"), longest, buckets), bucket_counts(narrow(target, text=target_text_col), longest, buckets))
    every = scored(rows, gain, longest, seed).withColumns(
        {"_key": F.coalesce("doc_id", F.lit(_LAST).cast("bigint")), "_row": F.monotonically_increasing_id()}
    )
    every = materialize(every, "resampling-scored")
    able = every.where(F.col("n_words") >= least_words)
    n = able.count()
    drawn = drawn_rows(able, percent * n // 100, n)
    ranked = positions(drawn, [F.desc("score"), F.asc("_key"), F.asc("_row")], "_at")
    ranks = ranked.select("_row", (F.col("_at") + 1).cast("bigint").alias("rank"))
    return every.join(ranks, "_row", "left").select("doc_id", "n_features", "weight", "score", "rank")
