"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Trained per coordinate with follow-the-regularised-leader and elastic-net penalties, then calibrated by a temperature.
Document frequencies cover all texts of the rows to learn from; only the fit itself uses a bounded sample of labelled rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.llm.common import narrow

ORDERS, BUCKETS = (1, 2, 3), 1 << 15
UNKNOWN = "und"


def counts(text: str) -> np.ndarray:
    """How often each bucket of character n-grams occurs; case is folded, other than letters is one blank."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    ascii_other = (points < 97) | ((points > 122) & (points < 192))
    points = np.where(ascii_other, np.uint32(32), points)
    keep = np.ones(len(points), bool)
    keep[1:] = ~(ascii_other[1:] & ascii_other[:-1])
    points = points[keep]
    total = np.zeros(BUCKETS, np.int64)
    code = np.zeros(len(points), np.uint32)
    for n in range(1, max(ORDERS) + 1):
        if len(points) < n:
            break
        code = code[: len(points) - n + 1] * np.uint32(0x9E3779B1) + points[n - 1 :] + np.uint32(n)
        if n in ORDERS:
            spread = code * np.uint32(0x85EBCA6B)
            total += np.bincount(spread >> np.uint32(17), minlength=BUCKETS)
    return total


def vector(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and weights of a text: dampened counts times idf, of length 1."""
    c = counts(text)
    at = np.flatnonzero(c)
    v = (1.0 + np.log(c[at])) * idf[at]
    return at, v / max(float(np.sqrt((v * v).sum())), 1e-12)


def has_letter(text: str | None) -> bool:
    """Whether any character is a letter; digits in other scripts, fractions and numerals are none."""
    return bool(text) and any(map(str.isalpha, text))


def document_frequencies(docs: DataFrame, text_col: str) -> tuple[np.ndarray, int]:
    """In how many texts each bucket occurs, and the number of texts.

    Every task adds up its own rows; the sums are a table of one row per bucket.
    """

    def added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for text in batch["text"]:
                if text:
                    total += counts(text) > 0
                    n += 1
        at = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": np.append(at, BUCKETS), "n": np.append(total[at], n)})

    rows = narrow(docs, text=text_col).mapInPandas(added, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    df, n = np.zeros(BUCKETS, np.int64), 0
    for r in rows.collect():  # a row per bucket at most
        if r.bucket == BUCKETS:
            n = r.n
        else:
            df[r.bucket] = r.n
    return df, n


@dataclass(frozen=True)
class Model:
    """A weight per bucket (last row: intercept) and language; scores are divided by the temperature."""

    languages: tuple[str, ...]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def logits(self, text: str) -> np.ndarray:
        at, v = vector(text, self.idf)
        return v @ self.weights[at] + self.weights[-1]

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        z = self.logits(text) / self.temperature
        p = np.exp(z - z.max())
        best = int(p.argmax())
        return self.languages[best], float(p[best] / p.sum())


def ftrl(
    rows: list[tuple[np.ndarray, np.ndarray, int]],
    classes: int,
    epochs: int = 5,
    alpha: float = 0.5,
    beta: float = 1.0,
    l1: float = 0.02,
    l2: float = 0.02,
) -> np.ndarray:
    """FTRL-proximal on the multinomial log loss; the l1 part of the penalty leaves most weights at exactly zero."""
    z, n = np.zeros((BUCKETS + 1, classes)), np.zeros((BUCKETS + 1, classes))

    def weights(zs: np.ndarray, ns: np.ndarray) -> np.ndarray:
        shrunk = np.sign(zs) * l1 - zs
        return np.where(np.abs(zs) <= l1, 0.0, shrunk / ((beta + np.sqrt(ns)) / alpha + l2))

    for _ in range(epochs):
        for at, v, label in rows:
            i, x = np.append(at, BUCKETS), np.append(v, 1.0)
            w = weights(z[i], n[i])
            s = x @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[label] -= 1.0
            g = x[:, None] * p[None, :]
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
            z[i] += g - sigma * w
            n[i] += g * g
    return weights(z, n)


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the scores with the least log loss, by golden-section search over its logarithm."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        z = logits / np.exp(log_t)
        z = z - z.max(axis=1, keepdims=True)
        return float((np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(labels)), labels]).mean())

    a, b, ratio = np.log(0.02), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(60):
        c, d = b - ratio * (b - a), a + ratio * (b - a)
        a, b = (a, d) if loss(c) <= loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def train(docs: DataFrame, learn: Column, text_col: str, label_col: str, key: Column, max_rows: int = 2_000) -> Model:
    """Fit on about ``max_rows`` whole texts of the rows where ``learn`` holds, chosen by a hash of ``key``.

    The bound concerns the fit alone; document frequencies cover every row to learn from, and no held-out text. Languages are all label values among the rows to learn from; a language with few
    rows keeps them all, as the share drawn is set per language. A fifth of the sample is set aside for the temperature.
    """
    chosen = docs.where(learn & F.col(f"`{label_col}`").isNotNull() & F.col(f"`{text_col}`").isNotNull())
    chosen = chosen.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{label_col}`").alias("label"), key.alias("key"))
    per_label = {r.label: r.n for r in chosen.groupBy("label").agg(F.count("*").alias("n")).collect()}  # a row per language
    idf_counts, total = document_frequencies(docs.where(learn), text_col)
    idf = np.log((1.0 + total) / (1.0 + idf_counts)) + 1.0
    languages = tuple(sorted(per_label))
    if not languages:
        return Model((), idf, np.zeros((BUCKETS + 1, 0)), 1.0)
    draw = F.pmod(F.xxhash64("key", F.lit("language")), F.lit(1 << 30)) / float(1 << 30)
    share = F.lit(0.0)
    for label, n in per_label.items():
        share = F.when(F.col("label") == label, min(1.0, max_rows / len(languages) / n)).otherwise(share)

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [vector(t, idf) for t in batch["text"]]
            yield pd.DataFrame(
                {
                    "draw": batch["draw"],
                    "label": batch["label"],
                    "at": [a.astype("<i4").tobytes() for a, _ in found],
                    "v": [v.astype("<f4").tobytes() for _, v in found],
                }
            )

    sample = chosen.withColumn("draw", draw).where(F.col("draw") < share).select("text", "label", (F.col("draw") / share).alias("draw"))
    kinds = "draw double, label string, at binary, v binary"
    got = sorted(sample.mapInPandas(vectors, kinds).collect(), key=lambda r: (r.draw, r.label, r["at"]))
    rows = [(np.frombuffer(r["at"], "<i4"), np.frombuffer(r.v, "<f4").astype(float), languages.index(r.label)) for r in got]
    held = rows[::5] if len(rows) >= 50 else []
    fit = [r for k, r in enumerate(rows) if k % 5] if held else rows
    weights = ftrl(fit, len(languages))
    scores = np.array([v @ weights[at] + weights[-1] for at, v, _ in held]).reshape(len(held), len(languages))
    return Model(languages, idf, weights, temperature(scores, np.array([y for *_, y in held], dtype=int)))


def prediction(model: Model):
    """A column function of the text: struct of lang_pred and score."""

    @F.pandas_udf("lang_pred string, score double")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.predict(t) for t in texts], columns=["lang_pred", "score"])

    return predicted


def held_out(id_column: Column) -> Column:
    """The rows kept for measuring: remainder 2 of the id's crc32 by 4. A null id is not among them."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", max_rows: int = 2_000
) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row; the text alone decides.

    Texts that are null or have no letter get ``und`` and score 0, as does everything if there is nothing to learn
    from. Rows with a null id or label are predicted but not learned from; repeated rows are treated alike; other
    columns are ignored; an empty table gives no rows.
    """
    rows = narrow(docs, doc_id=id_col, text=text_col, label=label_col)
    model = train(rows, ~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull(), "text", "label", F.col("doc_id"), max_rows)
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), prediction(model)("text").alias("_p")).select(
        "doc_id", "held_out", "_p.*"
    )


def keep_identified(
    docs: DataFrame, least_score: float = 0.3, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang"
) -> DataFrame:
    """The rows whose language is known with at least ``least_score``, with all their columns.

    Rejected are texts without a letter (null and empty ones too) and those the calibrated model is unsure of.
    """
    learn = ~held_out(F.col(f"`{id_col}`")) & F.col(f"`{id_col}`").isNotNull()
    model = train(docs, learn, text_col, label_col, F.col(f"`{id_col}`"))
    if not model.languages:
        letters = F.pandas_udf(lambda texts: texts.map(has_letter, na_action=None).astype(bool), "boolean")
        return docs.where(letters(F.col(f"`{text_col}`")))
    found = prediction(model)(F.col(f"`{text_col}`"))
    return docs.where((found["lang_pred"] != UNKNOWN) & (found["score"] >= least_score))
