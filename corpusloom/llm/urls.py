"""URL filters: longest fitting rule first, else logistic regression on hashed character n-grams of host and path."""

from __future__ import annotations

import re
import zlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.llm.common import Memo, narrow

#: (verdict, host, path prefix)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

#: A small labelled URL table: 1 is unwanted. Invented hosts; the names say what they are.
UNWANTED = (
    "free-bets casino-win cheap-pills adult-x ads-track spam-farm best-casino-bonus online-poker-win buy-pills-now xxx-videos "
    "adult-dating click-ads ad-tracker track-pixel spam-links link-farm win-big-bets pills-pharmacy free-spins-slots payday-loans "
    "betting-tips porn-tube replica-watches seo-spam popup-ads lottery-winner cheap-viagra hot-adult-cams"
).split()
WANTED = (
    "city-library science-news daily-post open-data river-school weather museum theatre garden-club history world-atlas "
    "cooking-notes travel-diary math-forum nature-photos local-council hospital university research-lab music-archive "
    "thorin weston herald tionne otherin thenda reading-room standard northern teaching ringwood hearth"
).split()
PLACES = (("http://www.{}.example.com/en/{}.html", 1), ("https://blog.{}.example.org/de/{}", 2), ("https://{}.example.net/fr/{}/?page=2", 3), ("http://m.{}.example.com/es/{}#top", 4))

ORDERS, BUCKETS = (3, 4, 5), 1 << 14
_WORD = re.compile(r"[a-z]+|\d+")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty if there is none."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule for the host or a parent of it whose path the url's begins with; else null.

    Length counts host and path together; of equally long ones the earlier wins.
    """
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, of, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == of) | host.endswith(f".{of}")) & path.startswith(start)
        name, verdict = F.when(fits, of + start).otherwise(name), F.when(fits, said).otherwise(verdict)
    return name, verdict


def grams(host: str, path: str) -> np.ndarray:
    """Buckets of the character n-grams of every label of the host and every word of the path, digits as one sign."""
    out = set()
    for kind, part in (("h", host), ("p", path)):
        for piece in re.split(r"[./]", re.sub(r"\d+", "0", part.lower())):
            if not piece:
                continue
            marked = f"<{piece}>"
            out.update(
                zlib.crc32(f"{kind}{marked[i : i + n]}".encode()) % BUCKETS for n in ORDERS for i in range(len(marked) - n + 1)
            )
    return np.fromiter(sorted(out), np.int64, len(out))


def labelled_urls(spark) -> DataFrame:
    """The built-in labelled table: url, unwanted."""
    rows = [(at.format(h, 17 * n + k), y) for y, hosts in ((1, UNWANTED), (0, WANTED)) for k, h in enumerate(hosts) for at, n in PLACES]
    return spark.createDataFrame(rows, "url string, unwanted int")


def train(labelled: DataFrame, max_rows: int = 100_000, epochs: int = 200, rate: float = 1.0, l2: float = 1e-3) -> np.ndarray:
    """Weights per bucket and, last, the intercept.

    The table is small by contract: more than ``max_rows`` rows are an error, not a sample. Rows with a null are left
    out. Full-batch gradient steps on the mean loss, so row order does not matter.
    """
    parts = labelled.where("url is not null and unwanted is not null").select(
        host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "unwanted"
    )
    rows = parts.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"more than {max_rows} labelled urls")
    weights = np.zeros(BUCKETS + 1)
    if not rows:
        return weights
    feats = [grams(r.host, r.path) for r in rows]
    y = np.array([float(r.unwanted) for r in rows])
    row_of, col_of = np.repeat(np.arange(len(feats)), [len(f) for f in feats]), np.concatenate(feats)
    scale = np.array([1 / max(1, len(f)) ** 0.5 for f in feats])
    for _ in range(epochs):
        z = scale * np.bincount(row_of, weights[col_of], len(feats)) + weights[-1]
        error = (1 / (1 + np.exp(-z)) - y) / len(y)
        weights[:-1] -= rate * (np.bincount(col_of, (scale * error)[row_of], BUCKETS) * len(y) ** 0.5 + l2 * weights[:-1])
        weights[-1] -= rate * error.sum()
    return weights


def probability(weights: np.ndarray):
    """A column function of host and path: how likely the url is unwanted."""
    kept = weights.astype(np.float32)

    @F.pandas_udf("double")
    def score(hosts: pd.Series, paths: pd.Series) -> pd.Series:
        def one(key: tuple[str, str]) -> float:
            f = grams(*key)
            z = kept[f].sum() / max(1, len(f)) ** 0.5 + kept[-1]
            return float(1 / (1 + np.exp(-z)))

        memo = Memo(one, 50_000)
        return pd.Series([memo[k] for k in zip(hosts, paths)], dtype="float64")

    return score


def judge_urls(
    pages: DataFrame,
    labelled: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: Sequence[tuple[str, str, str]] = RULES,
    threshold: float = 0.5,
) -> DataFrame:
    """page_id, host, path, rule, verdict and the model's probability of every row.

    The longest fitting rule decides, else the model: block from ``threshold`` on. Null urls and urls without ``://``
    have an empty host and path, fit no rule and are allowed. Repeated rows are judged each on its own, other columns are
    ignored, an empty table gives no rows. With no labelled urls the model allows everything.
    """
    weights = train(labelled)
    rows = narrow(pages, page_id=id_col, url=url_col).select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    name, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    p = F.when(F.col("host") == "", 0.0).otherwise(probability(weights)("host", "path")) if weights.any() else F.lit(0.0)
    return (
        rows.withColumn("unwanted", p)
        .select("page_id", "host", "path", name.alias("rule"), verdict.alias("_said"), "unwanted")
        .select(
            "page_id", "host", "path", "rule",
            F.coalesce("_said", F.when(F.col("unwanted") >= threshold, "block").otherwise("allow")).alias("verdict"),
            "unwanted",
        )
    )
