"""Mixing to target weights with soft membership, in column expressions only.

A labelled table trains a classifier of domains; it gives every document a posterior over domains. Nonnegative rates
(expected copies) are then fitted so that the expected tokens of every domain meet their targets, by projected
gradient steps of least squares: a step is one aggregation over the documents, and only a few numbers per domain
return. The steps add up before they are projected, so a rate depends on one number per domain, and no table of rates
is ever written.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.llm.common import BLANKS, narrow, table
from corpusloom.session import materialize

#: Hash buckets of words, evidence (as a likelihood ratio statistic) up to which a word counts as chance, labelled rows at
#: most per domain.
BUCKETS, CHANCE, MAX_LABELLED = 1 << 17, 9.0, 10_000

#: Share of the targets by which the sums may miss them; weight of the rates' distance from 1, and where targets are out
#: of reach the weights tried one after the other; shares of a step that are tried where the whole step is too long.
MET, RIDGE, RIDGES, SHORTER = 1e-6, 1e-9, (1e-1, 1e-2, 1e-3, 1e-4, 1e-5, 1e-6, 1e-7, 1e-8), 4.0 ** -np.arange(1, 7)

#: Domains of the labelled table and the shares of the tokens they are to have.
DOMAINS = ("good", "low", "toxic")
TARGETS: Mapping[str, float] = {"good": 0.96, "low": 0.03, "toxic": 0.01}


def domain_of(quality: Column, toxic: Column) -> Column:
    """toxic before low before good; null if there is no label."""
    return F.when(toxic == 1, "toxic").when(quality == 0, "low").when(quality == 1, "good")


def words_of(text: Column) -> Column:
    """Lower-cased words between ASCII blanks, without full stops and commas; an empty array for none."""
    bare = F.btrim(F.translate(F.lower(F.coalesce(text, F.lit(""))), ".,", ""), F.lit(BLANKS))
    return F.when(bare == "", F.expr("cast(array() as array<string>)")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))


def buckets_of(words: Column) -> Column:
    """The distinct hash buckets of the words."""
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w).bitwiseAND(F.lit(BUCKETS - 1)).cast("int")))


@dataclass(frozen=True)
class Classifier:
    """What each bucket says for each domain against the others, and how these sums make a posterior.

    ``table`` has a row per domain's sum, one for the text's length and one of constants, and a column per domain.
    """

    prior: np.ndarray
    weights: np.ndarray
    table: np.ndarray


def evidence(counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Log ratio of each bucket's share of a domain's documents to its share of the others', by domain and bucket.

    ``counts`` has documents by domain and bucket, ``sizes`` by domain. Shares are shrunk by half a document, and ratios
    by what chance explains of their likelihood ratio statistic: all of it up to CHANCE, little where it is far above.
    """
    out = np.zeros(counts.shape)
    a_all, n_all = counts.sum(axis=0), sizes.sum()
    for k, (a, n) in enumerate(zip(counts, sizes)):
        o, m = a_all - a, n_all - n
        if not n or not m:
            continue
        t = a_all / n_all

        def part(x: np.ndarray, expected: np.ndarray) -> np.ndarray:
            return x * np.log(np.where(x > 0, x, 1.0) / np.where(x > 0, expected, 1.0))

        statistic = 2 * (part(a, n * t) + part(o, m * t) + part(n - a, n * (1 - t)) + part(m - o, m * (1 - t)))
        told = statistic > CHANCE
        ratio = np.log(((a[told] + 0.5 * t[told]) / (n + 0.5)) / ((o[told] + 0.5 * t[told]) / (m + 0.5)))
        out[k, told] = (1 - CHANCE / statistic[told]) * ratio
    return out


def calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray, n: int, steps: int = 30) -> np.ndarray:
    """Coefficients of a multinomial regression of the domain on the features and a constant, by Newton's method."""
    width = x.shape[1]
    table, target = np.zeros((width, n)), np.eye(n)[y]
    ridge = np.full(width, 0.1)
    ridge[-1] = 1e-3

    def loss(b: np.ndarray) -> float:
        z = x @ b
        top = z.max(axis=1)
        chosen = (z * target).sum(axis=1)
        return float((weight * (top + np.log(np.exp(z - top[:, None]).sum(axis=1)) - chosen)).sum() + (ridge[:, None] * b * b).sum() / 2)

    now = loss(table)
    for _ in range(steps):
        z = x @ table
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        slope = x.T @ ((p - target) * weight[:, None]) + ridge[:, None] * table
        curve = np.diag(np.tile(ridge, n))
        for i in range(n):
            for j in range(n):
                curve[i * width : (i + 1) * width, j * width : (j + 1) * width] += (x * (weight * p[:, i] * ((i == j) - p[:, j]))[:, None]).T @ x
        step = np.linalg.solve(curve, slope.T.ravel()).reshape(n, width).T
        size = 1.0
        while (then := loss(table - size * step)) > now and size > 1e-4:
            size /= 2
        if then >= now:
            break
        table, now = table - size * step, then
    return table


def train(docs: DataFrame, labelled: DataFrame, domains: Sequence[str], id_col: str, text_col: str, max_labelled: int) -> Classifier | None:
    """Fit on labelled documents, at most about ``max_labelled`` of each domain, chosen by a hash of the id.

    That bound concerns this fit alone; priors are shares of all labelled documents. Every word counts, by its hash
    bucket. Sums of evidence are turned into posteriors by a regression on documents scored with the evidence of the
    other half, so that words which only occur together are not believed twice. None without labels.
    """
    known = labelled.where(F.col("domain").isin(list(domains)) & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.min("domain").alias("domain"))
    present = docs.select(F.col(f"`{id_col}`").alias("doc_id")).join(known, "doc_id")
    sizes = {r.domain: r.n for r in present.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    draw = F.pmod(F.xxhash64("doc_id", F.lit("mixing")), F.lit(1 << 30)) / float(1 << 30)
    share = F.lit(0.0)
    for name, n in sizes.items():
        share = F.when(F.col("domain") == name, min(1.0, max_labelled / n)).otherwise(share)
    # distinct ids, about max_labelled for each domain at most: that bound makes the broadcast safe
    drawn_ids = present.where(draw < share).distinct()
    texts = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    number = F.array_position(F.lit(list(domains)), F.col("domain")).cast("int") - 1
    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)).cast("int")
    chosen = texts.join(F.broadcast(drawn_ids), "doc_id").select((number * 2 + half).alias("part"), buckets_of(words_of(F.col("text"))).alias("_buckets"))
    chosen = materialize(chosen, "mixing-labelled")
    parts = 2 * len(domains)  # a domain's documents in two halves
    drawn, counts = np.zeros(parts), np.zeros((parts, BUCKETS))
    for r in chosen.groupBy("part").agg(F.count("*").alias("n")).collect():
        drawn[r.part] = r.n
    found = chosen.select("part", F.explode("_buckets").alias("bucket")).groupBy("bucket")
    found = found.agg(*[F.count_if(F.col("part") == i).cast("int").alias(f"c{i}") for i in range(parts)]).toArrow()  # a row per bucket at most
    for i in range(parts):
        counts[i, found["bucket"].to_numpy()] = found[f"c{i}"].to_numpy()
    first, second = evidence(counts[0::2], drawn[0::2]), evidence(counts[1::2], drawn[1::2])
    weights = evidence(counts[0::2] + counts[1::2], drawn[0::2] + drawn[1::2])
    is_first = F.col("part") % 2 == 0
    by_half = [F.when(is_first, b).otherwise(a) for a, b in zip(features(first), features(second))]
    scored = chosen.withColumn("_told", F.when(is_first, told_of(second)).otherwise(told_of(first)))
    scored = scored.select("part", *[c.alias(f"x{i}") for i, c in enumerate(by_half)]).toArrow()  # a row per drawn document
    x = np.column_stack([*[scored[f"x{i}"].to_numpy() for i in range(len(by_half))], np.ones(scored.num_rows)])
    y = scored["part"].to_numpy() // 2
    n = np.array([sizes.get(d, 0) for d in domains], float)
    weight = n[y] / np.maximum(np.bincount(y, minlength=len(domains)), 1)[y]
    # one document more of each domain, like the average, as in the prior
    middle = np.average(x, axis=0, weights=weight) if len(x) else np.append(np.zeros(len(by_half)), 1.0)
    x, y, weight = np.vstack([x, np.tile(middle, (len(domains), 1))]), np.append(y, np.arange(len(domains))), np.append(weight, np.ones(len(domains)))
    return Classifier((n + 1) / (n.sum() + len(domains)), weights, calibrate(x, y, weight, len(domains)))


def _constant(values: Sequence) -> Column:
    """An array of whole numbers as one literal."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<int>")


def telling(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The buckets that say anything, and their weights in hundredths."""
    hundredths = np.rint(weights * 100).astype(int)
    told = np.flatnonzero(hundredths.any(axis=0))
    return told, hundredths[:, told]


def told_of(weights: np.ndarray) -> Column:
    """Numbers, from 1, of the telling buckets among ``_buckets``."""
    told, _ = telling(weights)
    number = np.zeros(BUCKETS, int)
    number[told] = np.arange(1, len(told) + 1)
    constant = _constant(number)
    return F.filter(F.transform("_buckets", lambda b: F.get(constant, b)), lambda i: i > 0)


def features(weights: np.ndarray) -> list[Column]:
    """Sum of evidence for each domain over ``_told``, and the logarithm of the number of buckets; a tenth of each."""
    sums = []
    for row in telling(weights)[1]:
        constant = _constant([0, *row])
        total = F.aggregate("_told", F.lit(0), lambda a, i: a + F.get(constant, i))
        sums.append(F.least(F.greatest(total / 100.0, F.lit(-50.0)), F.lit(50.0)) / 10.0)
    return [*sums, F.log1p(F.size("_buckets").cast("double")) / 10.0]


def scores_of(model: Classifier) -> Column:
    """Array of the log scores of the domains, from the array ``_features``."""
    scores = []
    for column in model.table.T:
        score = F.lit(float(column[-1]))
        for i, v in enumerate(column[:-1]):
            score = score + F.get("_features", F.lit(i)) * F.lit(float(v))
        scores.append(score)
    return F.array(*scores)


def memberships(docs: DataFrame, model, domains: Sequence[str], id_col: str, text_col: str, keep_columns: bool = True) -> DataFrame:
    """``_row`` (all columns, or the id alone), ``_id``, ``_tokens`` (words) and ``_p`` (posterior by domain; uniform without a model)."""
    kept = docs.columns if keep_columns else [id_col]
    whole = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row")
    words = docs.select(whole, F.col(f"`{id_col}`").alias("_id"), words_of(F.col(f"`{text_col}`")).alias("_words"))
    counted = words.withColumn("_tokens", F.size("_words").cast("bigint"))
    if model is None:
        even = F.array(*[F.lit(1.0 / len(domains))] * len(domains))
        return counted.withColumn("_p", even).drop("_words")
    scored = counted.withColumn("_buckets", buckets_of(F.col("_words"))).drop("_words")
    scored = scored.withColumn("_told", told_of(model.weights))
    scored = scored.withColumn("_features", F.array(*features(model.weights))).drop("_buckets", "_told")
    scored = scored.withColumn("_scores", scores_of(model)).drop("_features")
    highest = F.array_max("_scores")
    scored = scored.withColumn("_scores", F.transform("_scores", lambda s: F.exp(s - highest)))
    total = F.aggregate("_scores", F.lit(0.0), lambda a, x: a + x)
    prior = F.array(*[F.lit(float(v)) for v in model.prior])
    return scored.withColumn("_p", F.when(F.col("_tokens") == 0, prior).otherwise(F.transform("_scores", lambda s: s / total))).drop("_scores")


def rate(p: Column, pull: np.ndarray) -> Column:
    """1 - p . pull, projected to zero or more."""
    out = F.lit(1.0)
    for k, v in enumerate(pull):
        out = out - F.get(p, F.lit(k)) * F.lit(float(v))
    return F.greatest(out, F.lit(0.0))


@dataclass(frozen=True)
class Fit:
    """One number per domain for ``rate``; the sums less the targets, as shares of all targets; steps taken."""

    pull: np.ndarray
    residual: np.ndarray
    steps: int


class _Sums:
    """Aggregates over the documents that the steps need, one pass each."""

    def __init__(self, members: DataFrame, targets: np.ndarray):
        self.members, self.targets, self.n = members, targets, len(targets)
        self.at = [F.get("_p", F.lit(k)) for k in range(self.n)]

    def at_pull(self, pull: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Sums of tokens by domain less the targets, overlap of the domains among rows with a rate, half the square of the rates."""
        r, t, n = rate(F.col("_p"), pull), F.col("_tokens"), self.n
        sums = [F.sum(t * self.at[k] * F.col("_r")) for k in range(n)]
        overlap = [F.sum(F.when(F.col("_r") > 0, t * self.at[i] * self.at[j])) for i in range(n) for j in range(n)]
        found = self.members.select("_p", "_tokens", r.alias("_r")).agg(*sums, *overlap, F.sum(t * F.col("_r") * F.col("_r")) / 2).first()
        v = np.array([float(x or 0.0) for x in found])
        return v[:n] - self.targets, v[n:-1].reshape(n, n), v[-1]

    def half_squares(self, pulls: Sequence[np.ndarray]) -> np.ndarray:
        """Half the square of the rates for each of a few pulls."""
        rates = self.members.select("_tokens", *[rate(F.col("_p"), x).alias(f"r{i}") for i, x in enumerate(pulls)])
        squares = [F.sum(F.col("_tokens") * F.col(f"r{i}") * F.col(f"r{i}")) / 2 for i in range(len(pulls))]
        return np.array([float(x or 0.0) for x in rates.agg(*squares).first()])


def _descend(sums: _Sums, ridge: np.ndarray, pull: np.ndarray) -> Fit:
    """Steps from ``pull`` until the ridged problem is solved as far as doubles can tell.

    The potential (half the squared rates, the targets' part and the ridge) is convex and its slope is the residual, so
    every step that lowers it nears the one optimum; a step too long is shortened.
    """
    total, steps, told = sums.targets.sum(), 0, 1e-12  # the sums of a pass differ by less than that share with their order

    def potential(x: np.ndarray, square: float) -> float:
        return square + float(x @ sums.targets + x @ ridge @ x / 2)

    miss, overlap, square = sums.at_pull(pull)
    while np.abs(slope := miss - ridge @ pull).sum() > MET / 10 * total:
        step = np.linalg.solve(overlap + ridge, slope)
        new, now = pull + step, potential(pull, square)
        then = sums.at_pull(new)
        least = now - told * abs(now)
        if potential(new, then[2]) >= least and np.abs(then[0] - ridge @ new).sum() > np.abs(slope).sum() / 2:
            shorter = [pull + share * step for share in SHORTER]
            lows = [potential(x, q) for x, q in zip(shorter, sums.half_squares(shorter))]
            if min(lows) >= least:
                break
            new = shorter[int(np.argmin(lows))]
            then = sums.at_pull(new)
        pull, (miss, overlap, square), steps = new, then, steps + 1
    return Fit(pull, miss / total, steps)


def fit(members: DataFrame, targets: np.ndarray) -> Fit:
    """Rates of projected gradient steps on |A r - T|^2 over nonnegative r: of all that meet the targets, those nearest to 1.

    A sums tokens by posterior. Steps are lazily projected (a row's rate is 1 less its share of all steps so far, or zero
    if that is negative) and measured by the overlap A P of the domains among the rows that have a rate, which makes
    them Newton steps once it is settled which rows have one. They end where the residual is within MET. Targets that
    no nonnegative rates meet give the least squares optimum, in the metric of the overlap of all rows: the weight of the
    rates' distance from 1 falls step by step until the residual falls no more. The residual is returned either way.
    """
    n = len(targets)
    sums = _Sums(members, targets)
    overlap = sums.at_pull(np.zeros(n))[1]  # at a rate of 1 every row counts
    if not overlap.any() or targets.sum() <= 0:
        return Fit(np.zeros(n), np.zeros(n), 0)
    whole = overlap + 1e-6 * np.trace(overlap) / n * np.eye(n)
    metric = np.linalg.pinv(overlap, rcond=1e-9)

    def distance(found: Fit) -> float:
        return float(found.residual @ metric @ found.residual)

    best = _descend(sums, RIDGE * whole, np.zeros(n))
    if np.abs(best.residual).sum() <= MET:
        return best
    best, steps = None, best.steps
    scale, pull = float(targets @ metric @ targets) / targets.sum() ** 2, np.zeros(n)
    for weight in RIDGES:
        found = _descend(sums, weight * whole, pull)
        steps += found.steps
        if best is not None and distance(found) >= distance(best) * (1 - 1e-4):
            break
        best, pull = Fit(found.pull, found.residual, steps), found.pull
        if distance(best) <= MET**2 * scale:
            break
    return best


def copies_of(rate_: Column, key: Column) -> Column:
    """The rate rounded to whole copies, up with the probability of its fraction, drawn from the key."""
    draw = F.pmod(F.xxhash64(key, F.lit("copies")), F.lit(1 << 30)) / float(1 << 30)
    return (F.floor(rate_) + F.when(draw < rate_ - F.floor(rate_), 1).otherwise(0)).cast("int")


def plan(
    docs: DataFrame,
    labelled: DataFrame,
    targets: Mapping[str, float] = TARGETS,
    budget: float | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_labelled: int = MAX_LABELLED,
    keep_columns: bool = True,
) -> tuple[DataFrame, Column, Column]:
    """Rows with their posteriors (written once, all columns kept), and the columns of rate and copies.

    ``labelled`` has doc_id and domain. ``budget`` is the number of expected tokens in all; by default the least for
    which a document of the first domain has a rate of 1 or more, so that none of those is given up.
    """
    domains = tuple(targets)
    model = train(docs, labelled, domains, id_col, text_col, max_labelled)
    members = materialize(memberships(docs, model, domains, id_col, text_col, keep_columns), "mixing-members")
    if model is None:
        return members, F.lit(1.0), F.lit(1)
    weights = np.array([targets[d] for d in domains], float)
    weights = weights / weights.sum()
    if budget is None:
        first = members.agg(F.sum(F.col("_tokens") * F.get("_p", F.lit(0)))).first()[0] or 0.0
        budget = first / weights[0]
    r = rate(F.col("_p"), fit(members, weights * budget).pull)
    return members, r, copies_of(r, F.coalesce("_id", F.lit(0)))


def mix_rates(docs: DataFrame, labelled: DataFrame, targets: Mapping[str, float] = TARGETS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, a probability per domain, rate and copies of every row.

    Null and empty texts have no tokens and the prior as posterior. Rows of equal id and text get equal rates; a label
    counts for all rows of its id, and of several labels of an id the first by name. Without any labelled row all
    rates are 1. Other columns are ignored; an empty table gives no rows.
    """
    rows = narrow(docs, doc_id=id_col, text=text_col)
    members, r, copies = plan(rows, labelled, targets, keep_columns=False)
    chances = [F.get("_p", F.lit(k)).alias(f"p_{d}") for k, d in enumerate(targets)]
    return members.select(F.col("_id").alias("doc_id"), F.col("_tokens").alias("n_tokens"), *chances, r.alias("rate"), copies.alias("copies"))


def mix(docs: DataFrame, labelled: DataFrame, targets: Mapping[str, float] = TARGETS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, as often as their copies say."""
    members, _, copies = plan(docs, labelled, targets, None, id_col, text_col)
    return members.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), copies))).select("_row.*")


def labelled_documents(spark, sf_dir: str) -> DataFrame:
    """doc_id and domain of the table of labels."""
    rows = table(spark, sf_dir, "labels")
    return rows.select("doc_id", domain_of(F.col("quality"), F.col("toxic")).alias("domain")).where("domain is not null")
