"""Mixing sources to target weights by soft membership.

A labelled table teaches a naive Bayes classifier which words are telling for which domain; every
document gets posteriors over domains. Document rates are then fitted so that the expected tokens
per domain, ``sum(rate * tokens * posterior)``, meet the targets: nonnegative least squares by
projected gradient, distributed over documents. Only sums per domain ever leave the tasks; a
document's rate follows from its own posteriors and the history of multipliers. All of it is
DataFrame work; the driver solves systems as small as the number of domains.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexflume.llm.relations import columns_of
from lexflume.session import stored

# Labelled rows that the classifier is fitted on at most (lowest hashes of doc_id).
FIT_ROWS = 5_000
# Telling words per domain.
WORDS = 12
# A word must occur in this share of a domain's labelled rows to be considered.
LEAST_SHARE = 0.05
# Projected-gradient steps at most, and the relative residual that ends them.
STEPS = 30
CLOSE = 1e-6


@dataclass(frozen=True)
class Domains:
    """Bernoulli naive Bayes: log priors with all words absent, and what each present word adds."""

    names: list[str]
    words: list[str]
    absent: list[float]
    present: list[list[float]]  # by domain, by word


@dataclass(frozen=True)
class Rates:
    """Start rate and the multipliers that each step takes from it."""

    start: float
    history: list[list[float]]


def text_words(text: Column) -> Column:
    """White-space separated lower-case words; null and blank texts have none."""
    plain = F.translate(F.lower(F.coalesce(text, F.lit(""))), "\n\r\t", "   ")
    return F.array_remove(F.split(plain, " "), "")


def fit_domains(labelled: DataFrame, rows: int = FIT_ROWS, words: int = WORDS) -> Domains:
    """Classifier from (doc_id, text, domain); rows without a domain are left out."""
    sample = labelled.where("domain IS NOT NULL").orderBy(F.xxhash64("doc_id", "text"), "doc_id").limit(rows)
    sample = stored(sample.select("domain", F.array_distinct(text_words(F.col("text"))).alias("words")), "domain-sample")
    sizes = {r["domain"]: r["n"] for r in sample.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    names = sorted(sizes)
    if not names:
        return Domains([], [], [], [])
    total = float(sum(sizes.values()))
    counts = sample.select("domain", F.explode("words").alias("word")).groupBy("word")
    counts = counts.pivot("domain", names).agg(F.count(F.lit(1))).fillna(0)
    whole = reduce(lambda a, b: a + b, [F.col(f"`{n}`") for n in names])
    per_domain = []
    for n in names:
        inside, size = F.col(f"`{n}`"), float(sizes[n])
        rest = max(1.0, total - size)
        rate = whole / F.lit(total)
        z = (inside / F.lit(size) - (whole - inside) / F.lit(rest)) / F.sqrt(
            rate * (1 - rate) * F.lit(1 / size + 1 / rest) + F.lit(1e-12)
        )
        top = counts.where(inside >= F.lit(LEAST_SHARE * size)).orderBy(z.desc(), "word").limit(words)
        per_domain += top.collect()
    found = {r["word"]: r for r in per_domain}
    order = sorted(found)
    absent, present = [], []
    for n in names:
        p = np.array([(found[w][n] + 0.5) / (sizes[n] + 1.0) for w in order])
        absent.append(float(np.log(sizes[n] / total) + np.log1p(-p).sum()))
        present.append([float(x) for x in np.log(p) - np.log1p(-p)])
    return Domains(names, order, absent, present)


def memberships(docs: DataFrame, domains: Domains) -> DataFrame:
    """``docs`` with _tokens and _posteriors (array in the order of ``domains.names``); no shuffle."""
    given = docs.columns
    split = docs.withColumn("_words", text_words(F.col("text")))
    known = F.array(*[F.lit(w) for w in domains.words]) if domains.words else F.array().cast("array<string>")
    held = split.select(*given, F.size("_words").cast("bigint").alias("_tokens"), F.array_intersect("_words", known).alias("_held"))
    bits = F.array(*[F.array_contains("_held", w).cast("double") for w in domains.words]).cast("array<double>")

    def score(d: int) -> Column:
        weights = F.array(*[F.lit(x) for x in domains.present[d]]).cast("array<double>")
        products = F.zip_with(F.col("_bits"), weights, lambda bit, w: bit * w)
        return F.aggregate(products, F.lit(domains.absent[d]), lambda a, x: a + x)

    scored = held.withColumn("_bits", bits).select(
        *given, "_tokens", F.array(*[score(d) for d in range(len(domains.names))]).cast("array<double>").alias("_logs")
    )
    top = F.array_max("_logs")
    raised = scored.withColumn("_logs", F.transform("_logs", lambda x: F.exp(x - top)))
    total = F.aggregate("_logs", F.lit(0.0), lambda a, x: a + x)
    return raised.withColumn("_total", total).select(
        *given, "_tokens", F.transform("_logs", lambda x: x / F.col("_total")).alias("_posteriors")
    )


def rate(rates: Rates, size: int) -> Column:
    """A document's rate: the steps replayed on its posteriors, never below 0."""
    value = F.lit(rates.start)
    if not rates.history:
        return value
    history = F.array(*[F.array(*[F.lit(x) for x in step]) for step in rates.history])

    def stepped(r: Column, step: Column) -> Column:
        dot = reduce(lambda a, b: a + b, [F.get(F.col("_posteriors"), F.lit(d)) * F.get(step, F.lit(d)) for d in range(size)])
        return F.greatest(F.lit(0.0), r - dot)

    return F.aggregate(history, value, stepped)


def shares(targets: list[float | None], held: list[float]) -> np.ndarray:
    """Wanted shares of all tokens: domains without a target keep what they hold, the others divide the rest by weight."""
    named = sum(w for w in targets if w is not None)
    rest = 1.0 - sum(h for w, h in zip(targets, held, strict=True) if w is None)
    return np.array([h if w is None else w / named * rest for w, h in zip(targets, held, strict=True)])


def wanted_of(domains: Domains, weights: dict[str, float]) -> list[float | None]:
    """Weights in the order of the learned domains, None for those that have none."""
    return [None if n not in weights else float(weights[n]) for n in domains.names]


def fit_rates(members: DataFrame, targets: list[float | None], budget: float | None = None) -> Rates:
    """Rates whose expected domain totals come closest to ``targets`` (weights) times ``budget`` tokens.

    ``members``: stored (_tokens, _posteriors). The gradient step of a document is scaled by
    1/tokens and the residual by the inverse of ``sum(tokens * p p')``: a step of length one then
    never overshoots, and without clipping it lands on the targets. Without a budget the mix
    keeps the tokens there are. A target of None keeps the domain's share of the expected tokens; the
    others share what is left by their weights. Targets that no rates can meet are met in the
    least-squares sense, and what is left of them is told in a warning.
    """
    size = len(targets)
    p = [F.get("_posteriors", F.lit(d)) for d in range(size)]
    t = F.col("_tokens").cast("double")
    products = [F.sum(t * p[i] * p[j]) for i in range(size) for j in range(size)]
    moments = members.agg(F.sum(t), *[F.sum(t * x) for x in p], *products).first()
    total = moments[0] or 0.0
    if not total or not size:
        return Rates(1.0, [])
    budget = total if budget is None else budget
    wanted = shares(targets, [x / total for x in moments[1 : size + 1]]) * budget
    inverse = np.linalg.pinv(np.array(moments[size + 1 :], float).reshape(size, size))
    rates = Rates(budget / total, [])
    for _ in range(STEPS):
        sums = members.withColumn("_r", rate(rates, size)).agg(*[F.sum(t * F.col("_r") * x) for x in p]).first()
        residual = np.array(sums, float) - wanted
        if np.abs(residual).max() <= CLOSE * budget:
            break
        rates = Rates(rates.start, [*rates.history, [float(x) for x in inverse @ residual]])
    else:
        warnings.warn(f"after {STEPS} steps a domain misses its target by {np.abs(residual).max() / budget:.2%} of all tokens", stacklevel=2)
    return rates


def copies(doc_key: Column) -> Column:
    """Whole copies whose expectation is the rate: its floor, and one more with the chance of the rest.

    The chance is drawn from md5 of the key, the same on any partitioning and in any retry.
    """
    part = F.conv(F.substring(F.md5(doc_key), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    return (F.floor("_rate") + (part < F.col("_rate") - F.floor("_rate")).cast("int")).cast("int")


def mix(docs: DataFrame, domains: Domains, weights: dict[str, float], budget: float | None = None) -> DataFrame:
    """doc_id, n_tokens, domain (most likely), posteriors, rate, copies: a row per row of ``docs``.

    Defined cases: null and blank texts have no tokens, the posteriors of a text without telling
    words, and a rate like any other; a null doc_id draws its copies by its text alone; repeated rows
    get equal results; a domain without a weight keeps its share of the expected tokens; without labelled rows every rate
    is budget / tokens; an empty table gives an empty result; other columns are not read.
    """
    targets = wanted_of(domains, weights)
    key = _key(docs)
    members = memberships(docs.select("doc_id", key.alias("_key"), F.col("text")), domains).drop("text")
    members = stored(members, "members")
    rates = fit_rates(members, targets, budget) if any(targets) else Rates(1.0, [])
    rated = members.withColumn("_rate", rate(rates, len(targets)))
    names = F.array(*[F.lit(n) for n in domains.names]).cast("array<string>")
    likely = F.get(names, F.array_position("_posteriors", F.array_max("_posteriors")).cast("int") - 1)
    return rated.select(
        "doc_id",
        F.col("_tokens").alias("n_tokens"),
        likely.alias("domain"),
        F.col("_posteriors").alias("posteriors"),
        F.col("_rate").alias("rate"),
        copies(F.col("_key")).alias("copies"),
    )


def _key(docs: DataFrame) -> Column:
    return F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit(""))))


def mixed(docs: DataFrame, domains: Domains, weights: dict[str, float], budget: float | None = None) -> DataFrame:
    """``docs`` with every row as often as its ``copies`` say; all columns kept, no shuffle of rows.

    Cases are those of ``mix``; where no learned domain has a weight above 0 the rows stay as they are.
    """
    targets = wanted_of(domains, weights)
    if not any(targets):
        return docs
    rows = docs.select(F.struct(*columns_of(docs)).alias("_row"), _key(docs).alias("_key"), F.col("text"))
    members = memberships(rows, domains)
    rates = fit_rates(stored(members.select("_tokens", "_posteriors"), "members"), targets, budget)
    drawn = members.withColumn("_rate", rate(rates, len(targets))).select("_row", copies(F.col("_key")).alias("_copies"))
    # an outer explode: filters on its output cannot be pushed below it and repeat the classifier there
    times = F.when(F.col("_copies") > 0, F.sequence(F.lit(1), F.col("_copies")))
    return drawn.select("_row", F.explode_outer(times).alias("_nth")).where("_nth IS NOT NULL").select("_row.*")
