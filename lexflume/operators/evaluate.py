"""Evaluation: classification metrics, latency, ROUGE.

Every function takes ``by`` (run, model, split, ...) so that many runs are
assessed in one job. Classification metrics come from the confusion counts
(at most classes x classes rows per run), never from the rows again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexflume.constants import CLASS_IDS, CLASS_NAMES
from lexflume.functions.language import lcs, shared_grams, stem_tokens, stem_word
from lexflume.functions.scores import class_name
from lexflume.functions.text import strip, tokens
from lexflume.operators.distributed import exact_quantiles, exploded, merge_rows, value_counts
from lexflume.operators.scoring import class_grid

By = Sequence[str]


def confusion(df: DataFrame, by: By = ()) -> DataFrame:
    """Rows per (label, pred), the full class grid with zeros."""
    if by:
        counts = df.groupBy(*by, "label", "pred").agg(F.count(F.lit(1)).alias("n"))
        groups = counts.select(*by).distinct()
    else:
        counts = df.select("label", "pred", F.lit(1).cast("bigint").alias("n"))
        groups = df.sparkSession.range(1)
    grid = groups.select(*by, F.inline(class_grid())).withColumn("n", F.lit(0).cast("bigint"))
    return counts.unionByName(grid).groupBy(*by, "label", "pred").agg(F.sum("n").alias("n"))


def confusion_matrix(df: DataFrame, by: By = ()) -> DataFrame:
    """Rows are true classes, columns predicted ones, by name; ``pred_other`` counts null and unknown predictions.

    Rows of null or unknown true classes are one row with a null name.
    """
    cells = [
        F.sum(F.when(F.col("pred") == c, F.col("n")).otherwise(0)).alias(f"pred_{CLASS_NAMES[c]}") for c in CLASS_IDS
    ]
    known = F.coalesce(F.col("pred").isin(*CLASS_IDS), F.lit(False))
    other = F.sum(F.when(known, 0).otherwise(F.col("n"))).alias("pred_other")
    return confusion(df, by).groupBy(*by, class_name(F.col("label")).alias("true_label")).agg(*cells, other)


def accuracy(conf: DataFrame, by: By = ()) -> DataFrame:
    """Share of rows whose prediction is right."""
    right = F.sum(F.when(F.col("label") == F.col("pred"), F.col("n")).otherwise(0))
    return conf.groupBy(*by).agg(_ratio(right, F.sum("n")).alias("accuracy"))


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def per_class(conf: DataFrame, by: By = ()) -> DataFrame:
    """Precision, recall, F1, support and predicted rows per class; undefined is 0."""
    hit = F.when(F.col("label") == F.col("pred"), F.col("n")).otherwise(0)
    zero = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(F.col("label").alias("class_id"), hit.alias("hits"), F.col("n").alias("truth"), zero.alias("guessed")),
        F.struct(F.col("pred").alias("class_id"), zero.alias("hits"), zero.alias("truth"), F.col("n").alias("guessed")),
    )
    sums = (
        conf.select(*by, F.inline(sides))
        .groupBy(*by, "class_id")
        .agg(F.sum("hits").alias("hits"), F.sum("truth").alias("support"), F.sum("guessed").alias("predicted"))
    )
    return sums.select(
        *by,
        "class_id",
        class_name(F.col("class_id")).alias("class_name"),
        _ratio(F.col("hits"), F.col("predicted")).alias("precision"),
        _ratio(F.col("hits"), F.col("support")).alias("recall"),
        _ratio(2 * F.col("hits"), F.col("support") + F.col("predicted")).alias("f1"),
        "support",
        "predicted",
        "hits",
    )


def _macro_columns() -> list[Column]:
    seen = (F.col("support") > 0) | (F.col("predicted") > 0)
    named = {"f1": "f1_macro", "precision": "precision", "recall": "recall"}
    return [F.avg(F.when(seen, F.col(metric))).alias(name) for metric, name in named.items()]


def macro(conf: DataFrame, by: By = ()) -> DataFrame:
    """Unweighted means over the classes seen in truth or prediction."""
    return per_class(conf, by).groupBy(*by).agg(*_macro_columns())


def _weighted_f1() -> Column:
    return _ratio(F.sum(F.col("f1") * F.col("support")), F.sum("support"))


def weighted_f1(conf: DataFrame, by: By = ()) -> DataFrame:
    """F1 weighted by the rows of each class."""
    return per_class(conf, by).groupBy(*by).agg(_weighted_f1().alias("f1_weighted"))


def classification_metrics(conf: DataFrame, by: By = ()) -> DataFrame:
    """All classification metrics of a run as one row."""
    of_class = [
        F.coalesce(F.max(F.when(F.col("class_id") == c, F.col("f1"))), F.lit(0.0)).alias(f"f1_{CLASS_NAMES[c]}")
        for c in reversed(CLASS_IDS)
    ]
    return (
        per_class(conf, by)
        .groupBy(*by)
        .agg(
            _ratio(F.sum("hits"), F.sum("support")).alias("accuracy"),
            *_macro_columns(),
            _weighted_f1().alias("f1_weighted"),
            *of_class,
        )
    )


def latency(df: DataFrame, by: By = (), seconds: str = "batch_seconds", rows: str = "batch_n") -> DataFrame:
    """Mean and P95 of seconds per row *over batches*, in milliseconds.

    Every batch weighs the same, also a short last one; P95 interpolates. Batches
    without rows and null or NaN times are left out of both.
    """
    timed = F.try_divide(F.col(seconds).cast("double"), F.col(rows))
    per_row = df.select(*by, F.when(~F.isnan(timed), timed).alias("s"))
    mean = per_row.groupBy(*by).agg((F.avg("s") * 1000).alias("mean_latency_ms"))
    high = exact_quantiles(value_counts(per_row, "s", by), "s", {"p95": 0.95}, by)
    return merge_rows([mean, high.select(*by, (F.col("p95") * 1000).alias("p95_latency_ms"))], by)


def clean_references(df: DataFrame, reference: str = "reference") -> DataFrame:
    """Delete ``-100`` from references, strip them, leave out the empty ones."""
    cleaned = strip(F.replace(F.col(reference), F.lit("-100"), F.lit("")))
    return df.withColumn(reference, cleaned).where(F.col(reference) != "")


def first_n(df: DataFrame, n: int, *order: str, reference: str = "reference") -> DataFrame:
    """The first ``n`` pairs that have a reference."""
    return clean_references(df, reference).orderBy(*order).limit(n)


def align(pred: DataFrame, truth: DataFrame, *key: str) -> DataFrame:
    """Predictions beside their references and inputs, by key and not by position."""
    return pred.join(truth, list(key))


def _with_tokens(df: DataFrame, stem: bool) -> DataFrame:
    ref, pred = tokens(F.col("reference")), tokens(F.col("prediction"))
    if stem:
        ref, pred = stem_tokens(ref), stem_tokens(pred)
    empty = F.array().cast("array<string>")
    return df.withColumns({"_r": F.coalesce(ref, empty), "_p": F.coalesce(pred, empty)})


def _f_score(hits: Column, a: Column, b: Column) -> Column:
    """2PR / (P + R) for P = hits / b and R = hits / a; 0 when nothing is shared."""
    return _ratio(2 * hits, a + b)


def _rouge_n(n: int) -> Column:
    grams = lambda col: F.greatest(F.size(col) - (n - 1), F.lit(0))
    return _f_score(shared_grams(n)("_r", "_p"), grams("_r"), grams("_p")).alias(f"rouge{n}")


def _rouge_l() -> Column:
    return _f_score(lcs(F.col("_r"), F.col("_p")), F.size("_r"), F.size("_p")).alias("rougeL")


def rouge_n(df: DataFrame, n: int, key: By = ("pair_id",), stem: bool = False) -> DataFrame:
    """ROUGE-n F score (clipped n-gram overlap) of each ``reference`` and ``prediction``.

    Grams are counted within the row, so neither texts nor grams are shuffled.
    """
    return _with_tokens(df, stem).select(*key, _rouge_n(n))


def rouge_l(df: DataFrame, key: By = ("pair_id",), stem: bool = False) -> DataFrame:
    """ROUGE-L F score per pair: longest common subsequence of the whole texts, within the row."""
    return _with_tokens(df, stem).select(*key, _rouge_l())


def rouge_report(df: DataFrame, by: By = (), stem: bool = True) -> DataFrame:
    """Mean ROUGE-1, ROUGE-2 and ROUGE-L and the number of pairs, in one pass; published figures use stems."""
    scores = _with_tokens(df, stem).select(*by, _rouge_n(1), _rouge_n(2), _rouge_l())
    means = [F.avg(c).alias(c) for c in ("rouge1", "rouge2", "rougeL")]
    return scores.groupBy(*by).agg(*means, F.count(F.lit(1)).alias("num_samples_evaluated"))


def stem_vocabulary(df: DataFrame, text: str = "text") -> DataFrame:
    """Stem of every distinct token: each word of the corpus is stemmed once."""
    words = exploded(df, tokens(F.col(text)), "token").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return words.select("token", stem_word(F.col("token")).alias("stem"), "n")
