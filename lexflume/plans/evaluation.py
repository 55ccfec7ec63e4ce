"""Queries: classification metrics, latency, ROUGE."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexflume.operators import evaluate, scoring
from lexflume.plans.fixtures import Views, sql_class, sql_tokens
from lexflume.plans.registry import registered

PAIR = ("conv_id", "turn")


def _rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in cols})


def confusion_of(v: Views, first: int = 1) -> DataFrame:
    return evaluate.confusion(scoring.with_predictions(v.logits(first)))


_GRID = (
    "SELECT a.id AS label, b.id AS pred, (SELECT count(*) FROM scored WHERE label = a.id AND pred = b.id) AS n "
    "FROM (SELECT unnest([0, 1, 2]) AS id) a, (SELECT unnest([0, 1, 2]) AS id) b"
)


@registered(_GRID, views=("scored",))
def confusion(v: Views) -> DataFrame:
    return confusion_of(v)


@registered(
    f"SELECT {sql_class('label')} AS true_label, "
    + ", ".join(
        f"CAST(sum(n) FILTER (WHERE pred = {i}) AS BIGINT) AS pred_{name}"
        for i, name in enumerate(("negative", "neutral", "positive"))
    )
    + ", CAST(coalesce(sum(n) FILTER (WHERE pred IS NULL OR pred NOT IN (0, 1, 2)), 0) AS BIGINT) AS pred_other"
    + f" FROM ({_GRID}) GROUP BY label",
    views=("scored",),
)
def confusion_matrix(v: Views) -> DataFrame:
    return evaluate.confusion_matrix(scoring.with_predictions(v.logits()))


@registered("SELECT round(avg(CASE WHEN label = pred THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM scored", views=("scored",))
def accuracy(v: Views) -> DataFrame:
    return _rounded(evaluate.accuracy(confusion_of(v)), "accuracy")


@registered(
    f"SELECT class_id, {sql_class('class_id')} AS class_name, round(precision, 6) AS precision, round(recall, 6) AS recall, "
    "round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM per_class_",
    views=("per_class_",),
)
def per_class(v: Views) -> DataFrame:
    found = evaluate.per_class(confusion_of(v)).drop("predicted", "hits")
    return _rounded(found, "precision", "recall", "f1")


@registered(
    "SELECT round(f1_macro, 6) AS f1_macro, round(precision, 6) AS precision, round(recall, 6) AS recall FROM runs "
    "WHERE run_id = 'baseline'",
    views=("runs",),
)
def macro(v: Views) -> DataFrame:
    return _rounded(evaluate.macro(confusion_of(v)), "f1_macro", "precision", "recall")


@registered("SELECT round(f1_weighted, 6) AS f1_weighted FROM runs WHERE run_id = 'baseline'", views=("runs",))
def weighted_f1(v: Views) -> DataFrame:
    return _rounded(evaluate.weighted_f1(confusion_of(v)), "f1_weighted")


@registered(
    "SELECT round(mean_latency_ms, 6) AS mean_latency_ms, round(p95_latency_ms, 6) AS p95_latency_ms FROM latencies",
    views=("latencies",),
)
def latency(v: Views) -> DataFrame:
    return _rounded(evaluate.latency(v.batches()), "mean_latency_ms", "p95_latency_ms")


@registered("SELECT conv_id, turn, reference, prediction FROM cleaned", views=("cleaned",))
def clean_references(v: Views) -> DataFrame:
    return evaluate.clean_references(v.refs())


@registered(
    "SELECT conv_id, turn, reference, prediction FROM cleaned ORDER BY conv_id, turn LIMIT 100",
    views=("cleaned",),
)
def first_n(v: Views) -> DataFrame:
    return evaluate.first_n(v.refs(), 100, *PAIR)


@registered(
    f"SELECT vec_id, {sql_class('label')} AS true_label, {sql_class('pred')} AS predicted_label FROM scored",
    views=("scored",),
)
def align(v: Views) -> DataFrame:
    predicted = scoring.predict_sentiment(v.logits().drop("label")).select(
        "vec_id", F.col("label").alias("predicted_label")
    )
    truth = v.logits().select("vec_id", scoring.class_name(F.col("label")).alias("true_label"))
    return evaluate.align(predicted, truth, "vec_id")


def rouge_n_sql(n: int) -> str:
    """CTEs ``grams`` and ``r<n>``: one F score per pair."""
    gram = "array_to_string(t[i:i + {0}], ' ')".format(n - 1)
    side = (
        "SELECT conv_id, turn, '{0}' AS side, unnest(list_transform(range(1, len(t) - {1} + 2), lambda i: {2})) AS g "
        "FROM (SELECT conv_id, turn, {3} AS t FROM pairs)"
    )
    grams = " UNION ALL ".join(
        side.format(s, n, gram, sql_tokens(c)) for s, c in (("r", "reference"), ("p", "prediction"))
    )
    return (
        f"c{n} AS (SELECT conv_id, turn, g, count(*) FILTER (WHERE side = 'r') AS r, count(*) FILTER (WHERE side = 'p') AS p "
        f"FROM ({grams}) GROUP BY conv_id, turn, g), "
        f"s{n} AS (SELECT conv_id, turn, sum(least(r, p)) AS hits, sum(r) AS nr, sum(p) AS np FROM c{n} GROUP BY conv_id, turn), "
        f"r{n} AS (SELECT conv_id, turn, coalesce(CASE WHEN nr + np > 0 THEN 2.0 * hits / (nr + np) END, 0.0) AS f "
        f"FROM pairs LEFT JOIN s{n} USING (conv_id, turn))"
    )


# Longest common subsequence of whole texts: one recursion step per token of the
# shorter text, a running maximum over the longer one.
LCS_SQL = (
    f"t AS MATERIALIZED (SELECT conv_id, turn, {sql_tokens('reference')} AS r, {sql_tokens('prediction')} AS p FROM pairs), "
    "o AS MATERIALIZED (SELECT conv_id, turn, CASE WHEN len(r) <= len(p) THEN r ELSE p END AS s, "
    "CASE WHEN len(r) <= len(p) THEN p ELSE r END AS l FROM t), "
    "step(conv_id, turn, i, j, tok, v) AS ("
    "SELECT conv_id, turn, 0, j, tok, 0 FROM (SELECT conv_id, turn, unnest(l) AS tok, generate_subscripts(l, 1) AS j FROM o) "
    "UNION ALL SELECT conv_id, turn, i + 1, j, tok, max(c) OVER (PARTITION BY conv_id, turn ORDER BY j) FROM ("
    "SELECT x.conv_id, x.turn, x.i, x.j, x.tok, CASE WHEN o.s[x.i + 1] = x.tok THEN 1 + lag(v, 1, 0) OVER "
    "(PARTITION BY x.conv_id, x.turn ORDER BY x.j) ELSE v END AS c FROM step x JOIN o USING (conv_id, turn) "
    "WHERE x.i < len(o.s))), "
    "rl AS (SELECT conv_id, turn, CASE WHEN len(s) + len(l) > 0 THEN 2.0 * coalesce(m, 0) / (len(s) + len(l)) ELSE 0.0 END AS f "
    "FROM o LEFT JOIN (SELECT conv_id, turn, max(v) AS m FROM step GROUP BY conv_id, turn) USING (conv_id, turn))"
)


def _rouge_query(n: int, v: Views) -> DataFrame:
    return _rounded(evaluate.rouge_n(v.pairs(), n, PAIR), f"rouge{n}")


@registered(
    f"SELECT * FROM (WITH {rouge_n_sql(1)} SELECT conv_id, turn, round(f, 6) AS rouge1 FROM r1)", views=("pairs",)
)
def rouge_n(v: Views) -> DataFrame:
    return _rouge_query(1, v)


@registered(
    f"SELECT * FROM (WITH {rouge_n_sql(2)} SELECT conv_id, turn, round(f, 6) AS rouge2 FROM r2)", views=("pairs",)
)
def rouge_2(v: Views) -> DataFrame:
    return _rouge_query(2, v)


@registered(
    f'SELECT * FROM (WITH RECURSIVE {LCS_SQL} SELECT conv_id, turn, round(f, 6) AS "rougeL" FROM rl)', views=("pairs",)
)
def rouge_l(v: Views) -> DataFrame:
    return _rounded(evaluate.rouge_l(v.pairs(), PAIR), "rougeL")


REPORT_SQL = (
    f"WITH RECURSIVE {rouge_n_sql(1)}, {rouge_n_sql(2)}, {LCS_SQL} SELECT (SELECT avg(f) FROM r1) AS rouge1, "
    '(SELECT avg(f) FROM r2) AS rouge2, (SELECT avg(f) FROM rl) AS "rougeL", (SELECT count(*) FROM pairs) AS num_samples_evaluated'
)


@registered(
    'SELECT round(rouge1, 6) AS rouge1, round(rouge2, 6) AS rouge2, round("rougeL", 6) AS "rougeL", num_samples_evaluated '
    f"FROM ({REPORT_SQL})",
    views=("pairs",),
)
def rouge_report(v: Views) -> DataFrame:
    return _rounded(evaluate.rouge_report(v.pairs(), stem=False), "rouge1", "rouge2", "rougeL")


@registered()
def rouge_report_stemmed(v: Views) -> DataFrame:
    return _rounded(evaluate.rouge_report(v.pairs(), stem=True), "rouge1", "rouge2", "rougeL")


@registered()
def stem_vocabulary(v: Views) -> DataFrame:
    return evaluate.stem_vocabulary(v.table("documents"))
