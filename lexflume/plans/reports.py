"""Queries: reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexflume.operators import evaluate, models, prepare, report, scoring
from lexflume.plans.evaluation import LCS_SQL, REPORT_SQL, confusion_of, rouge_n_sql
from lexflume.plans.fixtures import Views, sql_class, sql_key, sql_strip, sql_tokens
from lexflume.plans.registry import registered
from lexflume.session import scratch_path
from lexflume.sources import corpora, metrics

_METRICS = ("accuracy", "f1_macro", "precision", "recall", "f1_positive", "f1_neutral", "f1_negative")


_PAIR_ID = "(conv_id || '-' || turn)"


def _rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in cols})


def both_runs(v: Views) -> DataFrame:
    """Metrics of two runs over the same truth, assessed in one job."""
    scored = v.logits(1).withColumn("run_id", F.lit("baseline")).unionByName(
        v.logits(4).withColumn("run_id", F.lit("tuned"))
    )
    conf = evaluate.confusion(scoring.with_predictions(scored), ["run_id"])
    return evaluate.classification_metrics(conf, ["run_id"]).withColumn("task", F.lit("sentiment"))


@registered(
    f"SELECT vec_id, 'vector ' || vec_id AS input_text, {sql_class('label')} AS true_label, {sql_class('pred')} AS predicted_label, "
    f"round(greatest(p0, p1, p2), 6) AS confidence FROM scored ORDER BY {sql_key('vec_id')}, vec_id LIMIT 50",
    views=("scored",),
)
def sample_predictions(v: Views) -> DataFrame:
    scored = scoring.with_predictions(v.logits()).withColumn("text", F.concat(F.lit("vector "), "vec_id"))
    return _rounded(report.sample_predictions(scored, "vec_id"), "confidence")


@registered(
    f"SELECT {_PAIR_ID} AS pair_id, substring(reference, 1, 200) || '...' AS document, reference AS true_keywords, "
    f"prediction AS predicted_keywords FROM pairs ORDER BY {sql_key(_PAIR_ID)} LIMIT 50",
    views=("pairs",),
)
def sample_keyword_predictions(v: Views) -> DataFrame:
    pairs = v.pairs().withColumn("pair_id", F.concat_ws("-", "conv_id", "turn"))
    return report.sample_keyword_predictions(pairs.withColumn("document", F.col("reference")), "pair_id")


_LONG = (
    "SELECT run_id, metric, value FROM runs UNPIVOT (value FOR metric IN (accuracy, f1_macro, \"precision\", \"recall\", "
    "f1_positive, f1_neutral, f1_negative))"
)


@registered(
    "SELECT 'sentiment' AS task, metric, round(b.value, 6) AS baseline, round(t.value, 6) AS tuned, "
    f"round(t.value - b.value, 6) AS difference FROM (SELECT * FROM ({_LONG}) WHERE run_id = 'baseline') b "
    f"JOIN (SELECT * FROM ({_LONG}) WHERE run_id = 'tuned') t USING (metric)",
    views=("runs",),
)
def compare_runs(v: Views) -> DataFrame:
    return _rounded(report.compare_runs(both_runs(v), "baseline", "tuned"), "baseline", "tuned", "difference")


@registered(
    "SELECT 'sentiment' AS task, 'three components' AS model, 'baseline' AS type, "
    + ", ".join(f"round({m}, 6) AS {m}" for m in (*_METRICS, "f1_weighted", "mean_latency_ms", "p95_latency_ms"))
    + " FROM runs, latencies WHERE run_id = 'baseline'",
    views=("runs", "latencies"),
)
def evaluation_record(v: Views) -> DataFrame:
    run = {"model": "three components", "type": "baseline"}
    record = report.sentiment_record(confusion_of(v), v.batches(), run)
    return _rounded(record, *_METRICS, "f1_weighted", "mean_latency_ms", "p95_latency_ms")


@registered(
    "SELECT 'keyword' AS task, 'next turn' AS model, 'baseline' AS type, round(rouge1, 6) AS rouge1, round(rouge2, 6) AS rouge2, "
    'round("rougeL", 6) AS "rougeL", num_samples_evaluated, round(mean_latency_ms, 6) AS mean_latency_ms, '
    f"round(p95_latency_ms, 6) AS p95_latency_ms FROM ({REPORT_SQL}), latencies",
    views=("pairs", "latencies"),
)
def keyword_record(v: Views) -> DataFrame:
    run = {"model": "next turn", "type": "baseline"}
    record = report.keyword_record(v.pairs(), v.batches(), run, stem=False)
    return _rounded(record, "rouge1", "rouge2", "rougeL", "mean_latency_ms", "p95_latency_ms")


@registered(
    f"(SELECT 'best_class' AS finding, {sql_class('class_id')} AS true_label, CAST(NULL AS VARCHAR) AS predicted_label, "
    "round(recall, 6) AS value FROM per_class_ WHERE support > 0 ORDER BY recall DESC, class_id LIMIT 1) UNION ALL "
    f"(SELECT 'misclassified', {sql_class('label')}, {sql_class('pred')}, CAST(n AS DOUBLE) FROM conf WHERE label <> pred "
    "ORDER BY n DESC, label, pred LIMIT 3)",
    views=("per_class_", "conf"),
)
def confusion_findings(v: Views) -> DataFrame:
    return _rounded(report.confusion_findings(confusion_of(v)), "value")


@registered(
    "SELECT run_id, 'sentiment' AS task, metric, round(value, 6) AS value, '>' AS direction, "
    "CASE metric WHEN 'accuracy' THEN 0.85 ELSE 0.83 END::DOUBLE AS target, "
    f"value > CASE metric WHEN 'accuracy' THEN 0.85 ELSE 0.83 END AS passed FROM ({_LONG}) WHERE metric IN ('accuracy', 'f1_macro')",
    views=("runs",),
)
def target_check(v: Views) -> DataFrame:
    return _rounded(report.target_check(both_runs(v)), "value")


_KEYWORD_LONG = (
    f'SELECT metric, value FROM (SELECT rouge1, rouge2, "rougeL", mean_latency_ms FROM ({REPORT_SQL}), latencies) '
    'UNPIVOT (value FOR metric IN (rouge1, rouge2, "rougeL", mean_latency_ms))'
)


def _keyword_run(v: Views) -> DataFrame:
    """The next turn of a conversation taken as its keywords, as a metric record."""
    run = {"run_id": "baseline", "model": "next turn", "type": "baseline"}
    return report.keyword_record(v.pairs(), v.batches(), run, stem=False)


@registered(
    "SELECT 'baseline' AS run_id, 'keyword' AS task, metric, round(value, 6) AS value, CASE metric WHEN 'mean_latency_ms' THEN '<' ELSE '>' END "
    "AS direction, CASE metric WHEN 'mean_latency_ms' THEN 200 WHEN 'rouge1' THEN 0.35 ELSE 0.28 END::DOUBLE AS target, "
    "CASE metric WHEN 'mean_latency_ms' THEN value < 200 WHEN 'rouge1' THEN value > 0.35 ELSE value > 0.28 END AS passed "
    f"FROM ({_KEYWORD_LONG}) WHERE metric <> 'rouge2'",
    views=("pairs", "latencies"),
)
def keyword_target_check(v: Views) -> DataFrame:
    """Targets to exceed and a target to stay below."""
    return _rounded(report.target_check(_keyword_run(v)), "value")


@registered(
    f"SELECT run_id, 'sentiment' AS task, metric, round(value, 6) AS value FROM ({_LONG}) UNION ALL "
    f"SELECT 'baseline' AS run_id, 'keyword' AS task, metric, round(value, 6) AS value FROM ({_KEYWORD_LONG})",
    views=("runs", "pairs", "latencies"),
)
def read_both_metrics(v: Views) -> DataFrame:
    """Records of both tasks, stored and read together."""
    path = scratch_path(v.spark, "metrics")
    metrics.write_metrics(both_runs(v), path)
    metrics.write_metrics(_keyword_run(v), path)
    names = [*_METRICS, "rouge1", "rouge2", "rougeL", "mean_latency_ms"]
    return _rounded(report.metrics_long(metrics.read_metrics(v.spark, path), names), "value")


_TERMS = (
    f"terms AS (SELECT doc_id, unnest({sql_tokens('document')}) AS term FROM keys), "
    "tf AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY doc_id, term), "
    "idf AS (SELECT term, ln(((SELECT count(*) FROM keys) + 1) / (count(*) + 1)) AS idf FROM tf GROUP BY term), "
    "scored AS (SELECT doc_id, 0 AS run, term, CAST(tf AS DOUBLE) AS score FROM tf UNION ALL "
    "SELECT doc_id, 1, term, round(tf * idf, 6) FROM tf JOIN idf USING (term)), "
    "ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id, run ORDER BY score DESC, term) AS r FROM scored), "
    "predicted AS (SELECT doc_id, run, string_agg(term, '; ' ORDER BY r) AS prediction FROM ranked WHERE r <= 10 GROUP BY doc_id, run), "
    "pairs AS (SELECT doc_id AS conv_id, run AS turn, prediction, "
    + sql_strip("replace(array_to_string(keyphrases, '; '), '-100', '')")
    + " AS reference FROM keys JOIN predicted USING (doc_id) WHERE reference <> '')"
)


@registered(
    f"SELECT * FROM (WITH RECURSIVE {_TERMS}, {rouge_n_sql(1)}, {rouge_n_sql(2)}, {LCS_SQL}, "
    "means AS (SELECT metric, turn, avg(f) AS value FROM (SELECT 'rouge1' AS metric, turn, f FROM r1 UNION ALL "
    "SELECT 'rouge2', turn, f FROM r2 UNION ALL SELECT 'rougeL', turn, f FROM rl) GROUP BY metric, turn) "
    "SELECT 'keyword' AS task, metric, round(b.value, 6) AS baseline, round(t.value, 6) AS tuned, "
    "round(t.value - b.value, 6) AS difference FROM (SELECT * FROM means WHERE turn = 0) b JOIN (SELECT * FROM means WHERE turn = 1) t USING (metric))",
    views=("keys",),
)
def compare_keyword_runs(v: Views) -> DataFrame:
    """From texts to the comparison of two runs: extract, align, clean, ROUGE, record, read, compare.

    Frequent terms are the baseline, terms by tf-idf the tuned run; references are the documents' keyphrases.
    """
    keys = prepare.pick_keyphrases(v.keys())
    texts = keys.select("doc_id", F.col("document").alias("text"))
    found = {"baseline": models.baseline_keywords(texts), "tuned": models.extract_keywords(texts)}
    runs = [models.keywords_per_document(ranked).withColumn("run_id", F.lit(run)) for run, ranked in found.items()]
    predicted = runs[0].unionByName(runs[1]).select("doc_id", "run_id", F.col("generated").alias("prediction"))
    aligned = evaluate.align(predicted, keys.select("doc_id", F.col("keywords_str").alias("reference")), "doc_id")
    scores = evaluate.rouge_report(evaluate.clean_references(aligned), ["run_id"], stem=False)
    path = scratch_path(v.spark, "metrics")
    metrics.write_metrics(scores.withColumn("task", F.lit("keyword")), path)
    compared = report.compare_runs(metrics.read_metrics(v.spark, path, "keyword"), "baseline", "tuned")
    return _rounded(compared, "baseline", "tuned", "difference")


@registered(
    f"SELECT 'vector ' || vec_id AS input_text, {sql_class('label')} AS true_label, {sql_class('pred')} AS predicted_label, "
    f"round(greatest(p0, p1, p2), 6) AS confidence FROM scored ORDER BY {sql_key('vec_id')}, vec_id LIMIT 50",
    views=("scored",),
)
def write_samples(v: Views) -> DataFrame:
    """The sample of predictions exported as one CSV file and read again."""
    scored = scoring.with_predictions(v.logits()).withColumn("text", F.concat(F.lit("vector "), "vec_id"))
    sample = report.sample_predictions(scored, "vec_id").select("input_text", "true_label", "predicted_label", "confidence")
    path = scratch_path(v.spark, "samples")
    corpora.write_samples(sample, path)
    back = v.spark.read.schema(sample.schema).options(header="true", escape='"', mode="FAILFAST").csv(path)
    return _rounded(back, "confidence")
