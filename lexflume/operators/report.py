"""Reports: sampled predictions, run comparison, evaluation records, targets."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexflume.constants import COMPARED_METRICS, SEED, TARGETS
from lexflume.functions.hashing import seeded_key
from lexflume.functions.scores import class_name
from lexflume.functions.text import preview
from lexflume.operators.distributed import merge_rows
from lexflume.operators.evaluate import classification_metrics, latency, per_class, rouge_report

By = Sequence[str]


def sample_predictions(df: DataFrame, key: str, n: int = 50, seed: int = SEED) -> DataFrame:
    """Random rows: text, true and predicted class, confidence."""
    sample = df.orderBy(seeded_key(F.col(key), seed), key).limit(n)
    return sample.select(
        key,
        F.col("text").alias("input_text"),
        class_name(F.col("label")).alias("true_label"),
        class_name(F.col("pred")).alias("predicted_label"),
        F.array_max("probabilities").alias("confidence"),
    )


def sample_keyword_predictions(df: DataFrame, key: str, n: int = 50, seed: int = SEED) -> DataFrame:
    """Random rows: document preview (always with ``...``), references, predictions."""
    sample = df.orderBy(seeded_key(F.col(key), seed), key).limit(n)
    return sample.select(
        key,
        preview(F.col("document"), always=True).alias("document"),
        F.col("reference").alias("true_keywords"),
        F.col("prediction").alias("predicted_keywords"),
    )


def metrics_long(metrics: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Metric columns to rows (run_id, task, metric, value); absent values are left out."""
    ids = [c for c in ("run_id", "task") if c in metrics.columns]
    numeric = names or [c for c, kind in metrics.dtypes if c not in ids and kind in ("double", "float", "int", "bigint")]
    casted = metrics.select(*ids, *[F.col(c).cast("double").alias(c) for c in numeric])
    return casted.unpivot(ids, numeric, "metric", "value").where(F.col("value").isNotNull())


def compare_runs(metrics: DataFrame, base: str, tuned: str) -> DataFrame:
    """Baseline and tuned value and their difference per task and metric.

    A metric one of the two runs lacks is left out, as is a whole missing task.
    Two records of one run and task fail: their metrics belong to different models.
    """
    wanted = [
        (F.col("task") == task) & F.col("metric").isin(*names) for task, names in COMPARED_METRICS.items()
    ]

    def value_of(run: str) -> Column:
        own = F.when(F.col("run_id") == run, F.col("value"))
        several = F.raise_error(F.lit(f"several records of run {run}")).cast("double")
        return F.when(F.count(own) > 1, several).otherwise(F.max(own))

    columns = sorted({m for names in COMPARED_METRICS.values() for m in names} & set(metrics.columns))
    return (
        metrics_long(metrics.where(F.col("run_id").isin(base, tuned)), columns)
        .where(reduce(lambda a, b: a | b, wanted))
        .groupBy("task", "metric")
        .agg(value_of(base).alias("baseline"), value_of(tuned).alias("tuned"))
        .where(F.col("baseline").isNotNull() & F.col("tuned").isNotNull())
        .withColumn("difference", F.col("tuned") - F.col("baseline"))
    )


def _described(record: DataFrame, task: str, run: dict[str, object]) -> DataFrame:
    as_column = lambda v: v if isinstance(v, Column) else F.lit(v)
    return record.select(F.lit(task).alias("task"), *[as_column(v).alias(k) for k, v in run.items()], "*")


def sentiment_record(conf: DataFrame, batches: DataFrame, run: dict[str, object], by: By = ()) -> DataFrame:
    """All metrics of a sentiment run as one typed row."""
    return _described(merge_rows([classification_metrics(conf, by), latency(batches, by)], by), "sentiment", run)


def keyword_record(
    pairs: DataFrame, batches: DataFrame, run: dict[str, object], by: By = (), stem: bool = True
) -> DataFrame:
    """All metrics of a keyword run as one typed row."""
    return _described(merge_rows([rouge_report(pairs, by, stem), latency(batches, by)], by), "keyword", run)


def confusion_findings(conf: DataFrame, k: int = 3) -> DataFrame:
    """Class with the highest recall, and the ``k`` most frequent wrong pairs."""
    best = (
        per_class(conf)
        .where(F.col("support") > 0)
        .orderBy(F.col("recall").desc(), "class_id")
        .limit(1)
        .select(
            F.lit("best_class").alias("finding"),
            F.col("class_name").alias("true_label"),
            F.lit(None).cast("string").alias("predicted_label"),
            F.col("recall").alias("value"),
        )
    )
    wrong = (
        conf.where((F.col("label") != F.col("pred")) & (F.col("n") > 0))
        .orderBy(F.col("n").desc(), "label", "pred")
        .limit(k)
        .select(
            F.lit("misclassified").alias("finding"),
            class_name(F.col("label")).alias("true_label"),
            class_name(F.col("pred")).alias("predicted_label"),
            F.col("n").cast("double").alias("value"),
        )
    )
    return best.unionByName(wrong)


def target_check(metrics: DataFrame, targets: Sequence[tuple[str, str, str, float]] = TARGETS) -> DataFrame:
    """Each metric that has a target, its limit, and whether it is met."""
    rows = F.array(*[F.struct(*[F.lit(x) for x in row]) for row in targets])
    stated = metrics.sparkSession.range(1).select(F.inline(rows).alias("task", "metric", "direction", "target"))
    long = metrics_long(metrics)
    met = F.when(F.col("direction") == ">", F.col("value") > F.col("target")).otherwise(
        F.col("value") < F.col("target")
    )
    return long.join(F.broadcast(stated), ["task", "metric"]).withColumn("passed", met)
