"""Metric records: one row per run, stored by task."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

METRICS_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("task", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("lora_rank", T.IntegerType()),
        T.StructField("epochs", T.IntegerType()),
        T.StructField("learning_rate", T.DoubleType()),
        T.StructField("accuracy", T.DoubleType()),
        T.StructField("f1_macro", T.DoubleType()),
        T.StructField("f1_weighted", T.DoubleType()),
        T.StructField("precision", T.DoubleType()),
        T.StructField("recall", T.DoubleType()),
        T.StructField("f1_positive", T.DoubleType()),
        T.StructField("f1_neutral", T.DoubleType()),
        T.StructField("f1_negative", T.DoubleType()),
        T.StructField("rouge1", T.DoubleType()),
        T.StructField("rouge2", T.DoubleType()),
        T.StructField("rougeL", T.DoubleType()),
        T.StructField("mean_latency_ms", T.DoubleType()),
        T.StructField("p95_latency_ms", T.DoubleType()),
        T.StructField("num_samples_evaluated", T.LongType()),
    ]
)
TASKS = ("sentiment", "keyword")


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Store metric records as JSON, one folder per task and run; a run written again replaces its record."""
    typed = [
        F.col(f.name).cast(f.dataType).alias(f.name) for f in METRICS_SCHEMA.fields if f.name in metrics.columns
    ]
    writer = metrics.select(*typed).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("task", "run_id").json(path)


def read_metrics(spark: SparkSession, path: str, which: str = "both") -> DataFrame:
    """Stored records of one task or both; nothing stored yet gives an empty frame."""
    if which not in (*TASKS, "both"):
        raise ValueError(f"which must be sentiment, keyword or both, not {which}")
    try:
        stored = spark.read.schema(METRICS_SCHEMA).option("mode", "FAILFAST").json(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = spark.createDataFrame([], METRICS_SCHEMA)
    stored = stored.select(*METRICS_SCHEMA.names)
    return stored if which == "both" else stored.where(F.col("task") == which)
