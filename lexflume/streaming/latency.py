"""Response times of a running stream, by windows of event time.

Every window keeps the number of answers, the sum of their times and a mergeable quantile sketch, so the
state does not grow with the answers. A micro-batch writes the windows it changed to a folder of its own
number and overwrites it when it runs again; what counts is a window's latest state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lexflume.streaming.requests import ANSWER_SCHEMAS, ARRIVED

WINDOW = "1 minute"
# Answers asked this much before the latest one seen are late: they change no window any more.
LATE_AFTER = "10 minutes"
# Windows of fewer answers than this have exact percentiles, others have them to about 0.1% in rank.
SKETCH_SIZE = 4096

SCHEMA = (
    "window_start timestamp, window_end timestamp, n bigint, mean_latency_ms double, p95_latency_ms double, "
    "max_latency_ms double, batch int"
)


def answer_stream(spark: SparkSession, out: str, task: str, files_per_trigger: int = 1000) -> DataFrame:
    """Answers of a request stream as they are written."""
    return (
        spark.readStream.schema(ANSWER_SCHEMAS[task])
        .option("maxFilesPerTrigger", files_per_trigger)
        .option("basePath", f"{out}/answers")
        .json(f"{out}/answers/batch=*")
    )


def _measures(latency: Column) -> list[Column]:
    sketch = F.kll_sketch_agg_double(latency, SKETCH_SIZE)
    return [
        F.count(latency).alias("n"),
        F.avg(latency).alias("mean_latency_ms"),
        F.kll_sketch_get_quantile_double(sketch, F.lit(0.95)).alias("p95_latency_ms"),
        F.max(latency).alias("max_latency_ms"),
    ]


def by_window(answers: DataFrame, window: str = WINDOW, at: str = "asked_at", latency: str = "response_ms") -> DataFrame:
    """Answers, mean, P95 and longest response time per window, for a batch or a stream.

    P95 is the smallest time that at least 95% of the window's answers do not exceed. Answers without a
    time or a latency (null, NaN) are left out.
    """
    present = answers.where(F.col(at).isNotNull() & F.col(latency).isNotNull() & ~F.isnan(F.col(latency).cast("double")))
    span = F.window(at, window)
    grouped = present.groupBy(span).agg(*_measures(F.col(latency).cast("double")))
    return grouped.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *grouped.columns[1:]
    )


def stream_latency(
    answers: DataFrame,
    out: str,
    checkpoint: str,
    window: str = WINDOW,
    late_after: str = LATE_AFTER,
    at: str = "asked_at",
    latency: str = "response_ms",
    trigger: dict[str, object] = ARRIVED,
) -> StreamingQuery:
    """Keep ``by_window`` up to date under ``out`` while answers arrive."""

    def one_batch(changed: DataFrame, batch_id: int) -> None:
        changed.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return (
        by_window(answers.withWatermark(at, late_after), window, at, latency)
        .writeStream.outputMode("update")
        .foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def read_latency(spark: SparkSession, out: str) -> DataFrame:
    """The latest state of every window."""
    latest = Window.partitionBy("window_start", "window_end").orderBy(F.col("batch").desc())
    states = spark.read.schema(SCHEMA).parquet(out)
    return states.withColumn("_r", F.row_number().over(latest)).where("_r = 1").drop("_r", "batch")
