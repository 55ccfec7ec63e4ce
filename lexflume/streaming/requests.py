"""Request streams: validate, score, answer; rejects go to their own sink.

Requests that say when they were asked are answered with their response time. Retries - requests with
an id that was seen less than ``RETRIES_WITHIN`` before - are answered once, across micro-batches and
restarts.

Each micro-batch runs the batch functions unchanged. A batch writes to a folder
of its own number and overwrites it when it is run again after a failure, so
answers appear exactly once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from lexflume.constants import MAX_KEYWORDS
from lexflume.functions.text import join_keywords
from lexflume.operators.models import Idf, score_classifier, with_ranked_terms
from lexflume.operators.scoring import keywords_response, predict_sentiment, validate_requests

REQUEST_SCHEMA = T.StructType(
    [
        T.StructField("request_id", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("max_keywords", T.IntegerType()),
        T.StructField("asked_at", T.TimestampType()),
    ]
)
# How long the ids of answered requests are kept.
RETRIES_WITHIN = "10 minutes"


def request_stream(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """Requests arriving as JSON files."""
    reader = spark.readStream.schema(REQUEST_SCHEMA).option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


def without_retries(requests: DataFrame, within: str = RETRIES_WITHIN) -> DataFrame:
    """A stream's requests with one of each ``request_id``; later ones with an id seen before are left out.

    An id is remembered until the stream's ``asked_at`` has moved on by ``within``, so the state holds
    the ids of that time and no more; an id that comes again after that is a request of its own, and a
    request asked longer ago than ``within`` before the latest one is late and may be left out. A
    request without an id or without a time cannot be told from others: each one is kept.
    """
    timed = F.col("request_id").isNotNull() & F.col("asked_at").isNotNull()
    # rows that are kept apart carry no time, so they neither move the watermark nor fall behind it
    first = requests.where(timed).withWatermark("asked_at", within).dropDuplicatesWithinWatermark(["request_id"])
    return first.unionByName(requests.where(~timed))


def with_response_time(answers: DataFrame) -> DataFrame:
    """When a request was answered, and how many milliseconds after it was asked."""
    now = F.current_timestamp()
    waited = (F.unix_micros(now) - F.unix_micros("asked_at")) / 1000
    return answers.withColumns({"answered_at": now, "response_ms": waited})


def _timed(requests: DataFrame, *columns: str) -> DataFrame:
    """These columns and when the request was asked, null where requests do not say."""
    asked = F.col("asked_at") if "asked_at" in requests.columns else F.lit(None).cast("timestamp").alias("asked_at")
    return requests.select(*columns, asked)


def answer_sentiment(requests: DataFrame, model: PipelineModel) -> DataFrame:
    """Answers to valid sentiment requests."""
    scored = score_classifier(_timed(requests, "request_id", "text"), model)
    return predict_sentiment(scored).select("request_id", "text", "label", "confidence", "probabilities", "asked_at")


def answer_keywords(requests: DataFrame, idf: DataFrame | Idf) -> DataFrame:
    """One answer per valid keyword request; a text without terms gets an empty list.

    Keywords are found within the request's row, so null and repeated ids are answered row by row.
    """
    held = idf if isinstance(idf, Idf) else Idf.of(idf)
    ranked = with_ranked_terms(_timed(requests, "request_id", "text", "max_keywords"), MAX_KEYWORDS, held)
    generated = join_keywords(F.transform("ranked", lambda t: t["term"]))
    answered = keywords_response(ranked.withColumn("generated", generated))
    return answered.select("request_id", F.col("preview").alias("text"), "keywords", "keywords_string", "asked_at")


# Answer what has arrived, then stop; {"processingTime": "10 seconds"} goes on.
ARRIVED = {"availableNow": True}


def _run(
    requests: DataFrame,
    task: str,
    answer: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
    trigger: dict[str, object],
) -> StreamingQuery:
    def one_batch(batch: DataFrame, batch_id: int) -> None:
        checked = validate_requests(batch, task).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            valid = checked.where("is_valid").drop("is_valid", "reasons")
            with_response_time(answer(valid)).write.mode("overwrite").json(f"{out}/answers/batch={batch_id}")
            rejected = checked.where("NOT is_valid").select("request_id", "text", "reasons")
            rejected.write.mode("overwrite").json(f"{out}/rejects/batch={batch_id}")
        finally:
            checked.unpersist()

    return (
        requests.writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def stream_sentiment(
    requests: DataFrame,
    model: PipelineModel,
    out: str,
    checkpoint: str,
    trigger: dict[str, object] = ARRIVED,
) -> StreamingQuery:
    """Answer sentiment requests with a trained model."""
    return _run(requests, "sentiment", lambda valid: answer_sentiment(valid, model), out, checkpoint, trigger)


def stream_keywords(
    requests: DataFrame,
    idf: DataFrame | Idf,
    out: str,
    checkpoint: str,
    trigger: dict[str, object] = ARRIVED,
) -> StreamingQuery:
    """Answer keyword requests with a stored IDF table, whose size is looked at once and not per batch."""
    held = idf if isinstance(idf, Idf) else Idf.of(idf)
    return _run(requests, "keyword", lambda valid: answer_keywords(valid, held), out, checkpoint, trigger)


ANSWER_SCHEMAS = {
    task: columns + ", asked_at timestamp, answered_at timestamp, response_ms double, batch int"
    for task, columns in {
        "sentiment": "request_id string, text string, label string, confidence double, probabilities map<string,double>",
        "keyword": "request_id string, text string, keywords array<string>, keywords_string string",
    }.items()
}
REJECT_SCHEMA = "request_id string, text string, reasons array<string>, batch int"


def read_answers(spark: SparkSession, out: str, task: str) -> DataFrame:
    """Answers written so far."""
    return spark.read.schema(ANSWER_SCHEMAS[task]).json(f"{out}/answers")


def read_rejects(spark: SparkSession, out: str) -> DataFrame:
    """Rejects written so far, with their reasons."""
    return spark.read.schema(REJECT_SCHEMA).json(f"{out}/rejects")
