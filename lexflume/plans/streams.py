"""Queries: request streams, run over the arrived files to the end."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexflume.constants import MAX_CHARS
from lexflume.operators.models import Idf, idf_table
from lexflume.plans.fixtures import Views, sql_tokens
from lexflume.plans.modelling import trained
from lexflume.plans.registry import registered
from lexflume.session import scratch_path, stored
from lexflume.streaming import latency
from lexflume.streaming import requests as streams


def _arrived(v: Views) -> tuple[str, str]:
    path = scratch_path(v.spark, "requests")
    v.req().write.json(f"{path}/in")
    return f"{path}/in", path


_LIMIT = MAX_CHARS["sentiment"]


@registered(
    "SELECT request_id, CASE WHEN length(text) > 200 THEN substring(text, 1, 200) ELSE text END AS text, "
    f"CASE WHEN length(text) BETWEEN 1 AND {_LIMIT} THEN 'answered' ELSE 'rejected' END AS status, "
    f"CASE WHEN length(text) > {_LIMIT} THEN 'text is longer than {_LIMIT}' WHEN length(text) < 1 THEN 'text is empty' ELSE '' END AS reasons, "
    f"CASE WHEN length(text) BETWEEN 1 AND {_LIMIT} THEN true END AS well_formed FROM req",
    views=("req",),
)
def stream_sentiment(v: Views) -> DataFrame:
    """Every request answered by the stored model or rejected; an answer's label has the highest probability."""
    arrived, path = _arrived(v)
    _, model = trained(v)
    requests = streams.request_stream(v.spark, arrived)
    streams.stream_sentiment(requests, model, f"{path}/out", f"{path}/progress").awaitTermination()
    answers = streams.read_answers(v.spark, f"{path}/out", "sentiment")
    p = F.map_values("probabilities")
    total = F.aggregate(p, F.lit(0.0), lambda s, x: s + x)
    fits = (F.abs(total - 1) < 1e-9) & (F.col("confidence") == F.array_max(p)) & (F.element_at("probabilities", F.col("label")) == F.col("confidence"))
    shown = F.substring("text", 1, 200).alias("text")
    answered = answers.select("request_id", shown, F.lit("answered").alias("status"), F.lit("").alias("reasons"), fits.alias("well_formed"))
    rejects = streams.read_rejects(v.spark, f"{path}/out")
    rejected = rejects.select(
        "request_id", shown, F.lit("rejected").alias("status"), F.array_join("reasons", "; ").alias("reasons"),
        F.lit(None).cast("boolean").alias("well_formed"),
    )
    return answered.unionByName(rejected)


@registered(
    "SELECT * FROM (WITH valid AS (SELECT request_id, text, coalesce(max_keywords, 10) AS k FROM req WHERE "
    f"length(text) BETWEEN 1 AND {MAX_CHARS['keyword']} AND coalesce(max_keywords, 10) BETWEEN 1 AND 20), "
    "size AS (SELECT count(*) AS n FROM documents), "
    f"idf AS (SELECT term, ln(((SELECT n FROM size) + 1) / (count(DISTINCT doc_id) + 1)) AS idf FROM "
    f"(SELECT doc_id, unnest({sql_tokens('text')}) AS term FROM documents) GROUP BY term), "
    "tf AS (SELECT request_id, term, count(*) AS tf FROM (SELECT request_id, "
    f"unnest({sql_tokens('text')}) AS term FROM valid) GROUP BY request_id, term), "
    "scored AS (SELECT request_id, term, round(tf * coalesce(idf, ln((SELECT n FROM size) + 1)), 6) AS score "
    "FROM tf LEFT JOIN idf USING (term)), "
    "ranked AS (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY score DESC, term) AS r FROM scored) "
    "SELECT request_id, any_value(CASE WHEN length(text) > 200 THEN substring(text, 1, 200) || '...' ELSE text END) AS text, "
    "coalesce(string_agg(term, '; ' ORDER BY r) FILTER (WHERE r <= k), '') AS keywords_string, "
    "CAST(count(term) FILTER (WHERE r <= k) AS INTEGER) AS n_keywords "
    "FROM valid LEFT JOIN ranked USING (request_id) GROUP BY request_id)",
    views=("req",),
)
def stream_keywords(v: Views) -> DataFrame:
    arrived, path = _arrived(v)
    idf = stored(idf_table(v.table("documents")), "idf")
    requests = streams.request_stream(v.spark, arrived)
    streams.stream_keywords(requests, idf, f"{path}/out", f"{path}/progress").awaitTermination()
    answers = streams.read_answers(v.spark, f"{path}/out", "keyword")
    return answers.select("request_id", "text", "keywords_string", F.size("keywords").alias("n_keywords"))


@registered(
    "SELECT request_id, max(turn) AS last_turn, CAST(1 AS BIGINT) AS answers FROM (SELECT CAST(conv_id AS VARCHAR) AS request_id, turn "
    f"FROM conversations WHERE length(text) BETWEEN 1 AND {MAX_CHARS['keyword']}) GROUP BY request_id"
)
def stream_retries(v: Views) -> DataFrame:
    """Every conversation asks once per turn with one id, file by file: one answer for each, before and after a restart."""
    path = scratch_path(v.spark, "retries")
    turns = v.table("conversations").where(f"length(text) BETWEEN 1 AND {MAX_CHARS['keyword']}")
    asked = turns.select(
        F.col("conv_id").cast("string").alias("request_id"), "text", F.timestamp_seconds(F.col("turn")).alias("asked_at"), "turn"
    )
    idf = Idf.of(stored(idf_table(turns), "idf"))
    # whatever comes first is answered; the same files once more are retries of all of it
    for part in ("turn % 2 = 0", "turn % 2 = 1", "true"):
        asked.where(part).drop("turn").write.mode("append").json(f"{path}/in")
        once = streams.without_retries(streams.request_stream(v.spark, f"{path}/in", files_per_trigger=1))
        streams.stream_keywords(once, idf, f"{path}/out", f"{path}/progress").awaitTermination()
    answers = streams.read_answers(v.spark, f"{path}/out", "keyword")
    counted = answers.groupBy("request_id").agg(F.count(F.lit(1)).alias("answers"))
    last = asked.groupBy("request_id").agg(F.max("turn").alias("last_turn"))
    return counted.join(last, "request_id").select("request_id", "last_turn", "answers")


_HOURS = "time_bucket(INTERVAL 1 HOUR, CAST(ts AS TIMESTAMP))"


@registered(
    f"SELECT CAST(epoch({_HOURS}) AS BIGINT) AS window_start, count(value) AS n, round(avg(value), 6) AS mean_latency_ms, "
    "round(list_sort(list(value))[CAST(ceil(0.95 * count(value)) AS BIGINT)], 6) AS p95_latency_ms, "
    "round(max(value), 6) AS max_latency_ms FROM events WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY ALL"
)
def stream_latency(v: Views) -> DataFrame:
    """Hourly response times of a log that arrives in two parts, the stream being started again for the second."""
    path = scratch_path(v.spark, "latency")
    schema = "asked_at timestamp, response_ms double"
    log = v.table("events").select(F.col("ts").cast("timestamp").alias("asked_at"), F.col("value").alias("response_ms"), "event_id")
    for part in ("event_id % 2 = 0", "event_id % 2 = 1"):
        log.where(part).drop("event_id").write.mode("append").parquet(f"{path}/in")
        arriving = v.spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(f"{path}/in")
        latency.stream_latency(
            arriving, f"{path}/out", f"{path}/progress", "1 hour", late_after="3650 days"
        ).awaitTermination()
    found = latency.read_latency(v.spark, f"{path}/out")
    rounded = [F.round(c, 6).alias(c) for c in ("mean_latency_ms", "p95_latency_ms", "max_latency_ms")]
    return found.select(F.unix_seconds("window_start").alias("window_start"), "n", *rounded)
