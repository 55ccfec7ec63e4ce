"""Queries: requests, scores and answers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexflume.constants import MAX_CHARS
from lexflume.functions import scores, text
from lexflume.operators import scoring
from lexflume.plans.fixtures import Views, sql_class, sql_strip
from lexflume.plans.registry import registered

_P = ", ".join(f"round(p{i}, 6) AS p{i}" for i in range(3))


@registered(
    "SELECT request_id, array_to_string(list_filter([CASE WHEN text IS NULL THEN 'text is missing' END, "
    f"CASE WHEN length(text) < 1 THEN 'text is empty' END, CASE WHEN length(text) > {MAX_CHARS['keyword']} THEN "
    f"'text is longer than {MAX_CHARS['keyword']}' END, CASE WHEN coalesce(max_keywords, 10) NOT BETWEEN 1 AND 20 "
    "THEN 'max_keywords is not in 1..20' END], lambda x: x IS NOT NULL), '; ') AS reasons, "
    f"coalesce(length(text) BETWEEN 1 AND {MAX_CHARS['keyword']}, false) AND coalesce(max_keywords, 10) BETWEEN 1 AND 20 "
    "AS is_valid, coalesce(max_keywords, 10) AS max_keywords FROM req",
    views=("req",),
)
def validate_requests(v: Views) -> DataFrame:
    checked = scoring.validate_requests(v.req(), "keyword")
    return checked.select("request_id", F.array_join("reasons", "; ").alias("reasons"), "is_valid", "max_keywords")


@registered(
    f"SELECT request_id, CASE WHEN length(text) > {MAX_CHARS['sentiment']} THEN 'text is longer than "
    f"{MAX_CHARS['sentiment']}' WHEN length(text) < 1 THEN 'text is empty' ELSE '' END AS reasons, "
    f"length(text) BETWEEN 1 AND {MAX_CHARS['sentiment']} AS is_valid FROM req",
    views=("req",),
)
def validate_sentiment_requests(v: Views) -> DataFrame:
    checked = scoring.validate_requests(v.req(), "sentiment")
    return checked.select("request_id", F.array_join("reasons", "; ").alias("reasons"), "is_valid")


@registered(f"SELECT vec_id, {_P} FROM scored", views=("scored",))
def softmax(v: Views) -> DataFrame:
    p = v.logits().select("vec_id", scores.softmax(F.col("logits")).alias("p"))
    return p.select("vec_id", *[F.round(F.element_at("p", i + 1), 6).alias(f"p{i}") for i in range(3)])


@registered("SELECT vec_id, pred FROM scored", views=("scored",))
def argmax(v: Views) -> DataFrame:
    return v.logits().select("vec_id", scores.argmax(F.col("logits")).alias("pred"))


@registered(
    f"SELECT vec_id, {sql_class('pred')} AS label, round(greatest(p0, p1, p2), 6) AS confidence, "
    "round(p0, 6) AS negative, round(p1, 6) AS neutral, round(p2, 6) AS positive FROM scored",
    views=("scored",),
)
def predict_sentiment(v: Views) -> DataFrame:
    answered = scoring.predict_sentiment(v.logits())
    named = [F.round(F.element_at("probabilities", n), 6).alias(n) for n in ("negative", "neutral", "positive")]
    return answered.select("vec_id", "label", F.round("confidence", 6).alias("confidence"), *named)


@registered(
    "SELECT vec_id, sentiment, round(probability, 6) AS probability FROM (SELECT vec_id, p0 AS negative, "
    "p1 AS neutral, p2 AS positive FROM scored) UNPIVOT (probability FOR sentiment IN (negative, neutral, positive))",
    views=("scored",),
)
def probabilities_long(v: Views) -> DataFrame:
    long = scoring.probabilities_long(scoring.predict_sentiment(v.logits()), "vec_id")
    return long.withColumn("probability", F.round("probability", 6))


_LISTED = (
    "list_filter(list_transform(string_split(generated, ';'), lambda x: " + sql_strip("x") + "), lambda x: x <> '')[1:5]"
)


@registered(f"SELECT conv_id, turn, array_to_string({_LISTED}, '|') AS keywords FROM gen", views=("gen",))
def split_keywords(v: Views) -> DataFrame:
    listed = text.split_keywords(F.col("generated"), 5)
    return v.gen().select("conv_id", "turn", F.array_join(listed, "|").alias("keywords"))


@registered(
    "SELECT conv_id, turn, array_to_string(keywords, '; ') AS keywords_string, CAST(len(keywords) AS INTEGER) AS n, "
    "CASE WHEN length(text) > 200 THEN substring(text, 1, 200) || '...' ELSE text END AS preview FROM keywords_of",
    views=("keywords_of",),
)
def keywords_response(v: Views) -> DataFrame:
    answered = scoring.keywords_response(v.gen())
    return answered.select("conv_id", "turn", "keywords_string", F.size("keywords").alias("n"), "preview")


@registered(
    "SELECT conv_id, turn, CAST(generate_subscripts(keywords, 1) AS INTEGER) AS rank, unnest(keywords) AS keyword "
    "FROM keywords_of",
    views=("keywords_of",),
)
def ranked_keywords(v: Views) -> DataFrame:
    answered = scoring.keywords_response(v.gen()).withColumn("id", F.struct("conv_id", "turn"))
    return scoring.ranked_keywords(answered, "id").select("id.conv_id", "id.turn", "rank", "keyword")
