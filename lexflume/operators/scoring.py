"""Requests, predictions and the answers made of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexflume.constants import (
    CLASS_IDS,
    DEFAULT_KEYWORDS,
    MAX_CHARS,
    MAX_KEYWORDS,
    MIN_KEYWORDS,
)
from lexflume.functions.scores import argmax, class_name, named_probabilities, softmax
from lexflume.functions.text import join_keywords, preview, split_keywords


def validate_requests(df: DataFrame, task: str) -> DataFrame:
    """Check requests; ``reasons`` says what is wrong, empty for a valid one."""
    chars = F.length("text")
    checks: list[Column] = [
        F.when(F.col("text").isNull(), "text is missing"),
        F.when(chars < 1, "text is empty"),
        F.when(chars > MAX_CHARS[task], f"text is longer than {MAX_CHARS[task]}"),
    ]
    if task == "keyword":
        asked = F.col("max_keywords") if "max_keywords" in df.columns else F.lit(None)
        df = df.withColumn("max_keywords", F.coalesce(asked, F.lit(DEFAULT_KEYWORDS)).cast("int"))
        in_range = F.col("max_keywords").between(MIN_KEYWORDS, MAX_KEYWORDS)
        checks.append(F.when(~in_range, f"max_keywords is not in {MIN_KEYWORDS}..{MAX_KEYWORDS}"))
    checked = df.withColumn("reasons", F.array_compact(F.array(*checks)))
    return checked.withColumn("is_valid", F.size("reasons") == 0)


def with_predictions(df: DataFrame, logits: str = "logits") -> DataFrame:
    """Add probabilities and the predicted class id."""
    z = F.col(logits)
    return df.withColumn("probabilities", softmax(z)).withColumn("pred", argmax(z))


def predict_sentiment(df: DataFrame, logits: str = "logits") -> DataFrame:
    """Add label, confidence and the name -> probability map of each row of logits."""
    scored = with_predictions(df, logits)
    return scored.select(
        *[c for c in df.columns if c not in ("label", "confidence")],
        class_name(F.col("pred")).alias("label"),
        F.element_at("probabilities", F.col("pred") + 1).alias("confidence"),
        named_probabilities(F.col("probabilities")).alias("probabilities"),
    )


def probabilities_long(df: DataFrame, key: str, probabilities: str = "probabilities") -> DataFrame:
    """One row per class, as a bar chart wants them."""
    return df.select(key, F.explode(probabilities).alias("sentiment", "probability"))


def keywords_response(df: DataFrame, generated: str = "generated", k: Column | int | None = None) -> DataFrame:
    """Add the keyword list, its string form and the text preview."""
    limit = F.col("max_keywords") if k is None and "max_keywords" in df.columns else k
    listed = df.withColumn("keywords", split_keywords(F.col(generated), DEFAULT_KEYWORDS if limit is None else limit))
    return listed.withColumn("keywords_string", join_keywords(F.col("keywords"))).withColumn(
        "preview", preview(F.col("text"))
    )


def ranked_keywords(df: DataFrame, key: str, keywords: str = "keywords") -> DataFrame:
    """One row per keyword, numbered from 1."""
    listed = df.select(key, F.posexplode(keywords).alias("pos", "keyword"))
    return listed.select(key, (F.col("pos") + 1).alias("rank"), "keyword")


def class_grid() -> Column:
    """All (label, pred) pairs of the fixed classes, as an array of structs."""
    return F.array(
        *[
            F.struct(F.lit(a).cast("int").alias("label"), F.lit(b).cast("int").alias("pred"))
            for a in CLASS_IDS
            for b in CLASS_IDS
        ]
    )
