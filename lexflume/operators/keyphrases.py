"""Keyphrases of several words.

Candidates are runs of neighbouring tokens without a stop word or a punctuation mark between them. What
the corpus knows of a phrase - how often it occurs, in how many rows, and how much of that belongs to
longer phrases around it - is counted in parts of all phrases; phrases that occur once are left out
ahead of that by a map of hashes. A row's phrases are ranked within the row, or if they are not among
those that every task holds, once they have met their part of the table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexflume.constants import DEFAULT_KEYWORDS
from lexflume.functions.phrases import best_of_table, by_hash, counted_phrases, known_phrases, ranked_phrases, repeated_phrases
from lexflume.operators.keyed import KeyedTable
from lexflume.operators.models import idf_table
from lexflume.session import hand_small_batches, stored

# Words of a phrase.
FEWEST, MOST = 2, 4
# A token in at least this share of all rows is a stop word.
STOP_SHARE = 0.1
# A phrase occurs at least this often in the corpus.
LEAST_COUNT = 2
# Phrases of a table, and rows, that meet in one part.
PART_PHRASES, PART_ROWS = 1 << 16, 1 << 12


def stop_words(df: DataFrame, text: str = "text", share: float = STOP_SHARE) -> DataFrame:
    """(token, stop): tokens in at least ``share`` of all rows.

    With rows of t distinct tokens on average there are t / share of them at most.
    """
    found = idf_table(df, text).where(F.col("doc_freq") >= F.col("n_docs") * share)
    return found.select(F.col("term").alias("token"), F.lit(1).alias("stop"))


def _all_stops(stops: KeyedTable) -> Broadcast:
    """Broadcast of all stop words: together they are no longer than 1 / share texts of average length."""
    found = stops.rows.select(stops.key).toArrow().column(0)
    words = pa.concat_arrays([pa.array([], pa.string()), *[c.cast(pa.string()) for c in found.chunks]])
    return stops.rows.sparkSession.sparkContext.broadcast(words)


@dataclass(frozen=True)
class Phrases:
    """What a corpus knows of its phrases: the stop words they were cut at, and (phrase, ..., weight)."""

    stops: KeyedTable
    table: KeyedTable
    fewest: int = FEWEST
    most: int = MOST


def phrase_table(
    df: DataFrame,
    stops: KeyedTable,
    text: str = "text",
    least: int = LEAST_COUNT,
    fewest: int = FEWEST,
    most: int = MOST,
) -> DataFrame:
    """(phrase, words, f, doc_freq, n_docs, around, around_n, weight) of every phrase with f >= ``least``.

    ``around`` is how often the ``around_n`` longer phrases that contain it occur in sum. The part of f
    that they take on average is not the phrase's own: weight = idf * log2(1 + words) * (f - around /
    around_n) / f, with idf = ln((n_docs + 1) / (doc_freq + 1)), rounded to 6 digits.
    """
    spark = df.sparkSession
    hand_small_batches(spark)
    texts = df.select(F.lower(F.col(text)).alias("text"))
    n_docs, size = df.agg(F.count(F.lit(1)), F.sum(F.octet_length(F.col(text)))).first()
    words = _all_stops(stops)
    repeated = spark.sparkContext.broadcast(repeated_phrases(texts, words, fewest, most, least, size or 0))
    counted = counted_phrases(texts, words, repeated, fewest, most, least, size or 0)
    own = F.when(F.col("around_n") > 0, (F.col("f") - F.col("around") / F.col("around_n")) / F.col("f")).otherwise(F.lit(1.0))
    idf = F.log((F.col("n_docs") + 1) / (F.col("doc_freq") + 1))
    weight = F.round(idf * F.log2(F.lit(1.0) + F.col("words")) * own, 6)
    counted = counted.withColumn("n_docs", F.lit(n_docs).cast("bigint"))
    return counted.select("phrase", "words", "f", "doc_freq", "n_docs", "around", "around_n", weight.alias("weight"))


def learn_phrases(
    df: DataFrame,
    text: str = "text",
    least: int = LEAST_COUNT,
    share: float = STOP_SHARE,
    fewest: int = FEWEST,
    most: int = MOST,
    **limits: int,
) -> Phrases:
    """Stop words and phrase table of a corpus, both stored; used for any number of frames and for streams."""
    stops = KeyedTable(stored(stop_words(df, text, share), "stops"), "token", **limits)
    table = stored(phrase_table(df, stops, text, least, fewest, most), "phrase-table")
    return Phrases(stops, KeyedTable(table, "phrase", often="f", **limits), fewest, most)


def with_ranked_phrases(
    df: DataFrame, k: int, phrases: Phrases, text: str = "text", out: str = "ranked", keep: Sequence[str] | None = None
) -> DataFrame:
    """``df`` (its columns ``keep``, or all) with ``out``, each row's ``k`` best phrases as an array of (term, score), score = tf * weight.

    Phrases the table lacks are left out, and so are those without a weight of their own (they occur
    only within longer ones). Ties go to the phrase that comes first.
    """
    spark = df.sparkSession
    hand_small_batches(spark)
    table = phrases.table
    # what weighs nothing is no row's phrase
    weighty = table.rows.where(F.col("weight") > 0).select(table.key, "weight")
    size = weighty.count()
    known = spark.sparkContext.broadcast(known_phrases(weighty.select(table.key), phrases.most, size))
    held = spark.sparkContext.broadcast(by_hash(*table.held_columns("weight")))
    kept = [c for c in df.columns if keep is None or c in keep]
    found = ranked_phrases(_all_stops(phrases.stops), known, held, table.small, phrases.fewest, phrases.most, k)
    rows = df.select(*kept, found(F.col(text)).alias("_found"))
    if table.small:
        return rows.select(*kept, F.col("_found.best").alias(out))
    # written once: the rows are read several times below, and keep their numbers
    rows = stored(rows.withColumn("_row", F.monotonically_increasing_id()), "ranked")
    facts = rows.where("_found.phrases IS NOT NULL").select("_row", "_found.phrases", "_found.n")
    parts, row_parts = size // PART_PHRASES + 1, rows.count() // PART_ROWS + 1
    others = best_of_table(facts, weighty, k, parts, row_parts)
    both = F.concat("_found.best", F.coalesce("ranked", F.array().cast(others.schema["ranked"].dataType)))
    ordered = F.array_sort(F.transform(both, lambda t: F.struct((-t["score"]).alias("w"), t["term"].alias("term"))))
    best = F.transform(F.slice(ordered, 1, k), lambda t: F.struct(t["term"].alias("term"), (-t["w"]).alias("score")))
    return rows.join(others, "_row", "left").select(*kept, best.alias(out))


def extract_keyphrases(
    df: DataFrame, k: int = DEFAULT_KEYWORDS, phrases: Phrases | None = None, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Rows (key, rank, term, score) of the ``k`` best phrases of every row; a null text has none.

    Rows with equal or null keys are ranked apart. Without ``phrases`` they are learned from ``df``.
    """
    held = learn_phrases(df, text) if phrases is None else phrases
    ranked = with_ranked_phrases(df.select(key, F.col(text).alias("_text")), k, held, "_text", keep=[key])
    rows = ranked.select(key, F.posexplode_outer("ranked").alias("pos", "t")).where(F.col("t").isNotNull())
    return rows.select(key, (F.col("pos") + 1).alias("rank"), F.col("t.term").alias("term"), F.col("t.score").alias("score"))
