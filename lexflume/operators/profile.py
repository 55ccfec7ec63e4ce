"""Profiling: class balance, lengths, distributions, samples, data quality."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexflume.constants import SEED, SPLITS
from lexflume.functions.hashing import seeded_key
from lexflume.functions.text import join_keywords, preview, word_count
from lexflume.operators.distributed import (
    exact_quantiles,
    join_group_facts,
    merge_rows,
    value_counts,
)

By = Sequence[str]


def split_counts(df: DataFrame) -> DataFrame:
    """Rows per split and a ``total`` row."""
    counted = df.rollup("split").agg(F.count(F.lit(1)).alias("n"), F.grouping("split").alias("all"))
    return counted.select(F.when(F.col("all") == 1, "total").otherwise(F.col("split")).alias("split"), "n")


def head_rows(df: DataFrame, order: str, n: int = 5) -> DataFrame:
    """First ``n`` rows by key."""
    return df.orderBy(order).limit(n)


def class_counts(df: DataFrame, name: str = "label_name") -> DataFrame:
    """Rows per split and class, null classes left out, largest first."""
    return _class_counts(df, name).orderBy("split", F.col("n").desc(), name)


def _class_counts(df: DataFrame, name: str) -> DataFrame:
    return df.where(F.col(name).isNotNull()).groupBy("split", name).agg(F.count(F.lit(1)).alias("n"))


def class_balance(df: DataFrame, name: str = "label_name") -> DataFrame:
    """Share of each class among the rows of its split that have a class.

    The window runs over the class counts, not over the rows.
    """
    of_split = F.sum("n").over(Window.partitionBy("split"))
    return _class_counts(df, name).select("split", name, "n", (F.col("n") / of_split).alias("share"))


def length_summary(df: DataFrame, length: str, by: By = ()) -> DataFrame:
    """Mean, median, min and max of a length column; missing lengths are left out."""
    counts = value_counts(df, length, by)
    median = exact_quantiles(counts, length, {"median": 0.5}, by)
    rest = counts.groupBy(*by).agg(
        (F.sum(F.col(length) * F.col("_n")) / F.sum("_n")).alias("mean"),
        F.min(length).alias("min"),
        F.max(length).alias("max"),
        F.sum("_n").alias("n"),
    )
    return merge_rows([rest, median], by)


def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """Equal-width bins over [min, max], the last one closed; empty bins give 0.

    A column with one value gets a range of width 1 around it.
    """
    if dict(df.dtypes)[col] in ("double", "float"):
        counts = df.where(F.col(col).isNotNull() & ~F.isnan(col)).select(col, F.lit(1).alias("_n"))
    else:
        counts = value_counts(df, col)
    low, high = F.min(col).cast("double"), F.max(col).cast("double")
    edges = counts.agg(
        F.struct(
            F.when(low == high, low - 0.5).otherwise(low).alias("low"),
            F.when(low == high, high + 0.5).otherwise(high).alias("high"),
        )
    ).scalar()
    edged = counts.withColumn("_e", edges)
    scaled = (F.col(col) - F.col("_e.low")) / (F.col("_e.high") - F.col("_e.low")) * bins
    placed = edged.select(F.least(F.floor(scaled), F.lit(bins - 1)).alias("bin"), "_n")
    empty = df.sparkSession.range(bins).select(F.col("id").alias("bin"), F.lit(0).cast("bigint").alias("_n"))
    filled = placed.unionByName(empty).groupBy("bin").agg(F.sum("_n").alias("n")).withColumn("_e", edges)
    width = (F.col("_e.high") - F.col("_e.low")) / bins
    return filled.select(
        F.col("bin").cast("int").alias("bin"),
        (F.col("_e.low") + F.col("bin") * width).alias("bin_start"),
        (F.col("_e.low") + (F.col("bin") + 1) * width).alias("bin_end"),
        "n",
    )


def box_stats(df: DataFrame, value: str, by: By) -> DataFrame:
    """Numbers of a box plot per group: quartiles, whiskers, outliers.

    Whiskers end at the last values within 1.5 interquartile ranges of the box.
    """
    by = list(by)
    counts = value_counts(df, value, by)
    quartiles = exact_quantiles(counts, value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, by)
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = F.col(value).between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        join_group_facts(counts, quartiles, by)
        .groupBy(*by)
        .agg(
            F.max("q1").alias("q1"),
            F.max("median").alias("median"),
            F.max("q3").alias("q3"),
            F.min(F.when(inside, F.col(value))).alias("whisker_low"),
            F.max(F.when(inside, F.col(value))).alias("whisker_high"),
            F.sum(F.when(inside, 0).otherwise(F.col("_n"))).alias("outliers"),
            F.sum("_n").alias("n"),
        )
    )


def sample_per_class(df: DataFrame, key: str, name: str = "label_name", n: int = 2, seed: int = SEED) -> DataFrame:
    """Seeded sample of ``n`` rows per class.

    Keys are ranked apart from their rows, with the rank limit applied in every task before the
    shuffle; whole rows are read again only where their key is among the few chosen. A key that
    stands in several rows is chosen as often as it stands among the first ``n``.
    """
    order = Window.partitionBy(name).orderBy("_digest", key)
    keys = df.where(F.col(name).isNotNull()).select(key, name, seeded_key(F.col(key), seed).alias("_digest"))
    ranked = keys.withColumn("sample_no", F.row_number().over(order)).where(F.col("sample_no") <= n)
    chosen = ranked.groupBy(key, name).agg(F.array_sort(F.collect_list("sample_no")).alias("_numbers"))
    renamed = chosen.select(F.col(key).alias("_key"), F.col(name).alias("_name"), "_numbers")
    found = df.join(F.broadcast(renamed), F.col(key).eqNullSafe(F.col("_key")) & (F.col(name) == F.col("_name")))
    # of rows with an equal key as many are taken as the key was chosen, in the order of their content
    alike = Window.partitionBy(key, name).orderBy(F.xxhash64(*df.columns))
    numbered = found.withColumn("_at", F.row_number().over(alike)).where(F.col("_at") <= n)
    numbered = numbered.where(F.col("_at") <= F.size("_numbers"))
    return numbered.select(*df.columns, F.get("_numbers", F.col("_at") - 1).alias("sample_no"))


def keyword_stats(df: DataFrame, keywords: str = "keywords_list", document: str = "document") -> DataFrame:
    """Keywords per document (mean, min, max) and mean document length, in one pass."""
    sized = df.select(F.size(keywords).alias("k"), word_count(F.col(document)).alias("w"))
    return sized.agg(
        F.count(F.lit(1)).alias("n_documents"),
        F.avg("k").alias("avg_keywords"),
        F.min("k").alias("min_keywords"),
        F.max("k").alias("max_keywords"),
        F.avg("w").alias("avg_doc_length"),
    )


def length_vs_keywords(df: DataFrame, keywords: str = "keywords_list", document: str = "document") -> DataFrame:
    """Points of the length against keyword count plot, equal points counted together."""
    points = df.select(word_count(F.col(document)).alias("doc_length"), F.size(keywords).alias("num_keywords"))
    return points.groupBy("doc_length", "num_keywords").agg(F.count(F.lit(1)).alias("n"))


def sample_documents(
    df: DataFrame,
    key: str,
    keywords: str = "keywords_list",
    document: str = "document",
    n: int = 3,
    seed: int = SEED,
) -> DataFrame:
    """Seeded sample of documents with a preview, their keywords and how many."""
    sample = df.orderBy(seeded_key(F.col(key), seed), key).limit(n)
    return sample.select(
        key,
        preview(F.col(document), always=True).alias("preview"),
        join_keywords(F.col(keywords)).alias("keywords_str"),
        F.size(keywords).alias("num_keywords"),
    )


def missing_by_column(df: DataFrame) -> DataFrame:
    """Missing values (null, and NaN in floating columns) per column, in one pass."""
    counted = []
    for name, kind in df.dtypes:
        missing = F.col(name).isNull()
        if kind in ("double", "float"):
            missing = missing | F.isnan(name)
        counted.append(F.struct(F.lit(name).alias("column_name"), F.count_if(missing).alias("n_missing")))
    return df.agg(F.array(*counted).alias("c")).select(F.inline("c"))


def duplicate_count(df: DataFrame, col: str) -> DataFrame:
    """Rows that repeat an earlier value; all nulls count as one value.

    Digests travel instead of texts, and copies collapse before the shuffle.
    """
    copies = df.groupBy(F.sha2(F.col(col), 256).alias("digest")).agg(F.count(F.lit(1)).alias("n"))
    return copies.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_duplicates"),
    )


def distinct_classes(df: DataFrame, name: str = "label_name") -> DataFrame:
    """Class names in sorted order."""
    return df.where(F.col(name).isNotNull()).select(name).distinct().orderBy(name)


def _split_totals() -> list:
    per_split = [
        F.coalesce(F.sum(F.when(F.col("split") == s, F.col("n"))), F.lit(0)).alias(f"{s}_samples") for s in SPLITS
    ]
    return [F.sum("n").alias("total_samples"), *per_split]


def eda_summary(sentiment: DataFrame, keywords: DataFrame) -> DataFrame:
    """One nested record over both corpora; averages and classes are of ``train``.

    Each corpus is read once and reduced to a few counts before anything is nested.
    """
    train = F.col("split") == "train"
    counts = (
        sentiment.select("split", "label_name", word_count(F.col("text")).alias("w"))
        .groupBy("split", "label_name")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("w").alias("words"), F.count("w").alias("texts"))
    )
    named = train & F.col("label_name").isNotNull()
    by_class = F.array_sort(F.collect_list(F.when(named, F.struct("label_name", "n"))))
    sentiment_row = counts.agg(
        *_split_totals(),
        F.transform(by_class, lambda c: c["label_name"]).alias("classes"),
        (F.sum(F.when(train, F.col("words"))) / F.sum(F.when(train, F.col("texts")))).alias("avg_text_length"),
        F.map_from_entries(by_class).alias("class_distribution"),
    )
    documents = (
        keywords.select("split", F.size("keywords_list").alias("k"), word_count(F.col("document")).alias("w"))
        .groupBy("split")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("k").alias("keywords"),
            F.count("k").alias("lists"),
            F.sum("w").alias("words"),
            F.count("w").alias("texts"),
        )
    )
    keyword_row = documents.agg(
        *_split_totals(),
        (F.sum(F.when(train, F.col("keywords"))) / F.sum(F.when(train, F.col("lists")))).alias("avg_keywords"),
        (F.sum(F.when(train, F.col("words"))) / F.sum(F.when(train, F.col("texts")))).alias("avg_doc_length"),
    )
    return sentiment_row.select(
        F.struct("*").alias("sentiment"),
        keyword_row.select(F.struct("*")).scalar().alias("keyword"),
    )


def write_eda_summary(sentiment: DataFrame, keywords: DataFrame, path: str) -> None:
    """Store the summary record as JSON."""
    eda_summary(sentiment, keywords).write.mode("overwrite").json(path)
