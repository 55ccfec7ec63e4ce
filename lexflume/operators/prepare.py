"""Corpus preparation: labels, keyphrases, splits."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexflume.constants import KEYPHRASE_COLUMNS, RAW_LABEL_MAPPING, SEED, SPLIT_WEIGHTS
from lexflume.functions.hashing import percent_bucket
from lexflume.functions.scores import class_name
from lexflume.functions.text import join_keywords


def map_labels(
    df: DataFrame,
    mapping: dict[int, int] = RAW_LABEL_MAPPING,
    raw: str = "raw_label",
    strict: bool = False,
) -> DataFrame:
    """Raw labels onto target classes; unknown ones give null, or fail if ``strict``.

    The mapping is a handful of literals, so it becomes an expression of the scan
    stage instead of a join.
    """
    pairs = [F.lit(v) for item in mapping.items() for v in item]
    label = F.try_element_at(F.create_map(*pairs), F.col(raw).cast("int"))
    if strict:
        unknown = F.concat(F.lit("label without a mapping: "), F.col(raw).cast("string"))
        label = F.coalesce(label, F.raise_error(unknown).cast("int"))
    return df.withColumn("label", label).withColumn("is_mapped", F.col("label").isNotNull())


def label_names(df: DataFrame, label: str = "label", name: str = "label_name") -> DataFrame:
    """Add the class name."""
    return df.withColumn(name, class_name(F.col(label)))


def pick_keyphrases(df: DataFrame, candidates: Sequence[str] = KEYPHRASE_COLUMNS) -> DataFrame:
    """Keyphrases from the first candidate column the frame has.

    An empty value stays empty: a later candidate is no substitute.
    """
    none = F.array().cast("array<string>")
    present = [c for c in candidates if c in df.columns]
    picked = F.coalesce(F.col(present[0]), none) if present else none
    return join_keyphrases(df.withColumn("keywords_list", picked))


def join_keyphrases(df: DataFrame, col: str = "keywords_list", out: str = "keywords_str") -> DataFrame:
    """Add the keyphrases as one ``"; "`` separated string."""
    return df.withColumn(out, join_keywords(F.col(col)))


def select_present(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The wanted columns the frame has, in the wanted order."""
    return df.select(*[c for c in cols if c in df.columns])


def assign_split(
    df: DataFrame, key: str, weights: dict[str, int] = SPLIT_WEIGHTS, seed: int = SEED
) -> DataFrame:
    """Add a train / val / test ``split``, decided by each row's own key.

    Weights are percent shares. Unlike ``randomSplit`` the outcome does not depend
    on partitioning, so a lost executor or a new cluster size changes nothing.
    """
    if sum(weights.values()) != 100:
        raise ValueError("split weights must add up to 100")
    bucket = percent_bucket(F.col(key), seed)
    split: Column = F.lit(None).cast("string")
    cut = 100
    for name, share in reversed(weights.items()):
        split = F.when(bucket < cut, F.lit(name)).otherwise(split)
        cut -= share
    return df.withColumn("split", split)


def union_splits(frames: dict[str, DataFrame]) -> DataFrame:
    """Tag every frame with its split name and stack them."""
    tagged = [df.withColumn("split", F.lit(name)) for name, df in frames.items()]
    return reduce(DataFrame.unionByName, tagged)
