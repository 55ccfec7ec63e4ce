"""Joins and components that stay spread out when one key holds a large share of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexflume.session import stored

# A key with more than 1/SHARES of all rows is dealt over several parts. There are fewer than
# SHARES such keys, so the table of their part counts may be broadcast at any size of input.
SHARES = 10_000
# Fewer rows than this are not split: a part repeats its table row, however large that is.
PART_ROWS = 200
# A set of keys is broadcast only when counted to be at most this large (8 to 16 bytes a key).
BROADCAST_KEYS = 500_000


def columns_of(df: DataFrame) -> list[Column]:
    """All columns, also those whose names hold dots or backticks."""
    return [F.col(f"`{c.replace('`', '``')}`") for c in df.columns]


def attach(facts: DataFrame, table: DataFrame, key: str, weight: str, by: str, how: str = "left") -> DataFrame:
    """Join facts to a stored table with one row per key and ``weight`` = its rows among the facts.

    Both sides travel by (key, part). A frequent key has many parts, chosen by a hash of ``by``,
    and its table row is repeated once per part; no part holds more than 1/SHARES of the facts, or
    PART_ROWS of them where that is more.
    """
    total = table.agg(F.sum(weight)).scalar()
    sized = table.withColumn("_parts", F.ceil(F.col(weight) / F.greatest(F.lit(float(PART_ROWS)), total / SHARES)).cast("bigint")).drop(weight)
    frequent = sized.where("_parts > 1").select(key, F.col("_parts").alias("_of"))
    salted = facts.join(F.broadcast(frequent), key, "left").select(
        *facts.columns,
        F.when(F.col("_of").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(by), F.col("_of"))).alias("_part"),
    )
    parts = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.lit(1), F.col("_parts")) - 1)
    repeated = sized.withColumn("_part", F.explode(parts)).drop("_parts")
    return salted.join(repeated, [key, "_part"], how).drop("_part")


def forget(*tables: DataFrame) -> None:
    """Delete the files of stored tables; everything that was read from them must have been stored itself."""
    for table in tables:
        files = table.inputFiles()
        if files:
            spark = table.sparkSession
            folder = spark._jvm.org.apache.hadoop.fs.Path(files[0].rsplit("/", 1)[0])
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def sized(keys: DataFrame) -> DataFrame:
    """Stored keys, marked for broadcast when they are counted to be few."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def keep_where(df: DataFrame, keys: DataFrame, key: str, how: str) -> DataFrame:
    """Rows whose key is (``left_semi``) or is not (``left_anti``) among stored distinct keys; null equals null."""
    other = sized(keys.select(F.col(key).alias("_key")))
    return df.join(other, df[key].eqNullSafe(other["_key"]), how)


def _is_star_forest(edges: DataFrame) -> bool:
    """Whether every node points to one node at most, and no node that is pointed to points on."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into"))
    )
    counted = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return counted.where("out > 1 OR out + into > 1").isEmpty()


def _minima(pairs: DataFrame, name: str) -> DataFrame:
    return stored(
        pairs.groupBy("u").agg(F.least("u", F.min("v")).alias("low"), F.count(F.lit(1)).alias("_n")), name
    )


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): smallest node of each node's component, for nodes that occur in an edge.

    Large-star and small-star rounds over stored edge tables: each round is two aggregations and
    two joins, hubs are dealt over parts, and a lost executor costs one round's files at most.
    Self-loops and repeated edges are harmless; edges with a null end are ignored.
    """
    edges = stored(
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "edges",
    )
    while not _is_star_forest(edges):
        before = edges
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lows = _minima(both, "large")
        large = (
            attach(both, lows, "u", "_n", "v", "inner")
            .where("v > u")
            .select(F.col("v").alias("u"), F.col("low").alias("v"))
            .distinct()
        )
        large = stored(large, "edges")
        small_lows = _minima(large, "small")
        low = attach(large, small_lows, "u", "_n", "v", "inner")
        small = low.where("v != low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        edges = stored(small.unionByName(low.select("u", F.col("low").alias("v"))).distinct(), "edges")
        forget(before, lows, large, small_lows)
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    hubs = edges.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    found = stored(roots.unionByName(hubs), "roots")
    forget(edges)
    return found
