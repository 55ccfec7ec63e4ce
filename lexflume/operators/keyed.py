"""Tables with one row per key (vocabulary, IDF), looked up by the items of rows.

A table counted to be small is a dictionary in every task: a row's items are looked up where the row
is, nothing is joined or grouped, and rows with equal or null keys stay rows of their own. Items of a
large table meet it by key; keys that hold many of the facts - also keys the table lacks - are found
by mergeable heavy-hitter sketches of the facts themselves and dealt over several parts.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexflume.functions.items import common_values, filled_values, item_values
from lexflume.session import stored

# A table of at most this many rows, with keys of at most so many characters, goes to every task
# (below ~50 MB); of a larger one at most so many of its most frequent rows do.
WHOLE_ROWS = 500_000
KEY_CHARS = 64
# Frequencies are told apart by eighths of a power of two, when the frequent rows of a table are chosen.
LEVELS = 8
# No part of a frequent key holds more than 1/SHARES of the facts, or PART_ROWS of them where that is more.
SHARES = 10_000
PART_ROWS = 10_000
# Sketches per task, and the items each keeps track of: an item's count is off by less than
# 1/(SLICES * TRACKED / 4) of all facts.
SLICES = 64
TRACKED = 4096


def hot_keys(facts: DataFrame, key: str, shares: int = SHARES, part_rows: int = PART_ROWS) -> DataFrame:
    """(_hash, _parts) of the keys that hold more than one part's share of the facts: at most ``shares`` rows.

    Sketches hold hashes, by slices of the hash, so a task sends SLICES small ones and no task merges
    those of all slices but after they are cut to their frequent items.
    """
    hashed = facts.select(F.xxhash64(key).alias("_hash"))
    sketches = hashed.groupBy(F.pmod("_hash", F.lit(SLICES)).alias("_slice")).agg(
        F.expr(f"approx_top_k(_hash, {TRACKED // 4}, {TRACKED})").alias("_top"), F.count(F.lit(1)).alias("_n")
    )
    whole = sketches.agg(F.flatten(F.collect_list("_top")).alias("_top"), F.sum("_n").alias("_n"))
    size = F.greatest(F.lit(part_rows), F.col("_n") / shares)
    return (
        whole.select(size.alias("_size"), F.explode("_top").alias("_t"))
        .select(F.col("_t.item").alias("_hash"), F.ceil(F.col("_t.count") / F.col("_size")).alias("_parts"))
        .where("_parts > 1")
    )


def dealt(facts: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Facts with ``_part``: 0, or for a hot key a part by the hash of the whole row."""
    hashed = facts.withColumn("_hash", F.xxhash64(key)).join(F.broadcast(hot), "_hash", "left")
    part = F.when(F.col("_parts").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(*facts.columns), F.col("_parts")))
    return hashed.select(*facts.columns, part.cast("bigint").alias("_part"))


def skewed_join(
    facts: DataFrame, table: DataFrame, key: str, how: str = "left", shares: int = SHARES, part_rows: int = PART_ROWS
) -> DataFrame:
    """Join facts to a table with one row per key; no task gets more than a share of a hot key's facts."""
    hot = hot_keys(facts, key, shares, part_rows)
    parts = F.sequence(F.lit(0).cast("bigint"), F.coalesce("_parts", F.lit(1)) - 1)
    repeated = table.withColumn("_hash", F.xxhash64(key)).join(F.broadcast(hot), "_hash", "left")
    # a merge: a broadcast of the table would pass the driver each time, in a stream once per micro-batch
    repeated = repeated.select(*table.columns, F.explode(parts).alias("_part")).hint("merge")
    return dealt(facts, key, hot).join(repeated, [key, "_part"], how).drop("_part")


class KeyedTable:
    """A stored table with one row per key; its size is counted once, when it is made.

    ``often`` names the column that says how often a key is met; without it no row of a large table
    counts as frequent.
    """

    def __init__(
        self,
        rows: DataFrame,
        key: str,
        whole_rows: int = WHOLE_ROWS,
        shares: int = SHARES,
        part_rows: int = PART_ROWS,
        often: str | None = None,
    ) -> None:
        self.rows, self.key, self.shares, self.part_rows = rows, key, shares, part_rows
        size, chars = rows.agg(F.count(F.lit(1)), F.max(F.length(F.col(key).cast("string")))).first()
        self.small = size <= whole_rows and (chars or 0) <= KEY_CHARS
        self.held = rows if self.small else self._common(whole_rows, often)
        self._broadcast: dict[str, object] = {}

    def _common(self, whole_rows: int, often: str | None) -> DataFrame:
        """The most frequent rows with short keys, at most ``whole_rows``: all above one level of frequency."""
        if often is None:
            return self.rows.limit(0)
        short = self.rows.where(F.length(F.col(self.key).cast("string")) <= KEY_CHARS)
        level = F.floor(F.log2(F.col(often)) * LEVELS)
        lowest, total = None, 0
        for row in sorted(short.groupBy(level.alias("level")).count().where("level IS NOT NULL").collect(), reverse=True):
            total += row["count"]
            if total > whole_rows:
                break
            lowest = row["level"]
        return self.rows.limit(0) if lowest is None else short.where(level >= lowest)

    def _dictionary(self, value: str):
        """Broadcast of key -> value, made once per value column."""
        if value not in self._broadcast:
            held = self.held.select(self.key, value).toArrow()
            known = dict(zip(held.column(0).to_pylist(), held.column(1).to_pylist(), strict=True))
            self._broadcast[value] = self.rows.sparkSession.sparkContext.broadcast(known)
        return self._broadcast[value]

    def held_columns(self, value: str) -> tuple[pa.Array, np.ndarray]:
        """Keys, as strings, and values of the rows that every task holds."""
        held = self.held.select(self.key, value).toArrow()
        keys = [c.cast(pa.string()) for c in held.column(0).chunks]
        return pa.concat_arrays([pa.array([], pa.string()), *keys]), held.column(1).to_numpy()

    def join(self, facts: DataFrame, how: str = "left") -> DataFrame:
        """Facts with the columns of their key's row."""
        if self.small:
            return facts.join(F.broadcast(self.rows), self.key, how)
        return skewed_join(facts, self.rows, self.key, how, self.shares, self.part_rows)

    def look_up(
        self, df: DataFrame, items: Column, value: str, default: object, out: str, keep: Sequence[str] | None = None
    ) -> DataFrame:
        """``df`` (its columns ``keep``, or all) with ``out``, the values of an array's items in their order.

        ``default`` is the value of items without a row; a null array gives an empty one. For a large
        table the kept columns are stored with what the frequent rows tell; the rare items are joined
        and their values brought back to their row, so keep only what is needed later.
        """
        kept = list(df.columns if keep is None else keep)
        kind = dict(self.rows.dtypes)[value]
        if self.small:
            return df.withColumn(out, item_values(self._dictionary(value), default, kind)(items)).select(*kept, out)
        item_kind = dict(self.rows.dtypes)[self.key]
        known = common_values(self._dictionary(value), default, kind, item_kind)(items)
        rows = df.select(*kept, known.alias("_known"), F.monotonically_increasing_id().alias("_row"))
        # written once: the rows are read several times below, and keep their numbers
        rows = stored(rows, "looked-up")
        facts = rows.select("_row", F.posexplode("_known.rare").alias("_pos", self.key))
        table = self.rows.select(self.key, F.col(value).alias("_value"))
        met = skewed_join(facts, table, self.key, "left", self.shares, self.part_rows)
        item = F.struct("_pos", F.coalesce(F.col("_value"), F.lit(default).cast(kind)).alias("_value"))
        fills = met.groupBy("_row").agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["_value"]).alias("_fills"))
        back = rows.join(fills, "_row", "left")
        whole = filled_values(kind)(F.col("_known.values"), F.coalesce("_fills", F.array().cast(f"array<{kind}>")))
        return back.withColumn(out, whole).select(*kept, out)
