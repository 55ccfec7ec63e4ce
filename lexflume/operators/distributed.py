"""Building blocks that stay spread out however large or lopsided the data is.

* ``global_position``, ``sorted_position`` - rank of every row without one all-rows window,
* ``exact_quantiles`` - interpolated percentiles without one all-values group,
* ``join_group_facts`` - join of rows to their group when one group is hot,
* ``merge_rows`` - put one-row-per-group frames side by side without a join.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

By = Sequence[str]

# A rank window sees one bucket. 16**4 buckets keep 10**11 rows at ~1.5 million each,
# and the table of bucket totals at 65,536 rows at most.
HEX_DIGITS = 4
# Splitters that cut the distinct values of one group into rank buckets, read from a sketch of the group.
QUANTILE_BUCKETS = 1024
SKETCH_SIZE = 4096
# A group with at least 1/GROUP_SHARES of all rows is hot: there are GROUP_SHARES of them at most, so what
# is known of them may be broadcast, and every other group is small enough for one task.
GROUP_SHARES = 1000
# Sorted keys are cut twice by so many splitters, read from about so many keys.
KEY_BUCKETS = 128
KEY_SAMPLE = KEY_BUCKETS * KEY_BUCKETS * 8


def _leading(items: Column, size: int, holds: Callable[[Column], Column]) -> Column:
    """How many leading items of a sorted array (of at most ``size``) meet a condition.

    Binary search: log2(size) comparisons per row.
    """
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(size.bit_length()))])
    return F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: F.when(holds(F.get(items, at + step - 1)), at + step).otherwise(at),
    )


def _ranked_within(df: DataFrame, bucket: str, order: list[Column], position: str) -> DataFrame:
    """Rank rows inside each bucket and shift by the rows of all buckets before it."""
    totals = df.groupBy(bucket).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(bucket, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    rank = F.row_number().over(Window.partitionBy(bucket).orderBy(*order))
    return (
        df.withColumn("_rank", rank)
        .join(F.broadcast(offsets), bucket)
        .withColumn(position, F.col("_before") + F.col("_rank"))
        .drop("_before", "_rank", bucket)
    )


def global_position(
    df: DataFrame, hex_key: Column, tie: str, position: str = "position", digits: int = HEX_DIGITS
) -> DataFrame:
    """Position 1..N of every row in the order of an evenly spread hex key.

    The first hex digits are the bucket: equal-sized whatever the data holds, and
    in key order. Only bucket totals (at most ``16**digits`` rows) meet in one task.
    A null key comes first.
    """
    keyed = df.withColumn("_key", F.coalesce(hex_key, F.lit(""))).withColumn("_bucket", F.substring("_key", 1, digits))
    return _ranked_within(keyed, "_bucket", [F.col("_key"), F.col(tie)], position).drop("_key")


def _splitters(sorted_keys: Column) -> Column:
    """At most KEY_BUCKETS - 1 keys that cut a sorted array evenly."""
    step = F.greatest(F.lit(1), F.ceil(F.size(sorted_keys) / KEY_BUCKETS))
    return F.filter(sorted_keys, lambda x, i: (i % step == 0) & (i > 0))


def sorted_position(
    df: DataFrame, key: str, order: Column, position: str = "position", sample: int = KEY_SAMPLE
) -> DataFrame:
    """Position 1..N of every row in the order of any expression, which is unique or followed by ``key``.

    Splitters are read from about ``sample`` distinct keys, chosen by hash at a rate that follows the
    number of rows, and cut the rows twice: into KEY_BUCKETS ranges, and each of those into as many
    again. A task ranks about 1/16,000 of all rows, whatever they hold; equal weights or shared
    prefixes do not gather in one bucket. What is broadcast are the splitters alone.
    """
    keyed = df.withColumn("_order", order)
    size = df.agg(F.count(F.lit(1))).scalar()
    chosen = F.pmod(F.xxhash64("_order"), F.greatest(F.lit(1), size)) < sample
    seen = keyed.where(chosen).select("_order").distinct()
    first = seen.agg(F.array_sort(F.collect_list("_order")).alias("s")).select(_splitters(F.col("s"))).scalar()

    def cut(rows: DataFrame) -> DataFrame:
        below = _leading(F.col("_splitters"), KEY_BUCKETS, lambda s: s <= F.col("_order"))
        return rows.withColumn("_splitters", first).withColumn("_range", below).drop("_splitters")

    second = cut(seen).groupBy("_range").agg(F.array_sort(F.collect_list("_order")).alias("s"))
    second = second.select("_range", _splitters(F.col("s")).alias("_splitters"))
    within = F.coalesce(
        _leading(F.col("_splitters"), KEY_BUCKETS, lambda s: s <= F.col("_order")), F.lit(0)
    )
    bucketed = cut(keyed).join(F.broadcast(second), "_range", "left")
    bucketed = bucketed.withColumn("_bucket", F.col("_range") * (KEY_BUCKETS + 1) + within).drop("_splitters", "_range")
    return _ranked_within(bucketed, "_bucket", [F.col("_order"), F.col(key)], position).drop("_order")


def join_by(left: DataFrame, right: DataFrame, by: By) -> DataFrame:
    """Inner join on the group columns; a null group matches itself."""
    renamed = right.select(
        *[F.col(c).alias(f"_by_{c}") for c in by], *[c for c in right.columns if c not in by]
    )
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by])
    return left.join(renamed, same).drop(*[f"_by_{c}" for c in by])


def _without(rows: DataFrame, groups: DataFrame, by: By) -> DataFrame:
    """Rows of all groups but these; a null group is a group like others."""
    renamed = groups.select(*[F.col(c).alias(f"_by_{c}") for c in by])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by])
    return rows.join(F.broadcast(renamed), same, "left_anti")


def hot_groups(rows: DataFrame, by: By, shares: int = GROUP_SHARES) -> DataFrame:
    """Groups that hold at least 1/``shares`` of all rows: no more than ``shares`` of them."""
    size = rows.agg(F.count(F.lit(1))).scalar()
    sizes = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"))
    return sizes.where(F.col("_rows") * shares >= size).select(*by)


def join_group_facts(rows: DataFrame, facts: DataFrame, by: By, shares: int = GROUP_SHARES) -> DataFrame:
    """Join rows to the one fact row of their group, a group's rows being any share of all.

    Facts of hot groups go to the rows, wherever they are; rows of other groups go to their facts.
    """
    hot = hot_groups(rows, by, shares)
    met = join_by(rows, F.broadcast(join_by(facts, F.broadcast(hot), by)), by)
    return met.unionByName(join_by(_without(rows, hot, by), facts, by))


def value_counts(df: DataFrame, value: str, by: By = ()) -> DataFrame:
    """Rows per distinct value and group, as ``_n``; missing values (null, NaN) are left out.

    They are left out by their count of 0: a filter on the value would be pushed
    to the scan and compute a derived value (a word count, say) a second time.
    """
    present = F.col(value)
    if dict(df.dtypes)[value] in ("double", "float"):
        present = F.nullif(present, F.lit(float("nan")))
    return df.groupBy(*by, value).agg(F.count(present).alias("_n")).where(F.col("_n") > 0)


def exploded(df: DataFrame, items: Column, name: str, *keep: str) -> DataFrame:
    """One row per array item; empty and null arrays give none.

    Same rows as ``explode``, which however computes its array twice: once more in
    a filter that leaves out empty arrays ahead of time.
    """
    return df.select(*keep, F.explode_outer(items).alias(name)).where(F.col(name).isNotNull())


def exact_quantiles(
    counts: DataFrame,
    value: str,
    quantiles: dict[str, float],
    by: By = (),
    buckets: int = QUANTILE_BUCKETS,
    shares: int = GROUP_SHARES,
) -> DataFrame:
    """Linearly interpolated quantiles per group, from the output of ``value_counts``.

    A mergeable sketch of a hot group's distinct values chooses where they are cut into brackets;
    exact counts per bracket tell which bracket holds a wanted rank, and only the values of those
    brackets are sorted. Cuts and brackets are broadcast (``shares`` groups at most), so the distinct
    values of a hot group stay where counting has put them. A bad cut costs time, never the result:
    the brackets of a group cover all numbers. Other groups are small enough to be sorted whole.
    """
    by = list(by)
    counts = counts.select(*by, F.col(value).cast("double").alias("_value"), "_n")
    if not by:
        return _of_ranks(_bracketed(counts, quantiles, by, buckets), quantiles, by)
    hot = hot_groups(counts, by, shares)
    spread = _bracketed(join_by(counts, F.broadcast(hot), by), quantiles, by, buckets)
    running = Window.partitionBy(*by).orderBy("_value")
    sums = F.sum("_n").over(running)
    whole = F.sum("_n").over(Window.partitionBy(*by))
    small = _without(counts, hot, by).select(
        *by, "_value", (sums - F.col("_n")).alias("_first"), sums.alias("_last"), whole.alias("_total")
    )
    return _of_ranks(spread, quantiles, by).unionByName(_of_ranks(small, quantiles, by))


def _ranks(quantiles: dict[str, float]) -> dict[str, tuple[Column, Column, Column]]:
    """By name: the wanted place among the sorted rows, and the ranks below and above it."""
    places = {name: F.lit(float(q)) * (F.col("_total") - 1) for name, q in quantiles.items()}
    return {name: (place, F.floor(place), F.ceil(place)) for name, place in places.items()}


def _bracketed(counts: DataFrame, quantiles: dict[str, float], by: list[str], buckets: int) -> DataFrame:
    """by, _value, _first, _last, _total: places of the values in the brackets that hold a wanted rank."""
    at = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    sketch = F.kll_sketch_agg_double("_value", SKETCH_SIZE).alias("_sketch")
    cuts = counts.groupBy(*by).agg(sketch).where(F.kll_sketch_get_n_double("_sketch") > 0)
    cuts = cuts.select(*by, F.kll_sketch_get_quantile_double("_sketch", at).alias("_cuts"))
    bracket = _leading(F.col("_cuts"), buckets, lambda c: c < F.col("_value"))
    if by:
        cut_up = join_by(counts, F.broadcast(cuts), by)
    else:
        cut_up = counts.withColumn("_cuts", cuts.select("_cuts").scalar())
    cut_up = cut_up.select(*by, "_value", "_n", F.coalesce(bracket, F.lit(0)).alias("_bucket"))

    # at most as many rows as there are brackets in all hot groups
    totals = cut_up.groupBy(*by, "_bucket").agg(F.sum("_n").alias("_rows"))
    end = F.sum("_rows").over(Window.partitionBy(*by).orderBy("_bucket"))
    whole = F.sum("_rows").over(Window.partitionBy(*by))
    totals = totals.select(*by, "_bucket", (end - F.col("_rows")).alias("_start"), end.alias("_end"), whole.alias("_total"))
    holds = [
        (F.col("_start") <= r) & (r < F.col("_end")) for _, low, high in _ranks(quantiles).values() for r in (low, high)
    ]
    wanted = totals.where(reduce(lambda a, b: a | b, holds)).drop("_end")
    inside = join_by(cut_up, F.broadcast(wanted), [*by, "_bucket"])
    last = F.col("_start") + F.sum("_n").over(Window.partitionBy(*by, "_bucket").orderBy("_value"))
    return inside.select(*by, "_value", (last - F.col("_n")).alias("_first"), last.alias("_last"), "_total")


def _of_ranks(placed: DataFrame, quantiles: dict[str, float], by: list[str]) -> DataFrame:
    """Interpolated quantiles from the places of the values around their ranks."""
    ranks = _ranks(quantiles)

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("_first") <= rank) & (rank < F.col("_last")), F.col("_value")))

    found = placed.groupBy(*by).agg(
        *[at(low).alias(f"_{name}_lo") for name, (_, low, _hi) in ranks.items()],
        *[at(high).alias(f"_{name}_hi") for name, (_, _lo, high) in ranks.items()],
        F.max("_total").alias("_total"),
    )
    return found.select(
        *by,
        *[
            (F.col(f"_{name}_lo") + (F.col(f"_{name}_hi") - F.col(f"_{name}_lo")) * (place - F.floor(place))).alias(name)
            for name, (place, _, _) in ranks.items()
        ],
    )


def merge_rows(frames: list[DataFrame], by: By = ()) -> DataFrame:
    """One row per group with the columns of all frames, each having one row per group."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    columns = [c for c in stacked.columns if c not in by]
    return stacked.groupBy(*by).agg(*[F.max(c).alias(c) for c in columns])
