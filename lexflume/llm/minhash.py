"""Near-duplicates of texts by bottom-k sketches of one hash function.

A document's shingle hashes, sorted, are its set; the k smallest are its sketch. Inverted lists of
retained values give overlapping sketches. A list is named by two retained values that are next to
each other in a sketch: one value alone is held by a fixed share of unrelated documents, so its list
would grow with the corpus. Nodes of small sets enter only the lists of their rarest neighbours, others
all but the few most frequent ones, which hold what unrelated texts share (a notice, a common line).
Lists are linked star-wise to a pivot, another one in every round, as long as that links much of what
it compares; what stars leave open is compared member by member. Sizes and 256 bits drawn from the same
hashes rule most pairs out before they are written, and so does an odd sketch, which never rules out a
pair at the threshold. The union sketch of the others filters, and exact Jaccard on whole sets confirms.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import partial, reduce
from math import comb, log
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexflume.llm.relations import attach, connected, forget, keep_where, sized
from lexflume.llm.texts import lowered, pieces, release, words
from lexflume.session import stored

SKETCH = 48
# From this similarity on, two sketches share two neighbouring values but for a chance below 3e-10 (1e-14 at 0.8).
LEAST_PERCENT = 70
# Chance that a pair at exactly the threshold shares fewer retained values than asked for.
MISS = 1e-10
# One bit of the smallest hash of each of so many slices of a set; longs hold 64 each.
SLICES = 256
BITS = [f"bits{i}" for i in range(SLICES // 64)]
# Bits of a set's odd sketch: each is the parity of the hashes that fall on it (Mitzenmacher, Pagh and Pham, 2014).
ODD = 1024
# Star rounds go on while one links at least this share of the pairs it compares.
WORTHWHILE = 0.05
# Pairs of an open list that one task compares, about.
PART_PAIRS = 1 << 20
# Members of an open list up to which all of them meet, whatever their sizes.
BANDED = 32
WORD_SEED = 7
# Rows and bytes of texts whose sets a task holds at one time.
PIECE = (512, 2 << 20)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Bijective finisher of 64-bit hashes (published splitmix64 constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct 63-bit hashes of the text's shingles; shorter texts are one shingle, wordless ones none."""
    found = words(text)
    if not found:
        return np.empty(0, np.int64)
    hashed = np.fromiter((xxhash.xxh64_intdigest(w, WORD_SEED) for w in found), np.uint64, len(found))
    span = min(width, len(found))
    out = np.full(len(found) - span + 1, span, np.uint64)
    for i in range(span):
        out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + hashed[i : len(found) - span + 1 + i])
    return np.unique((out >> np.uint64(1)).astype(np.int64))


def slice_bits(members: np.ndarray) -> np.ndarray:
    """Longs of bits: for each slice of a set (its hashes by their low bits), one bit of the slice's smallest hash."""
    slices, smallest = np.unique(members & (SLICES - 1), return_index=True)
    bits = np.zeros(SLICES, np.uint8)
    bits[slices] = (members[smallest] >> 8) & 1
    return np.packbits(bits, bitorder="little").view(np.int64)


def odd_sketch(members: np.ndarray) -> np.ndarray:
    """Longs of parity bits; two sets' sketches differ in no more bits than the sets differ in members."""
    parity = np.bincount((members >> 16) & (ODD - 1), minlength=ODD).astype(np.uint8) & 1
    return np.packbits(parity, bitorder="little").view(np.int64)


def most_bits_apart(threshold: float) -> int:
    """Smallest x so that more than x slice bits of two sets at the threshold differ with chance <= MISS.

    A slice's smallest hash is in one set only with chance ``1 - threshold`` and then differs in its bit
    half of the time. Sets of few members differ in no more slices than members.
    """
    p, total, x = (1 - threshold) / 2, 0.0, SLICES
    while x > 0:
        total += comb(SLICES, x) * p**x * (1 - p) ** (SLICES - x)
        if total > MISS:
            break
        x -= 1
    return x


def least_overlap(threshold: float, k: int = SKETCH) -> int:
    """Largest c so that two full sketches of sets at the threshold share fewer than c values with chance <= MISS.

    The worst case is a subset: then each retained value of the larger set is shared with chance ``threshold``.
    """
    total, c = 0.0, 0
    while c < k:
        total += comb(k, c) * threshold**c * (1 - threshold) ** (k - c)
        if total > MISS:
            break
        c += 1
    return max(1, c)


def least_neighbours(threshold: float, k: int = SKETCH) -> int:
    """Largest m so that two full sketches of sets at the threshold share fewer than m neighbours with chance <= MISS.

    The worst case is a subset: then each retained value of the larger set is shared with chance
    ``threshold``, and two next to each other are shared neighbours.
    """
    # chances of 0, 1, .. shared neighbours among the first values, by whether the last one is shared
    no, yes = np.array([1 - threshold]), np.array([threshold])
    for _ in range(k - 1):
        no, yes, more = np.append(no, 0.0), np.append(yes, 0.0), np.append(0.0, yes)
        no, yes = (1 - threshold) * (no + yes), threshold * (no + more)
    return int(np.sum(np.cumsum(no + yes) <= MISS))


def _profile_batches(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    release()
    for batch in pieces(batches, *PIECE):
        sets = [shingle_set(t, width) for t in lowered(batch.column(1))]
        bits = np.array([slice_bits(s) for s in sets], np.int64).reshape(-1, len(BITS))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                pa.array([s[:SKETCH] for s in sets], pa.list_(pa.int64())),
                *[pa.array(bits[:, i].copy()) for i in range(len(BITS))],
                pa.array([odd_sketch(s) for s in sets], pa.list_(pa.int64())),
            ],
            names=["doc_id", "n", "set_key", "sketch", *BITS, "odd"],
        )


def _set_batches(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    release()
    for batch in pieces(batches, *PIECE):
        sets = [shingle_set(t, width) for t in lowered(batch.column(0))]
        yield pa.RecordBatch.from_arrays(
            [pa.array([xxhash.xxh128_digest(s.tobytes()) for s in sets], pa.binary()), pa.array(sets, pa.list_(pa.int64()))],
            names=["set_key", "members"],
        )


def profiles(docs: DataFrame, width: int) -> DataFrame:
    """Stored (doc_id, n, set_key, sketch, bits, odd) of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n bigint, set_key binary, sketch array<bigint>, " + ", ".join(f"{b} bigint" for b in BITS) + ", odd array<bigint>"
    return stored(docs.select("doc_id", "text").mapInArrow(partial(_profile_batches, width=width), schema), "profiles")


def set_nodes(rows: DataFrame) -> DataFrame:
    """Stored nodes, one per distinct non-empty set: node, set_key, doc_id (smallest), n, sketch, bits, odd, copies.

    A node is named by its smallest doc_id; where that is null or names several sets, by a negative
    digest of the set.
    """
    grouped = rows.where("n > 0").groupBy("set_key").agg(
        F.min("doc_id").alias("doc_id"),
        F.first("n").alias("n"),
        *[F.first(c).alias(c) for c in ("sketch", *BITS, "odd")],
        F.count(F.lit(1)).alias("copies"),
    )
    # names alone tell which of them clash, and those are few: sketches travel once
    names = rows.where("n > 0").groupBy("set_key").agg(F.min("doc_id").alias("clash"))
    clashing = names.groupBy("clash").agg(F.count(F.lit(1)).alias("c")).where("c > 1 OR clash IS NULL")
    clashing = stored(clashing.select("clash", F.lit(True).alias("clashes")), "clashing")
    digest = -F.shiftrightunsigned(F.xxhash64("set_key"), 1) - 1
    named = grouped.join(sized(clashing), F.col("doc_id").eqNullSafe(F.col("clash")), "left").withColumn(
        "node", F.when(F.col("clashes"), digest).otherwise(F.col("doc_id").cast("bigint"))
    )
    nodes = stored(named.drop("clash", "clashes"), "nodes")
    forget(clashing)
    return nodes


def rare_lists(nodes: DataFrame, threshold: float) -> DataFrame:
    """Stored (value, node, n, bits): nodes under their pairs of neighbouring retained values.

    Of m common and d other values in hash order, at least m - d - 1 neighbours are both common.
    Where every partner's sketch is its whole set, that makes ``2 * (1 - threshold) * n + 1`` of a
    node's rarest neighbours enough. Larger sets share m neighbours but for a chance of MISS; the
    rarest of those is not among the m - 1 most frequent ones of either node, which need no list. So
    a passage of unrelated texts, whose few neighbours nearly all of them hold, makes no list either.
    Neighbours that one node alone holds are the rarest of all and need no list.
    """
    # a sketch of one value has no neighbours, and at the threshold no partner but its equals
    heads = F.slice("sketch", 1, F.size("sketch") - 1)
    neighbours = F.transform(heads, lambda x, i: F.xxhash64(x, F.get("sketch", i + 1)))
    postings = nodes.select("node", F.explode(neighbours).alias("value"))
    lists = stored(
        postings.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where("df > 1").withColumn("_n", F.col("df")),
        "frequencies",
    )
    shared = attach(postings, lists, "value", "_n", "node", "inner")
    held = shared.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("df", "value"))).alias("held"))
    held = held.join(nodes.select("node", "n", *BITS), "node")
    every = F.least(F.col("n"), F.lit(SKETCH)) - 1
    enough = F.floor(F.col("n") * (2 * (1 - threshold)) + 1e-9) + 1
    spared = max(1, least_neighbours(threshold)) - 1
    wanted = F.when(F.col("n") <= int(SKETCH * threshold), F.least(every, enough)).otherwise(every - spared)
    rarest = F.slice("held", 1, F.greatest(F.lit(0), wanted - (every - F.size("held"))).cast("int"))
    values = F.explode(F.transform(rarest, lambda x: x["value"])).alias("value")
    found = stored(held.select("node", "n", *BITS, values), "lists")
    forget(lists)
    return found


def _alike(a: Callable[[str], Column], b: Callable[[str], Column], threshold: float) -> Column:
    """Whether sizes and slice bits of two list members allow a pair at the threshold."""
    sizes = F.least(a("n"), b("n")) >= F.greatest(a("n"), b("n")) * threshold - 1e-9
    apart = reduce(add, [F.bit_count(a(c).bitwiseXOR(b(c))) for c in BITS])
    return sizes & (apart <= most_bits_apart(threshold))


def _near_enough(odd_a: str, odd_b: str, n_a: str, n_b: str, threshold: float) -> Column:
    """Whether two odd sketches allow the threshold: false only for pairs below it.

    At a Jaccard of t two sets differ in (1 - t) / (1 + t) of their members' number taken together.
    """
    apart = F.aggregate(
        F.zip_with(odd_a, odd_b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda total, x: total + x
    )
    return apart * (1 + threshold) <= (F.col(n_a) + F.col(n_b)) * (1 - threshold) + 1e-6


def _estimated(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Stored pairs that sizes, odd sketches and union sketches allow, as (a, b)."""
    ends = stored(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct(), "ends")
    slim = stored(keep_where(nodes.select("node", "n", "sketch", "odd"), ends, "node", "left_semi"), "sketches")
    degrees = pairs.groupBy("b").agg(F.count(F.lit(1)).alias("_n"))
    right = stored(degrees.join(slim.toDF("b", "nb", "sb", "ob"), "b"), "sketches")
    sided = attach(pairs, right, "b", "_n", "a", "inner").join(slim.toDF("a", "na", "sa", "oa"), "a")
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, SKETCH)
    shared = F.size(F.array_intersect(F.array_intersect("sa", "sb"), union))
    whole = (F.col("na") <= SKETCH) & (F.col("nb") <= SKETCH)
    both = F.size(F.array_intersect("sa", "sb"))
    allowed = F.when(whole, both >= threshold * (F.col("na") + F.col("nb") - both) - 1e-9).otherwise(
        shared >= least_overlap(threshold)
    )
    fits = F.least("na", "nb") >= F.greatest("na", "nb") * threshold - 1e-9
    near = _near_enough("oa", "ob", "na", "nb", threshold)
    likely = stored(sided.where(fits & near).where(allowed).select("a", "b"), "likely")
    forget(ends, slim, right)
    return likely


def _whole_sets(docs: DataFrame, used: DataFrame, nodes: DataFrame, width: int, held: list[DataFrame]) -> DataFrame:
    """Stored (node, members): whole sets of the used nodes that are not among those held."""
    fresh = reduce(lambda left, sets: left.join(sets.select("node"), "node", "left_anti"), held, used.select("node"))
    fresh = stored(fresh.join(nodes.select("node", "set_key", "doc_id"), "node"), "fresh")
    texts = keep_where(docs.select("doc_id", "text"), fresh.select("doc_id").distinct(), "doc_id", "left_semi").select("text")
    found = texts.mapInArrow(partial(_set_batches, width=width), "set_key binary, members array<bigint>")
    # one node per set: grouped where the join has put them, whole sets travel once
    sets = fresh.join(found, "set_key").groupBy("set_key", "node").agg(F.first("members").alias("members"))
    sets = stored(sets.select("node", "members"), "members")
    forget(fresh)
    return sets


def _verified(likely: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Stored (a, b) whose exact Jaccard reaches the threshold; b may be part of very many pairs."""
    degrees = likely.groupBy(F.col("b").alias("node")).agg(F.count(F.lit(1)).alias("_n"))
    right = stored(
        degrees.join(sets, "node").select(F.col("node").alias("b"), F.col("members").alias("members_b"), "_n"), "right"
    )
    sided = likely.join(sets.select(F.col("node").alias("a"), F.col("members").alias("members_a")), "a")
    whole = attach(sided, right, "b", "_n", "a", "inner")
    both = F.size(F.array_intersect("members_a", "members_b"))
    union = F.size("members_a") + F.size("members_b") - both
    links = stored(whole.where(100 * both >= percent * union).select("a", "b"), "links")
    forget(right)
    return links


def _labelled(lists: DataFrame, roots: DataFrame | None) -> DataFrame:
    if roots is None:
        return lists.withColumn("root", F.col("node"))
    return lists.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _stars(labelled: DataFrame, turn: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Stored (a, b), members of every open list that may be linked to its pivot b, and the stored open lists.

    The pivot of the first turn is the list's smallest node, later ones are drawn by hash. A list whose
    members are all in one component is closed for good.
    """
    traits = ("n", *BITS)
    pivot = F.struct("root", "node", *traits)
    chosen = F.min(pivot) if turn == 0 else F.min_by(pivot, F.struct(F.xxhash64("node", F.lit(turn)), "node"))
    heads = labelled.groupBy("value").agg(
        F.count(F.lit(1)).alias("_n"), F.min("root").alias("low"), F.max("root").alias("high"), chosen.alias("pivot")
    )
    heads = stored(
        heads.where("low < high").select(
            "value", "_n", F.col("pivot.root").alias("at"), F.col("pivot.node").alias("b"),
            *[F.col(f"pivot.{t}").alias(f"at_{t}") for t in traits],
        ),
        "heads",
    )
    still = stored(attach(labelled, heads, "value", "_n", "node", "inner"), "open")
    likely = still.where(F.col("root") != F.col("at")).where(_alike(F.col, lambda c: F.col(f"at_{c}"), threshold))
    pairs = stored(likely.select(F.col("node").alias("a"), "b").distinct(), "pairs")
    lists = stored(still.select("node", *traits, "value"), "lists")
    forget(heads, still)
    return pairs, lists


def _sides(labelled: DataFrame, nodes: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """Members of the open lists and those outside a list's largest component, and the stored tables behind both.

    Two of them meet where value, band, row and column are equal, and nowhere else. Members of longer
    lists meet only where their sizes allow a pair, by those bands of sizes that the list has. A list of
    many pairs is a grid of cells of about PART_PAIRS each: members are dealt over its rows and those
    outside over its columns, so a row of either is repeated once per about 1,000 on the other side.
    """
    # sizes of a pair are at most one band apart
    def band(n: str) -> Column:
        return F.when(F.col("banded"), F.floor(F.log(n) / log(1 / threshold) + 1e-9)).otherwise(F.lit(0).cast("bigint"))

    counted = labelled.groupBy("value", "root").agg(
        F.count(F.lit(1)).alias("c"), F.min("n").alias("fewest"), F.max("n").alias("largest")
    )
    lists = counted.groupBy("value").agg(
        F.max_by("root", F.struct("c", "root")).alias("main"),
        (F.sum("c") - F.max("c")).alias("outside"),
        F.count(F.lit(1)).alias("k"),
        F.sum("c").alias("_n"),
        F.min("fewest").alias("fewest"),
        F.max("largest").alias("largest"),
    )
    lists = lists.where("k > 1").withColumn("banded", F.col("_n") > BANDED)
    lists = lists.withColumn("columns", F.ceil(F.col("outside") / PART_PAIRS**0.5))
    rows = F.ceil(F.col("_n") * F.col("outside") / (F.col("columns") * PART_PAIRS))
    lists = lists.select(
        "value", "main", "banded", band("fewest").alias("low"), band("largest").alias("high"), rows.alias("rows"), "columns", "_n"
    )
    lists = stored(lists, "open")
    inside = attach(labelled, lists, "value", "_n", "node", "inner").join(nodes.select("node", "odd"), "node")
    inside = stored(inside.withColumn("band", band("n")), "inside")
    outer = inside.where("root != main").select(
        "value",
        F.col("node").alias("x"),
        F.col("root").alias("rx"),
        *[F.col(t).alias(f"x_{t}") for t in ("n", *BITS, "odd")],
        F.pmod(F.xxhash64("node"), "columns").alias("column"),
        "rows",
        F.explode(F.sequence(F.greatest("low", F.col("band") - 1), F.least("high", F.col("band") + 1))).alias("band"),
    )
    outer = outer.withColumn("row", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("rows") - 1))).drop("rows")
    members = inside.select(
        "value", "node", "root", "main", "n", *BITS, "odd", "band",
        F.pmod(F.xxhash64("node"), "rows").alias("row"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("columns") - 1)).alias("column"),
    )
    return members, outer, [lists, inside]


def _members(labelled: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Stored (a, b): likely pairs of an open list from different components, one end outside the list's largest one."""
    members, outer, behind = _sides(labelled, nodes, threshold)
    met = members.join(outer, ["value", "band", "row", "column"]).where("root != rx AND (root = main OR node < x)")
    met = met.where(_alike(F.col, lambda c: F.col(f"x_{c}"), threshold))
    met = met.where(_near_enough("odd", "x_odd", "n", "x_n", threshold))
    pairs = stored(met.select(F.least("node", "x").alias("a"), F.greatest("node", "x").alias("b")).distinct(), "pairs")
    forget(*behind)
    return pairs


class _Links:
    """Components of the links found so far."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, width: int, percent: int) -> None:
        self.docs, self.nodes, self.width, self.percent = docs, nodes, width, percent
        self.sets: list[DataFrame] = []
        self.roots: DataFrame | None = None

    def add(self, pairs: DataFrame) -> float:
        """Verify pairs (a stored table, which goes) and join what they link; the share of them that are links."""
        compared = pairs.count()
        if not compared:
            return 0.0
        likely = _estimated(pairs, self.nodes, self.percent / 100)
        forget(pairs)
        ends = likely.select(F.col("a").alias("node")).unionByName(likely.select(F.col("b").alias("node"))).distinct()
        self.sets.append(_whole_sets(self.docs, ends, self.nodes, self.width, self.sets))
        fresh = _verified(likely, reduce(DataFrame.unionByName, self.sets), self.percent)
        forget(likely)
        linked = fresh.count()
        if linked:
            self._join(fresh)
        forget(fresh)
        return linked / compared

    def _join(self, fresh: DataFrame) -> None:
        """Components after these links: only roots that are newly linked are looked at, not all links again."""
        if self.roots is None:
            self.roots = connected(fresh)
            return
        known = [self.roots.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}")) for end in ("a", "b")]
        ends = fresh.join(known[0], "a", "left").join(known[1], "b", "left")
        ends = stored(ends.select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b")).distinct(), "ends")
        moved = connected(ends)
        to = moved.select(F.col("node").alias("root"), F.col("root").alias("low"))
        old = self.roots.join(to, "root", "left").select("node", F.coalesce("low", "root").alias("root"))
        new = moved.join(self.roots.select("node"), "node", "left_anti").select("node", "root")
        before, self.roots = self.roots, stored(old.unionByName(new), "roots")
        forget(before, ends, moved)


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the A-Z-lower-cased whole text, a set the distinct hashes of
    ``width`` consecutive words. Documents are linked where 100 * intersection >= percent * union;
    the component is named by its smallest doc_id. Defined cases: a null, empty or wordless text
    has the empty set and links with nothing; a text of fewer words than ``width`` is one shingle;
    equal sets are one node however many copies there are; a null doc_id never names a component
    that has another; repeated rows get equal results; no row is left out. ``percent`` is
    LEAST_PERCENT or more.
    """
    if percent < LEAST_PERCENT:
        raise ValueError(f"percent must be at least {LEAST_PERCENT}, not {percent}")
    rows = profiles(docs, width)
    nodes = set_nodes(rows)
    lists = rare_lists(nodes, percent / 100)

    links, turn, share = _Links(docs, nodes, width, percent), 0, 1.0
    while share >= WORTHWHILE:
        labelled = stored(_labelled(lists, links.roots), "labelled")
        forget(lists)
        pairs, lists = _stars(labelled, turn, percent / 100)
        forget(labelled)
        share, turn = links.add(pairs), turn + 1
    # whatever the stars have found: members of open lists that no pivot has joined
    labelled = stored(_labelled(lists, links.roots), "labelled")
    pairs = _members(labelled, nodes, percent / 100)
    forget(labelled, lists)
    links.add(pairs)
    forget(*links.sets)

    roots = links.roots
    if roots is None:
        named = nodes.select("set_key", "copies", F.col("doc_id").alias("component_id"))
    else:
        placed = nodes.select("node", "set_key", "copies", "doc_id").join(roots, "node", "left")
        placed = stored(placed.withColumn("root", F.coalesce("root", "node")).drop("node"), "placed")
        least = placed.groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("_n"))
        named = attach(placed, stored(least, "least"), "root", "_n", "set_key").select("set_key", "copies", "component_id")
    named = stored(named, "named")
    forget(nodes)
    whole = attach(rows.select("doc_id", "n", "set_key"), named, "set_key", "copies", "doc_id")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return whole.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of every group, all columns kept.

    A doc_id goes when no row of it is kept; rows with a null doc_id stay.
    """
    marked = near_duplicates(docs, width, percent).groupBy("doc_id").agg(F.max("kept").alias("kept"))
    lost = stored(marked.where("NOT kept AND doc_id IS NOT NULL").select("doc_id"), "lost")
    return keep_where(docs, lost, "doc_id", "left_anti")
