"""Building blocks under lopsided data, against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexflume.functions.hashing import seeded_key
from lexflume.operators import distributed as d
from lexflume.operators.keyed import KeyedTable, dealt, hot_keys


def lopsided(n=4000, seed=3):
    """A third of the rows in one group, a third of a group's rows with one value."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        group = "hot" if rng.random() < 0.34 else rng.choice(["a", "b", None])
        value = 7.0 if rng.random() < 0.34 else rng.choice([rng.gauss(0, 1e3), float(rng.randint(0, 5))])
        rows.append((group, value))
    return rows + [("lone", 1.5), ("a", None), ("a", float("nan"))]


@pytest.mark.parametrize("buckets", [2, 16, 256])
def test_exact_quantiles_per_group(frame, buckets):
    rows = lopsided()
    df = frame(rows, "g string, v double", 5)
    wanted = {"q1": 0.25, "median": 0.5, "p95": 0.95, "low": 0.0, "high": 1.0}
    found = d.exact_quantiles(d.value_counts(df, "v", ["g"]), "v", wanted, ["g"], buckets).collect()
    groups = {g for g, _ in rows}
    assert {r["g"] for r in found} == groups
    for r in found:
        values = [v for g, v in rows if g == r["g"] and v is not None and v == v]
        for name, q in wanted.items():
            assert r[name] == pytest.approx(np.percentile(values, q * 100), abs=1e-9), (r["g"], name)


def test_exact_quantiles_of_a_whole_frame(frame):
    rows = lopsided(1000, 4)
    values = [v for _, v in rows if v is not None and v == v]
    found = d.exact_quantiles(d.value_counts(frame(rows, "g string, v double"), "v"), "v", {"m": 0.5}).first()
    assert found["m"] == pytest.approx(np.median(values))


def test_quantiles_of_nothing(frame):
    df = frame([(None,)], "v int")
    assert d.exact_quantiles(d.value_counts(df, "v"), "v", {"m": 0.5}).collect() in ([], [(None,)])


def test_rows_without_a_key_are_kept(frame):
    df = frame([(None,), (1,), (2,)], "id int")
    found = d.global_position(df, seeded_key(F.col("id"), 42), "id").collect()
    assert sorted(r["position"] for r in found) == [1, 2, 3]
    assert {r["position"]: r["id"] for r in found}[1] is None
    found = d.sorted_position(df, "id", F.struct("id")).collect()
    assert sorted((r["position"], r["id"]) for r in found) == [(1, None), (2, 1), (3, 2)]


@pytest.mark.parametrize("digits", [1, 2, 4])
def test_global_position(frame, digits):
    df = frame([(i,) for i in range(500)], "id int", 4)
    found = d.global_position(df, seeded_key(F.col("id"), 42), "id", digits=digits).collect()
    import hashlib

    order = sorted(range(500), key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest())
    assert [r["id"] for r in sorted(found, key=lambda r: r["position"])] == order
    assert sorted(r["position"] for r in found) == list(range(1, 501))


def test_sorted_position_with_shared_prefixes_and_equal_weights(frame):
    rng = random.Random(5)
    rows = [(f"prefix{i:05d}", 1) for i in range(6000)] + [(f"w{i}", rng.randint(2, 900)) for i in range(3000)]
    df = frame(rows, "token string, n int", 6)
    found = d.sorted_position(df, "token", F.struct((-F.col("n")).alias("w"), F.col("token"))).collect()
    expected = [t for t, n in sorted(rows, key=lambda r: (-r[1], r[0]))]
    assert [r["token"] for r in sorted(found, key=lambda r: r["position"])] == expected


def test_sorted_position_of_one_row_and_none(frame):
    one = frame([("a", 1)], "token string, n int")
    assert d.sorted_position(one, "token", F.struct("n", "token")).first()["position"] == 1
    assert d.sorted_position(one.where("n > 1"), "token", F.struct("n", "token")).collect() == []


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("limits", [{}, {"whole_rows": 5}, {"whole_rows": 5, "part_rows": 7}, {"whole_rows": 5, "part_rows": 1, "shares": 3}])
def test_keyed_join_is_a_join(frame, how, limits):
    rng = random.Random(6)
    long_word = "x" * 100
    words = ["hot"] * 400 + [long_word] * 50 + [f"w{rng.randint(0, 60)}" for _ in range(400)] + ["absent"] * 90 + [None] * 40
    facts = frame([(i, w) for i, w in enumerate(words)], "id int, w string", 5)
    table = frame([(w, len(w)) for w in sorted({w for w in words if w} - {"absent"})], "w string, size int")
    held = KeyedTable(table, "w", **limits)
    assert not held.small  # one key is too long
    found = held.join(facts, how).select("id", "w", "size").collect()
    expected = facts.join(table, "w", how).select("id", "w", "size").collect()
    assert sorted(found, key=repr) == sorted(expected, key=repr)


def test_hot_keys_are_those_of_the_facts(spark):
    """Keys a table lacks, and missing keys, are dealt over parts too."""
    key = F.when(F.col("id") % 3 == 0, "lacking").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id")))
    facts = spark.range(60_000).select("id", key.alias("w"))
    hot = hot_keys(facts, "w", part_rows=1000)
    parts = dict(tuple(r) for r in hot.collect())
    hashes = {r["h"]: r["w"] for r in facts.where("id IN (0, 2)").select("w", F.xxhash64("w").alias("h")).collect()}
    assert {hashes[h]: n for h, n in parts.items()} == {"lacking": 20, None: 20}
    sizes = dealt(facts, "w", hot).groupBy("w", "_part").count()
    assert sizes.agg(F.max("count")).first()[0] < 1300
    assert sizes.agg(F.sum("count")).first()[0] == 60_000


def test_hot_keys_need_no_more_than_their_share(spark):
    assert hot_keys(spark.range(50_000).select(F.col("id").cast("string").alias("w")), "w", part_rows=1000).isEmpty()


def test_merge_rows(frame):
    a = frame([("x", 1), ("y", 2)], "g string, a int")
    b = frame([("x", 3)], "g string, b int")
    assert sorted(tuple(r) for r in d.merge_rows([a, b], ["g"]).select("g", "a", "b").collect()) == [("x", 1, 3), ("y", 2, None)]


def test_exploded_is_explode(frame):
    df = frame([(1, ["a", "b"]), (2, []), (3, None)], "id int, xs array<string>")
    assert sorted(tuple(r) for r in d.exploded(df, F.col("xs"), "x", "id").collect()) == [(1, "a"), (1, "b")]
