"""Look-ups in tables of which tasks hold the frequent rows only, and phrases of a batch, against brute force."""

import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexflume.functions.phrases import SLICE, phrases_of
from lexflume.operators import keyed, sequence


def _rows():
    rng = random.Random(3)
    rows = [[f"t{min(int(rng.expovariate(0.2)), 40)}" for _ in range(rng.randrange(12))] for _ in range(60)]
    return [*rows, None, [], ["unknown", None, "t0", "unknown"], ["t0" * 40, "t1"]]


@pytest.mark.parametrize("limit", [0, 5, 20])
def test_only_rare_items_are_joined(spark, monkeypatch, limit):
    rows = _rows()
    n = Counter(t for r in rows if r for t in r if t and t != "unknown")
    ids = {t: i for i, t in enumerate(sorted(n))}
    table = spark.createDataFrame([(t, n[t], ids[t]) for t in ids], "token string, n bigint, id bigint")
    joined = []

    def seen(facts, *rest):
        joined.extend(r["token"] for r in facts.collect())
        return real(facts, *rest)

    real = keyed.skewed_join
    monkeypatch.setattr(keyed, "skewed_join", seen)
    held = keyed.KeyedTable(table, "token", whole_rows=limit, often="n")
    df = spark.createDataFrame([(i % 7, r) for i, r in enumerate(rows)], "k int, items array<string>")
    found = held.look_up(df, F.col("items"), "id", -1, "ids", ["k", "items"]).collect()
    common = {r["token"] for r in held.held.collect()}
    assert len(common) <= limit and (limit == 0 or common)
    assert all(n[c] >= max((n[t] for t in n if t not in common and len(t) <= keyed.KEY_CHARS), default=0) for c in common)
    assert Counter(joined) == Counter(t for r in rows if r for t in r if t is not None and t not in common)
    wanted = [(i % 7, r, [ids.get(t, -1) for t in r or []]) for i, r in enumerate(rows)]
    assert sorted(map(repr, ((f["k"], f["items"], f["ids"]) for f in found))) == sorted(map(repr, wanted))


def test_records_look_document_and_target_up_once(spark, monkeypatch):
    docs = spark.createDataFrame(
        [(1, "a b c d", "c; zz"), (1, None, "a"), (None, "b " * 9, None), (2, "", "")], "doc_id int, document string, keywords_str string"
    )
    vocab = spark.createDataFrame([("a", 5, 2), ("b", 4, 3), ("c", 1, 4), ("d", 1, 5)], "token string, n bigint, id int")
    held = keyed.KeyedTable(vocab, "token", whole_rows=2, often="n")
    calls, real = [], keyed.KeyedTable.look_up
    monkeypatch.setattr(keyed.KeyedTable, "look_up", lambda *a: calls.append(a) or real(*a))
    found = sequence.encode_records(docs, held, max_document=6, max_target=3).collect()
    wanted = [
        (1, [2, 3, 4, 5, 0, 0], [1, 1, 1, 1, 0, 0], [4, 1, -100]),
        (1, [0] * 6, [0] * 6, [2, -100, -100]),
        (None, [3] * 6, [1] * 6, [-100] * 3),
        (2, [0] * 6, [0] * 6, [-100] * 3),
    ]
    assert sorted(repr(tuple(r)) for r in found) == sorted(map(repr, wanted))
    assert len(calls) == 1


def test_phrases_of_a_batch_match_brute_force():
    rng = random.Random(9)
    rows = [[rng.choice("abcd|") for _ in range(rng.randrange(9))] for _ in range(2 * SLICE)] + [[], ["a"]]
    stops = [[int(t in "|d") for t in r] for r in rows]
    found = phrases_of(pa.array(rows, pa.list_(pa.string())), pa.array(stops, pa.list_(pa.int32())), 2, 4).to_pylist()
    for r, f in zip(rows, found, strict=True):
        runs = [r[i : i + n] for n in (2, 3, 4) for i in range(len(r) - n + 1)]
        assert {c["item"]: c["n"] for c in f} == Counter(" ".join(x) for x in runs if not set(x) & set("|d"))
        assert len({c["item"] for c in f}) == len(f)
    assert phrases_of(pa.array([], pa.list_(pa.string())), pa.array([], pa.list_(pa.int32())), 2, 4).to_pylist() == []
