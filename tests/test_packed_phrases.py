"""What phrases of a corpus travel, and that hashes only rule out."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from lexflume.functions import items, phrases
from lexflume.operators import keyphrases
from test_keyphrases import brute_phrases, candidates

ODD = ["", None, "Solar-power PLANT; solar power\nplant", "é solar power été ｐlant", "a b" * 400, "x" * 90 + " " + "y" * 90, "|", "Kİ solar power"]


def texts():
    rng = random.Random(4)
    rows = [" ".join(rng.choice(["the", "solar power", "river bank", f"one{i}x{j}", "end.", "w"]) for j in range(rng.randrange(30))) for i in range(120)]
    return [*rows, *ODD, *ODD]


def expected(rows, ranked):
    return Counter((i % 9 if i % 5 else None, r + 1, p) for i, best in enumerate(ranked) for r, (p, _) in enumerate(best))


def found(df, k, learned):
    return Counter((r["doc_id"], r["rank"], r["term"]) for r in keyphrases.extract_keyphrases(df, k, learned).collect())


@pytest.mark.parametrize("whole_rows", [0, 12, 10_000])
def test_phrases_that_occur_once_do_not_travel(frame, monkeypatch, whole_rows):
    rows = texts()
    _, weight, ranked = brute_phrases([t and t.replace("İ", "i") for t in rows], 4, share=0.5)
    df = frame([(i % 9 if i % 5 else None, t) for i, t in enumerate(rows)], "doc_id int, text string", 5)
    counted, sent = [], []
    count, rank = keyphrases.counted_phrases, keyphrases.best_of_table

    def seen_count(lowered, stops, known, *rest):
        texts = pa.array([(t or "").lower() for t in rows])
        counted.extend(phrases.Words(texts, stops.value).counted(2, 4, known.value)[0].to_pylist())
        return count(lowered, stops, known, *rest)

    def seen_rank(facts, *rest):
        sent.extend(p for r in facts.collect() for p in r["phrases"].split("\n"))
        return rank(facts, *rest)

    monkeypatch.setattr(keyphrases, "counted_phrases", seen_count)
    monkeypatch.setattr(keyphrases, "best_of_table", seen_rank)
    learned = keyphrases.learn_phrases(df, share=0.5, whole_rows=whole_rows)
    got = found(df, 4, learned)
    assert got == expected(rows, ranked)
    assert counted and set(counted) <= set(weight)
    held = {r["phrase"] for r in learned.table.held.collect()}
    assert set(sent) == (set() if learned.table.small else {p for p, w in weight.items() if w > 0} - held)


@pytest.mark.parametrize("parts", [1, 1 << 12])
def test_hashes_only_rule_out(frame, monkeypatch, parts):
    """With maps that rule out nothing and equal hashes of all words, the result is the same."""
    rows = texts()
    _, _, ranked = brute_phrases([t and t.replace("İ", "i") for t in rows], 4, share=0.5)
    df = frame([(i % 9 if i % 5 else None, t) for i, t in enumerate(rows)], "doc_id int, text string", 5)
    full = np.full(1 << 17, 255, np.uint8)
    monkeypatch.setattr(keyphrases, "repeated_phrases", lambda *a: full)
    monkeypatch.setattr(keyphrases, "known_phrases", lambda *a: full)
    monkeypatch.setattr(keyphrases, "PART_PHRASES", parts)
    monkeypatch.setattr(keyphrases, "PART_ROWS", parts)
    assert found(df, 4, keyphrases.learn_phrases(df, share=0.5, whole_rows=0)) == expected(rows, ranked)


@pytest.mark.parametrize("size", [40, 1 << 22])
def test_candidates_of_texts_match_brute_force(monkeypatch, size):
    monkeypatch.setattr(items, "TEXT_BYTES", size)
    rng = random.Random(8)
    rows = ["".join(rng.choice(["a ", "b ", "The ", "c-", "d. ", "|", "é", '"', "\r\n", "9 "]) for _ in range(rng.randrange(40))) for _ in range(300)]
    rows = [t.lower() for t in rows] + ["", None]
    at = 0
    for part in items.text_parts(pa.array(rows)):
        names, each, n = phrases.Words(part, pa.array(["the", "9"])).counted(1, 3)
        got = [Counter() for _ in range(len(part))]
        for row, code, k in zip(each // max(len(names), 1), each % max(len(names), 1), n, strict=True):
            got[row][names[code].as_py()] = k
        assert got == [candidates(t, {"the", "9"}, 1, 3) for t in rows[at : at + len(part)]]
        at += len(part)
    assert at == len(rows)


def test_a_map_holds_what_occurs_often_enough(spark, frame):
    rows = [f"w{i} v{i} u{i} w{i} v{i}" if i % 3 else f"w{i} v{i}" for i in range(300)] + ["w3 v3", "w6 v6 w9"]
    df = frame([(t,) for t in rows], "text string", 7)
    stops = spark.sparkContext.broadcast(pa.array([], pa.string()))
    f = Counter(p for t in rows for p in candidates(t, set()).elements())
    for least in (1, 2, 3):
        known = phrases.repeated_phrases(df, stops, 2, 4, least, 1 << 26)
        names = phrases.Words(pa.array(rows), stops.value).counted(2, 4, known)[0].to_pylist()
        assert set(names) == {p for p, n in f.items() if n >= least}
    wanted = sorted(p for p, n in f.items() if n >= 2)
    known = phrases.known_phrases(frame([(p,) for p in wanted], "phrase string"), 4, len(wanted))
    names = phrases.Words(pa.array(rows), stops.value).counted(2, 4, known)[0].to_pylist()
    assert set(wanted) <= set(names) and len(names) <= len(wanted) + 3


def test_held_phrases_of_equal_hashes_stay_apart(monkeypatch):
    monkeypatch.setattr(phrases, "hashes_of", lambda names: pc.binary_length(names).to_numpy().astype(np.uint64))
    held = phrases.by_hash(pa.array(["a b", "c d", "long phrase", "e f"]), np.array([1.0, 2.0, 3.0, 4.0]))
    weight, has = phrases.weights_of(pa.array(["e f", "x y", "a b", "long phrase", "c d", "longer phrase"]), held)
    assert weight.tolist() == [4.0, 0.0, 1.0, 3.0, 2.0, 0.0] and has.tolist() == [True, False, True, True, True, False]
    none = phrases.by_hash(pa.array([], pa.string()), np.zeros(0))
    assert phrases.weights_of(pa.array(["a b"]), none)[1].tolist() == [False]


def test_phrases_within_longer_ones_count_once_each(monkeypatch):
    """Sums of what is around a phrase, whatever the number of parts and of phrases sent at one time."""
    rng = random.Random(5)
    f = {" ".join(rng.choice("abc") for _ in range(rng.randrange(1, 5))): rng.randrange(1, 9) for _ in range(90)}
    wanted = {}
    for p, n in f.items():
        longer = [q for q in f if len(q) > len(p) and f" {p} " in f" {q} " and f[q] > 1]
        if n > 1:
            wanted[p] = (p.count(" ") + 1, n, n + 7, sum(f[q] for q in longer), len(longer))
    names = pa.array(list(f))
    for parts, held in ((1, 1), (5, 1), (5, 1 << 18)):
        monkeypatch.setattr(phrases, "HELD_ROWS", held)
        sent = phrases._packed(phrases._part_of(names, parts), 0, names, np.array(list(f.values())) + 7, np.array(list(f.values())))
        met = [r for b in phrases._total_counts([sent], 1, 4, 2, parts) for r in b.to_pylist()]
        met = pa.RecordBatch.from_pylist(sorted(met, key=lambda r: (r["part"], r["kind"])), sent.schema)
        got = [r for b in phrases._with_around([met.slice(0, 2), met.slice(2)]) for r in b.to_pylist()]
        assert {r["phrase"]: tuple(r.values())[1:] for r in got} == wanted and len(got) == len(wanted)
