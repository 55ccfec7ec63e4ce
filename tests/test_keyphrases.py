"""Keyphrases, quantiles, ranks, samples and batches at their edges, against brute force."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexflume.operators import distributed as d
from lexflume.operators import keyphrases, models, profile, sequence
from lexflume.session import stored

LIMITS = [{}, {"whole_rows": 0}, {"whole_rows": 0, "part_rows": 3}]


def candidates(text, stops, fewest=2, most=4):
    low = re.sub(r'[.,;:!?()\[\]{}"|\r\n]+', " | ", (text or "").lower())
    toks = [t for t in re.split(r"[^a-z0-9|]+", low) if t]
    found = Counter()
    for n in range(fewest, most + 1):
        for i in range(len(toks) - n + 1):
            run = toks[i : i + n]
            if not any("|" in t or t in stops for t in run):
                found[" ".join(run)] += 1
    return found


def brute_phrases(rows, k, share=0.1, least=2):
    n = len(rows)
    df = Counter(t for text in rows for t in set(re.findall("[a-z0-9]+", (text or "").lower())))
    stops = {t for t, c in df.items() if c >= share * n}
    each = [candidates(t, stops) for t in rows]
    f, doc_freq = Counter(), Counter()
    for c in each:
        f.update(c)
        doc_freq.update(c.keys())
    f = {p: c for p, c in f.items() if c >= least}
    around = defaultdict(list)
    for p, c in f.items():
        w = p.split()
        for s in {" ".join(w[i:j]) for i in range(len(w)) for j in range(i + 2, len(w) + 1) if j - i < len(w)}:
            around[s].append(c)
    weight = {}
    for p, c in f.items():
        own = (c - sum(around[p]) / len(around[p])) / c if around[p] else 1.0
        weight[p] = round(math.log((n + 1) / (doc_freq[p] + 1)) * math.log2(1 + len(p.split())) * own, 6)
    out = []
    for c in each:
        scored = sorted((-round(t * weight[p], 6), p) for p, t in c.items() if p in weight)
        out.append([(p, -s) for s, p in scored if s < 0][:k])
    return stops, weight, out


def corpus():
    rng = random.Random(12)
    rows = [None, "", "The of. the", "new york city hall, new york city | and new york"]
    names = ["new york city", "neural network", "deep neural network", "solar power plant", "river bank"]
    for _ in range(150):
        words = []
        for _ in range(rng.randrange(25)):
            words.append(rng.choice(["the", "of", rng.choice(names), f"w{rng.randrange(80)}", "end.", 'say "', "x|y"]))
        rows.append(" ".join(words))
    return rows


@pytest.mark.parametrize("limits", LIMITS)
def test_keyphrases_against_brute_force(frame, limits):
    rows = corpus()
    stops, weight, wanted = brute_phrases(rows, 5, share=0.6)
    assert {"the", "of"} <= stops and any(len(p.split()) > 2 for p in weight)
    df = frame([(i % 90 if i % 7 else None, t) for i, t in enumerate(rows)], "doc_id int, text string", 4)
    learned = keyphrases.learn_phrases(df, share=0.6, **limits)
    assert {r["token"] for r in learned.stops.rows.collect()} == stops
    found = {r["phrase"]: r["weight"] for r in learned.table.rows.collect()}
    assert set(found) == set(weight) and all(found[p] == pytest.approx(w, abs=2e-6) for p, w in weight.items())
    got = keyphrases.extract_keyphrases(df, 5, learned).collect()
    expected = Counter((i % 90 if i % 7 else None, r + 1, p) for i, ranked in enumerate(wanted) for r, (p, _) in enumerate(ranked))
    assert Counter((r["doc_id"], r["rank"], r["term"]) for r in got) == expected


def test_phrase_inside_longer_ones_only_has_no_weight(frame):
    df = frame([(i, "city hall tower" if i < 3 else f"other{i} words{i}") for i in range(40)], "doc_id int, text string")
    learned = keyphrases.learn_phrases(df, share=0.5)
    found = {r["phrase"]: (r["around"], r["around_n"], r["weight"]) for r in learned.table.rows.collect()}
    assert found["city hall"] == (3, 1, 0.0) and found["city hall tower"][2] > 0
    top = keyphrases.extract_keyphrases(df, 3, learned).where("doc_id = 0").collect()
    assert [r["term"] for r in top] == ["city hall tower"]


def test_keyphrases_of_nothing(frame):
    df = frame([(1, None)], "doc_id int, text string")
    assert keyphrases.extract_keyphrases(df).collect() == []
    assert keyphrases.extract_keyphrases(df.limit(0)).collect() == []


@pytest.mark.parametrize("shares", [1, 4, 1000])
@pytest.mark.parametrize("buckets", [4, 1024])
def test_quantiles_of_hot_and_small_groups(frame, shares, buckets):
    rng = random.Random(3)
    rows = [("all", float(rng.randrange(3))) for _ in range(3000)] + [("wide", rng.gauss(0, 1e6)) for _ in range(3000)]
    rows += [(f"g{i % 300}", rng.random()) for i in range(900)] + [(None, 2.0), (None, 3.0), ("none", None)]
    wanted = {"q1": 0.25, "m": 0.5, "p95": 0.95, "low": 0.0, "high": 1.0}
    counts = d.value_counts(frame(rows, "g string, v double", 6), "v", ["g"])
    found = {r["g"]: r for r in d.exact_quantiles(counts, "v", wanted, ["g"], buckets, shares).collect()}
    groups = defaultdict(list)
    for g, v in rows:
        if v is not None:
            groups[g].append(v)
    assert set(found) == set(groups)
    for g, values in groups.items():
        for name, q in wanted.items():
            assert found[g][name] == pytest.approx(np.percentile(values, q * 100), abs=1e-9), (g, name)


def test_distinct_values_travel_once(spark):
    """After the count no exchange holds values but those of the brackets: nothing else is partitioned by hash."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = spark.range(20_000).selectExpr("id % 3 AS g", "cast(id as double) AS v")
        counts = d.value_counts(rows, "v", ["g"])
        found = d.exact_quantiles(counts, "v", {"m": 0.5}, ["g"], shares=10)
        found.collect()
        text = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in text and "ShuffledHashJoin" not in text
        got = {r["g"]: r["m"] for r in found.collect()}
        assert got == {g: float(np.median(np.arange(g, 20_000, 3))) for g in range(3)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_group_facts_reach_hot_and_small_groups(frame):
    rows = [("hot", i) for i in range(500)] + [(f"g{i}", i) for i in range(40)] + [(None, 7)]
    facts = [(g, f"fact of {g}") for g in {g for g, _ in rows}]
    for shares in (1, 3, 1000):
        met = d.join_group_facts(frame(rows, "g string, v int", 4), frame(facts, "g string, fact string"), ["g"], shares)
        found = sorted(((r["g"], r["v"], r["fact"]) for r in met.select("g", "v", "fact").collect()), key=repr)
        assert found == sorted(((g, v, f"fact of {g}") for g, v in rows), key=repr)


@pytest.mark.parametrize("sample", [64, 4000, d.KEY_SAMPLE])
def test_in_order_ranks_stay_bounded(frame, sample):
    """Two levels of splitters: no bucket holds many rows, however alike the keys are."""
    rng = random.Random(5)
    rows = [("shared/prefix/of/all/keys/" * 3 + f"{i:06d}", rng.choice([1, 1, 1, 2, 900])) for i in range(12_000)]
    df = frame(rows, "token string, n int", 6)
    found = d.sorted_position(df, "token", F.struct((-F.col("n")).alias("w"), F.col("token")), sample=sample)
    wanted = [t for t, n in sorted(rows, key=lambda r: (-r[1], r[0]))]
    assert [r["token"] for r in sorted(found.collect(), key=lambda r: r["position"])] == wanted


def test_samples_move_keys_only(spark, frame):
    rows = [(i, "abc"[i % 3] if i % 11 else None, "long text " * 50) for i in range(300)]
    df = frame(rows, "id int, label_name string, text string")
    sample = profile.sample_per_class(df, "id", n=4)
    found = sample.collect()
    assert Counter((r["label_name"], r["sample_no"]) for r in found) == {(c, i): 1 for c in "abc" for i in range(1, 5)}
    assert all(r["text"] == "long text " * 50 for r in found)
    plan = sample._jdf.queryExecution().executedPlan().toString()
    # what is ranked by the digest are keys and names
    ranked = plan[re.search(r"WindowGroupLimit .*_digest.* Partial|WindowGroupLimit .*_digest.*Partial", plan).start() :]
    below = ranked.splitlines()[1:4]
    assert any(re.search(r"Project \[id#\d+, label_name#\d+, md5\(", line) for line in below), below


def test_samples_of_repeated_keys(frame):
    df = frame([(1, "a", "x"), (1, "a", "y"), (None, "a", "z"), (2, "b", "w")], "id int, label_name string, text string")
    found = profile.sample_per_class(df, "id", n=2).collect()
    assert Counter(r["label_name"] for r in found) == {"a": 2, "b": 1}
    assert len({tuple(r) for r in found}) == 3


@pytest.mark.parametrize("shuffle", [True, False])
def test_batch_records(spark, frame, tmp_path, shuffle):
    docs = frame([(i, f"w{i} w{i % 5} the" if i % 9 else None) for i in range(103)], "doc_id int, text string", 5)
    vocab = stored(sequence.build_vocab(docs), "vocab")
    coded = sequence.encode(docs, vocab, 4)
    batches = sequence.batch_records(coded, "doc_id", 16, ["input_ids", "attention_mask"], shuffle=shuffle)
    sequence.write_batches(batches, str(tmp_path / "b"), per_file=3)
    found = sorted(sequence.read_batches(spark, str(tmp_path / "b"), per_file=3).collect(), key=lambda r: r["batch_id"])
    assert [r["n"] for r in found] == [16] * 6 + [7]
    ids = {r["doc_id"]: (r["input_ids"], r["attention_mask"]) for r in coded.collect()}
    placed = {r["position"]: r["doc_id"] for r in sequence.shuffle_and_batch(docs, "doc_id", 16, shuffle=shuffle).collect()}
    assert [k for r in found for k in r["keys"]] == [placed[p] for p in sorted(placed)]
    for r in found:
        assert list(zip(r["input_ids"], r["attention_mask"], strict=True)) == [ids[k] for k in r["keys"]]
    some = sequence.read_batches(spark, str(tmp_path / "b"), first=2, last=4, per_file=3)
    assert sorted(r["batch_id"] for r in some.collect()) == [2, 3, 4]
    assert len(list((tmp_path / "b").glob("range=*/*.parquet"))) == 3


def test_idf_is_counted_once(frame, monkeypatch):
    df = frame([(1, "a b"), (2, "b c")], "doc_id int, text string")
    held = models.Idf.of(stored(models.idf_table(df), "idf"))
    assert held.table.small and held.n_docs == 2
    monkeypatch.setattr(models.Idf, "of", None)  # a prepared table is used as it is
    assert models.extract_keywords(df, 1, held).count() == 2
