"""Tokens and shared runs counted by Arrow batches, against brute force and without cutting whole texts."""

import random
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from lexflume.functions import items, language
from lexflume.operators import evaluate, models


def _texts():
    rng = random.Random(5)
    made = ["".join(rng.choice("ab1 .-é\n中B") for _ in range(rng.randrange(30))) for _ in range(200)]
    return [*made, None, "", "...", "x", "a.", ".a", "a b" * 50]


def _cut(t):
    return re.findall("[a-z0-9]+", (t or "").lower())


def test_tokens_of_a_batch(monkeypatch):
    monkeypatch.setattr(items, "TEXT_BYTES", 64)
    texts = [None if t is None else t.lower() for t in _texts()]
    for rows in (texts, texts[3:], [None], [""], []):
        found = []
        for part in items.text_parts(pa.array(["skipped", *rows], pa.string()).slice(1)):
            flat, ends = items.tokens_of(part)
            found += [flat.to_pylist()[a:b] for a, b in zip([0, *ends], ends)]
        assert found == [_cut(t) for t in rows]


def test_counted_tokens(frame):
    rows = [(i, t) for i, t in enumerate(_texts())]
    df = frame(rows, "id int, text string")
    for r in df.select("id", items.token_counts(F.col("text")).alias("c")).collect():
        assert {c["item"]: c["n"] for c in r["c"]} == Counter(_cut(rows[r["id"]][1]))
    totals = {r["token"]: r["n"] for r in items.token_totals(df, "text").collect()}
    assert totals == Counter(w for _, t in rows for w in _cut(t))
    held = {r["token"]: r["n"] for r in items.token_totals(df, "text", once=True).collect()}
    assert held == Counter(w for _, t in rows for w in set(_cut(t)))


def test_shared_runs_and_subsequences():
    rng = random.Random(6)
    a = [[rng.choice("abcde") for _ in range(rng.randrange(20))] for _ in range(300)] + [None, [], ["a"] * 9]
    b = [[rng.choice("abcxy") for _ in range(rng.randrange(12))] for _ in range(300)] + [["a"], None, ["a"] * 4]
    x, y = (pa.array(z, pa.list_(pa.string())) for z in (a, b))
    for n in (1, 2, 3, 4):
        grams = [[Counter(tuple(r[i : i + n]) for i in range(len(r or []) - n + 1)) for r in z] for z in (a, b)]
        wanted = [sum((p & q).values()) for p, q in zip(*grams, strict=True)]
        assert language.shared_gram_counts(x, y, n).to_pylist() == wanted
    assert language.lcs_lengths(x, y).to_pylist() == [language.lcs_length(p or [], q or []) for p, q in zip(a, b, strict=True)]
    empty = pa.array([], pa.list_(pa.string()))
    assert language.shared_gram_counts(empty, empty, 2).to_pylist() == language.lcs_lengths(empty, empty).to_pylist() == []


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_counts_are_not_made_by_lambdas_or_exploded_tokens(frame):
    df = frame([(1, "a b", "a")], "doc_id int, text string, x string")
    pairs = df.select(F.col("text").alias("reference"), F.col("x").alias("prediction"))
    report = _plan(evaluate.rouge_report(pairs, stem=False))
    assert "shared" in report and "array_intersect" not in report
    assert "explode" not in _plan(models.idf_table(df)) and "sort_array(split" not in _plan(models.baseline_keywords(df))
