"""The first tokens of a text, against brute force and without cutting what follows them; vocabulary counts by batches."""

import re

from pyspark.sql import functions as F

from lexflume.functions import text
from lexflume.operators import sequence


def _cut(t):
    return re.findall("[a-z0-9]+", (t or "").lower())


def test_first_tokens_do_not_cut_the_rest(frame):
    df = frame([(i, t) for i, t in enumerate([None, "", "...", "x", "a.", ".a", "A b; c -d", "--a b c d e f", "é1\\n2中3", "a b" * 50])], "id int, text string")
    for n in (1, 2, 5):
        got = df.select("text", sequence._first_tokens("text", n).alias("t")).collect()
        assert all(r["t"] == _cut(r["text"])[:n] for r in got)
    parts = df.where("length(text) = 150").select(F.size(text.tokens(F.col("text"), 4)).alias("n")).first()["n"]
    assert parts == 4


def test_vocabulary_counts_do_not_explode_tokens(frame, monkeypatch):
    df = frame([(1, "a b a"), (2, None), (3, "b; C")], "doc_id int, text string")
    plans = []
    real = sequence.stored
    monkeypatch.setattr(sequence, "stored", lambda d, name: plans.append(d._jdf.queryExecution().optimizedPlan().toString()) or real(d, name))
    assert {r["token"]: (r["n"], r["id"]) for r in sequence.build_vocab(df).collect()} == {"a": (2, 2), "b": (2, 3), "c": (1, 4)}
    assert "explode" not in plans[0]
