"""What travels, is remembered and is computed once in tasks of the pipeline operators."""

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from lexflume.llm import bpe, lm, minhash
from lexflume.session import BATCH_CONF


@pytest.fixture(scope="module")
def coder():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        return bpe.Bpe(f.read())


def test_words_of_two_generations_are_remembered(coder, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 50)
    for turn in range(20):
        coder.encode_batch([" ".join(f"w{chr(97 + turn)}{chr(97 + i)}" for i in range(26)) + " often"])
        assert len(coder.known) + len(coder.older) <= 4 * (50 + 30)
    walked = []
    monkeypatch.setattr(coder, "encode_words", lambda found: walked.extend(found) or {})
    coder.encode_batch([" often"] * 3)
    assert walked == []


def test_rows_are_decoded_together_as_one_by_one(coder):
    texts = ["", "a b", "naïve Ünïcode 漢字\n\n", "", "<|endoftext|> x", "  \t 12345"]
    rows = coder.encode_batch(texts)
    rows += [rows[2][:-8], rows[2][4:]]  # cut within a character
    assert coder.decode_batch(rows) == [coder.decode(r) for r in rows]
    assert coder.decode_batch([]) == [] and coder.decode_batch([b""]) == [""]


def test_a_context_is_normalised_once(monkeypatch):
    model = lm.Bilinear.fresh(np.log(np.full(lm.CLASSES, 1 / lm.CLASSES)))
    made = []
    predicted = lm.Bilinear.predicted
    monkeypatch.setattr(lm.Bilinear, "predicted", lambda self, before: made.append(len(before)) or predicted(self, before))
    before = np.array([[3, 7], [7, 3], [3, 7], [lm.CLASSES, lm.CLASSES]])
    first, again = model.log_norms(before), model.log_norms(before[::-1])
    assert sum(made) == 3 and first[0] == first[2] and again.tolist() == first[::-1].tolist()
    for row, norm in zip(before, first, strict=True):
        scores = predicted(model, row[None]) @ model.target.T + model.bias
        assert norm == pytest.approx(np.log(np.exp(scores).sum()), abs=1e-5)


def test_whole_sets_and_sketches_travel_once(frame, monkeypatch):
    plans, stored = {}, minhash.stored

    def noted(df, name):
        plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString())
        return stored(df, name)

    monkeypatch.setattr(minhash, "stored", noted)
    shared = " ".join(f"s{i}" for i in range(60))
    docs = frame([(i, f"{shared} t{i}") for i in range(6)], "doc_id long, text string")
    assert {r["component_id"] for r in minhash.near_duplicates(docs, 2).collect()} == {0}
    exchanges = {k: [x for x in v.splitlines() if "Exchange" in x and "Broadcast" not in x] for k, v in plans.items()}
    assert not any("hashpartitioning(node" in x for x in exchanges["members"])
    assert len(exchanges["nodes"]) == 1


def test_stages_hand_small_batches_and_keep_smaller_ones(spark, frame, monkeypatch):
    monkeypatch.setattr(corpus_pipeline.bpe, "round_trip", lambda docs, vocabulary: docs)
    before = spark.conf.get(BATCH_CONF)
    try:
        for held, wanted in (("10000", "1000"), ("0", "1000"), ("7", "7")):
            spark.conf.set(BATCH_CONF, held)
            corpus_pipeline.as_tokens(spark, None, "")
            assert spark.conf.get(BATCH_CONF) == wanted
    finally:
        spark.conf.set(BATCH_CONF, before)
