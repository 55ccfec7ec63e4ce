import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexflume.operators import models, sequence
from lexflume.operators.keyed import KeyedTable
from lexflume.session import stored

DOCS = [(1, "The cat. The dog!"), (2, "the end"), (3, "..."), (4, None), (5, " ".join(f"w{i}" for i in range(40)))]


@pytest.fixture()
def docs(frame):
    return frame(DOCS, "doc_id int, text string")


def test_vocab(docs):
    found = sorted(sequence.build_vocab(docs).collect(), key=lambda r: r["id"])
    assert [r["id"] for r in found] == list(range(2, len(found) + 2))
    assert (found[0]["token"], found[0]["n"]) == ("the", 3)
    assert [r["token"] for r in found[1:]] == sorted(r["token"] for r in found[1:])
    assert [r["token"] for r in sequence.build_vocab(docs, min_count=2).collect()] == ["the"]


# A dictionary in every task, a join, a join whose frequent keys are dealt over parts.
LIMITS = [{}, {"whole_rows": 0}, {"whole_rows": 0, "part_rows": 2}]


@pytest.mark.parametrize("limits", LIMITS)
def test_encode(docs, limits):
    vocab = KeyedTable(sequence.build_vocab(docs.where("doc_id < 3")), "token", **limits)
    ids = {r["token"]: r["id"] for r in vocab.rows.collect()}
    found = {r["doc_id"]: r for r in sequence.encode(docs, vocab, 6).collect()}
    assert set(found) == {1, 2, 3, 4, 5}
    assert found[1]["input_ids"] == [ids["the"], ids["cat"], ids["the"], ids["dog"], 0, 0]
    assert found[1]["attention_mask"] == [1, 1, 1, 1, 0, 0]
    assert found[3]["input_ids"] == found[4]["input_ids"] == [0] * 6
    assert found[5]["input_ids"] == [1] * 6 and found[5]["attention_mask"] == [1] * 6


@pytest.mark.parametrize("limits", LIMITS)
def test_rows_with_equal_and_null_keys_stay_apart(frame, limits):
    rows = [(1, "a b"), (1, "a b"), (1, "b"), (None, "a"), (None, "a"), (None, None), (None, "")] + [(2, "hot")] * 60
    df = frame(rows, "k int, text string")
    vocab = KeyedTable(stored(sequence.build_vocab(df.where("text <> 'hot'")), "vocab"), "token", **limits)
    ids = {r["token"]: r["id"] for r in vocab.rows.collect()}
    expected = Counter()
    for k, text in rows:
        found = [ids.get(t, 1) for t in (text or "").split()]
        expected[k, tuple(found + [0] * (3 - len(found))), tuple([1] * len(found) + [0] * (3 - len(found)))] += 1
    coded = sequence.encode(df, vocab, 3, key="k")
    assert Counter((r["k"], tuple(r["input_ids"]), tuple(r["attention_mask"])) for r in coded.collect()) == expected
    idf = models.Idf.of(stored(models.idf_table(df), "idf"), **limits)
    ranked = Counter((r["k"], r["rank"], r["term"]) for r in models.extract_keywords(df, 2, idf, key="k").collect())
    assert ranked[1, 1, "b"] == 3 and ranked[1, 2, "a"] == 2
    assert ranked[None, 1, "a"] == 2 and ranked[2, 1, "hot"] == 60 and ranked.total() == 67


def test_encode_moves_nothing_with_a_small_vocabulary(docs):
    vocab = KeyedTable(stored(sequence.build_vocab(docs), "vocab"), "token")
    idf = models.Idf.of(stored(models.idf_table(docs), "idf"))
    rows = docs.sparkSession.createDataFrame(DOCS, "doc_id int, text string")
    for df in (sequence.encode(rows, vocab, 6), models.extract_keywords(rows, 3, idf)):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in text and "Join" not in text and "ArrowEvalPython" in text


def test_records(docs):
    vocab = sequence.build_vocab(docs)
    both = docs.withColumn("keywords_str", F.lit("cat; zebra"))
    found = {r["doc_id"]: r for r in sequence.encode_records(both, vocab, document="text").collect()}
    assert {len(r["input_ids"]) for r in found.values()} == {512} and {len(r["labels"]) for r in found.values()} == {64}
    assert found[1]["labels"][1:3] == [1, -100] and found[1]["labels"][0] > 1 and sum(found[1]["attention_mask"]) == 4
    assert sum(found[4]["attention_mask"]) == 0


def test_encode_keeps_columns(frame):
    df = frame([(1, "a b", 2)], "doc_id int, text string, label int")
    row = sequence.encode(df, sequence.build_vocab(df), 3, keep=["label"]).first()
    assert (row["label"], row["input_ids"]) == (2, [2, 3, 0])


def test_target_keeps_unknown_apart_from_padding(docs):
    vocab = sequence.build_vocab(docs.where("doc_id = 2"))
    found = {r["doc_id"]: r["labels"] for r in sequence.encode_target(docs, vocab, 5, text="text").collect()}
    the = {r["token"]: r["id"] for r in vocab.collect()}["the"]
    assert found[1] == [the, 1, the, 1, -100] and found[3] == [-100] * 5


def test_decoded_target_is_the_text(docs):
    vocab = stored(sequence.build_vocab(docs), "vocab")
    labels = sequence.encode_target(docs, vocab, 50, text="text")
    found = dict(tuple(r) for r in sequence.decode_target(labels, vocab).collect())
    assert found == {1: "the cat the dog", 2: "the end", 3: "", 4: "", 5: DOCS[4][1]}


@pytest.mark.parametrize("shuffle", [True, False])
def test_batches(frame, shuffle):
    df = frame([(i,) for i in range(103)], "id int", 4)
    found = sequence.shuffle_and_batch(df, "id", 16, shuffle=shuffle).collect()
    sizes = Counter(r["batch_id"] for r in found)
    assert [sizes[b] for b in sorted(sizes)] == [16] * 6 + [7]
    again = sequence.shuffle_and_batch(df.repartition(9), "id", 16, shuffle=shuffle).collect()
    assert sorted(found) == sorted(again)
    if not shuffle:
        assert [r["id"] for r in sorted(found, key=lambda r: r["position"])] == list(range(103))
    else:
        other = sequence.shuffle_and_batch(df, "id", 16, seed=7).collect()
        assert sorted(found) != sorted(other)


def tf_idf(rows, k):
    """Brute force over (id, tokens)."""
    n = len(rows)
    freq = Counter(t for _, toks in rows for t in set(toks))
    out = []
    for i, toks in rows:
        scored = [(round(c * math.log((n + 1) / (freq[t] + 1)), 6), t) for t, c in Counter(toks).items()]
        out += [(i, r + 1, t, s) for r, (s, t) in enumerate(sorted(scored, key=lambda x: (-x[0], x[1]))[:k])]
    return out


@pytest.fixture()
def corpus(frame):
    """One term in every document, one in a third of them, many rare ones."""
    rng = random.Random(9)
    rows = []
    for i in range(120):
        toks = ["everywhere"] + ["third"] * (i % 3 == 0) * 4 + [f"r{rng.randint(0, 300)}" for _ in range(rng.randint(0, 15))]
        rows.append((i, toks))
    return rows, frame([(i, " ".join(t)) for i, t in rows], "doc_id int, text string", 5)


@pytest.mark.parametrize("limits", LIMITS)
def test_keywords_against_brute_force(corpus, limits):
    rows, df = corpus
    found = [tuple(r) for r in models.extract_keywords(df, 5).collect()]
    assert sorted(found) == sorted(tf_idf(rows, 5))
    idf = models.Idf.of(stored(models.idf_table(df), "idf"), **limits)
    by_table = [tuple(r) for r in models.extract_keywords(df, 5, idf).collect()]
    assert sorted(by_table) == sorted(found)


def test_unknown_terms_get_the_idf_of_no_document(corpus, frame):
    _, df = corpus
    row = models.extract_keywords(frame([(1, "neverseen")], "doc_id int, text string"), 1, models.idf_table(df)).first()
    assert row["score"] == pytest.approx(round(math.log(121), 6))


def test_baseline_keywords(corpus):
    rows, df = corpus
    expected = []
    for i, toks in rows:
        top = sorted(Counter(toks).items(), key=lambda x: (-x[1], x[0]))[:3]
        expected += [(i, r + 1, t, float(c)) for r, (t, c) in enumerate(top)]
    assert sorted(tuple(r) for r in models.baseline_keywords(df, 3).collect()) == sorted(expected)


def test_baseline_classifier(frame):
    train = frame([(2,), (2,), (0,), (0,), (None,)], "label int")
    row = models.baseline_classifier(train, frame([(1,)], "id int")).first()
    assert (row["pred"], row["probabilities"]) == (0, [0.5, 0.0, 0.5])


@pytest.fixture(scope="module")
def labelled(frame):
    rng = random.Random(10)
    words = {0: ["awful", "bad", "sad"], 1: ["plain", "table", "paper"], 2: ["great", "lovely", "happy"]}
    rows = []
    for i in range(240):
        c = 0 if i % 3 else rng.choice([1, 2])
        rows.append((i, " ".join(rng.choice(words[c] + ["the", "a"]) for _ in range(8)), c))
    return frame(rows, "doc_id int, text string, label int")


def test_classifier_beats_the_baseline_and_repeats_itself(labelled):
    train, val = labelled.where("doc_id < 180"), labelled.where("doc_id >= 180")
    answers = []
    for _ in range(2):
        model = models.train_classifier(train, val, max_iter=10)
        scored = models.score_classifier(labelled, model)
        pred = scored.select("doc_id", "label", (F.array_position("logits", F.array_max("logits")) - 1).alias("pred"))
        answers.append(sorted(tuple(r) for r in pred.collect()))
    assert answers[0] == answers[1]
    right = sum(label == pred for _, label, pred in answers[0])
    base = models.baseline_classifier(train, labelled)
    assert right > base.where("label = pred").count() and right > 0.95 * 240


def test_class_never_trained_on_gets_no_probability(labelled):
    two = labelled.where("label < 2")
    model = models.train_classifier(two, two, grid=(0.1,), max_iter=5)
    row = models.score_classifier(labelled.limit(1), model).first()
    assert len(row["logits"]) == 3 and row["logits"][2] == float("-inf")
