"""Nulls, empty and long texts, ties, repeated rows, empty tables and extra columns, on small frames."""

import hashlib
import math

import public_tokenizers
import pytest

from lexflume.llm import bpe, chat, embedding_dedup, exact_dedup, langid, licenses, lm, minhash, mixing, toxicity

SCHEMA = "doc_id bigint, text string, kept string, _row string, n bigint"
LONG = "lang wort " * 20_000
ROWS = [
    (1, "Same TEXT here", "x", "y", 1),
    (2, "same text HERE", "x", "y", 2),
    (2, "same text here", "x", "y", 2),
    (3, None, None, None, None),
    (4, "", "x", "y", 4),
    (5, "   ", "x", "y", 5),
    (None, "no id at all", "x", "y", 6),
    (7, LONG, "x", "y", 7),
    (8, "released under the MIT License. mit license", "x", "y", 8),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_exact(docs, none):
    found = exact_dedup.exact_duplicates(docs).collect()
    assert len(found) == len(ROWS)
    assert {(r["doc_id"], r["keep_id"], r["group_size"]) for r in found if r["doc_id"] in (1, 2, 3, 4)} == {
        (1, 2, 3), (2, 2, 3), (3, 4, 2), (4, 4, 2)
    }
    left = exact_dedup.drop_exact_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in left.collect()) == [0, 2, 4, 5, 7, 8]
    assert exact_dedup.exact_duplicates(none).count() == 0


def test_near(docs, none):
    found = minhash.near_duplicates(docs, 2).collect()
    assert len(found) == len(ROWS)
    ids = {(r["doc_id"], r["component_id"], r["n_shingles"]) for r in found}
    assert {(1, 1, 2), (2, 1, 2), (3, 3, 0), (4, 4, 0), (5, 5, 0), (None, None, 3), (7, 7, 2)} <= ids
    assert minhash.near_duplicates(none, 2).count() == 0


def test_bpe(docs, none):
    path = public_tokenizers.path("byte_bpe_50k.json")
    found = by_id(bpe.round_trip(docs, path))
    assert found[3]["n_tokens"] == 0 and found[4]["n_tokens"] == 0
    assert found[7]["decoded_sha256"] == hashlib.sha256(LONG.encode()).hexdigest()
    back = {r["doc_id"]: r["text"] for r in bpe.decode(bpe.encode(docs, path), path).collect()}
    assert back[8] == ROWS[8][1]
    assert bpe.round_trip(none, path).count() == 0


def test_language(docs, none):
    names, vectors = langid.prototypes(docs.selectExpr("text", "CASE WHEN doc_id = 7 THEN 'de' ELSE 'en' END AS lang"))
    found = by_id(langid.identify(docs, names, vectors))
    assert [found[i]["lang_pred"] for i in (3, 4, 5, 7, 8)] == ["und", "und", "und", "de", "en"]
    assert langid.prototypes(none.selectExpr("text", "text AS lang"))[0] == []


def test_licenses(docs, none):
    found = by_id(licenses.scan(docs))
    assert (found[8]["n_base"], found[8]["first_word"], found[8]["last_word"]) == (2, 3, 5)
    assert found[8]["labels"] == "mit" and found[8]["score"] > 0
    assert (found[3]["n_words"], found[3]["first_word"], found[3]["labels"], found[3]["score"]) == (0, None, "", 0.0)
    assert licenses.scan(none).count() == 0


def test_licenses_of_a_file_with_many_notices(spark):
    notices = {label: words for label, words, _ in licenses.TEMPLATES}
    held = [["mit", "apache-2.0", "gpl-3", "cc-by-nc"], ["apache-2.0", "gpl-3"], ["gpl-3", "cc-by-nc"], list(notices)]
    texts = [" and ".join(notices[n] for n in names) for names in held] + ["the terms of the day " * 3] * 40
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = by_id(licenses.scan(frame))
    for i, names in enumerate(held):
        assert set(names) <= set(found[i]["labels"].split(",")) and found[i]["score"] == pytest.approx(1)


def test_rarity_counts_texts_without_a_notice(spark):
    texts = ["Released under the MIT License"] * 2 + ["by the sea", "THE end", "the, the", None, "nothing"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").selectExpr("1L AS doc_id", "text")
    found = {r["word"]: r["idf"] for r in licenses.rarity(licenses.word_hits(frame)).collect()}
    df = {"the": 5, "by": 1, "mit": 2, "released": 2, "under": 2, "license": 2}
    assert found == pytest.approx({w: math.log((len(texts) + 1) / n) for w, n in df.items()})


def test_toxicity(spark, docs, none):
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 1)], "doc_id bigint, toxic int")
    model = toxicity.train(docs, labels)
    assert toxicity.drop_toxic(none, model).columns == none.columns
    calm = toxicity.train(docs, labels.where("toxic = 0"))
    assert toxicity.drop_toxic(docs, calm).count() == len(ROWS)
    assert toxicity.severity(docs, calm).where("rejected").count() == 0


def test_mixing_meets_targets(spark, none):
    rows = [(i, ("der hund " if i % 3 else "the dog ") * (i % 7 + 1), "a", "b", i) for i in range(300)]
    docs = spark.createDataFrame(rows, SCHEMA)
    labelled = docs.selectExpr("doc_id", "text", "CASE WHEN text LIKE 'der%' THEN 'de' ELSE 'en' END AS domain")
    domains = mixing.fit_domains(labelled)
    found = mixing.mix(docs, domains, {"de": 0.5, "en": 0.5}).collect()
    total = sum(r["n_tokens"] for r in found)
    for d in range(2):
        assert sum(r["n_tokens"] * r["rate"] * r["posteriors"][d] for r in found) == pytest.approx(total / 2, rel=1e-4)
    drawn = mixing.mixed(docs, domains, {"de": 0.5, "en": 0.5})
    assert drawn.columns == docs.columns and drawn.count() == sum(r["copies"] for r in found)
    assert mixing.mix(none, domains, {"de": 1.0}).count() == 0


def test_chat_round_trip(spark):
    text = "</s>[INST] \\l [/TURN] <ok>\n"
    turns = spark.createDataFrame(
        [(1, 0, "user", text), (1, 1, "assistant", text), (1, 1, "assistant", None), (None, 0, None, "x")],
        "conv_id bigint, turn bigint, role string, text string",
    )
    whole = chat.formatted(chat.canonical_turns(turns))
    found = {r["conv_id"]: r for r in whole.select("conv_id", chat.read_turns(whole.formatted).alias("t"),
                                                   chat.read_loss(whole.formatted, whole.loss_spans).alias("l")).collect()}
    assert [tuple(t) for t in found[1]["t"]] == [("user", text), ("assistant", ""), ("assistant", text)]
    assert found[1]["l"] == text and found[None]["l"] == ""


def test_chat_layouts(spark):
    nested = spark.sql("SELECT 1L AS conv_id, array(named_struct('from', 'human', 'value', 'hi')) AS conversations")
    asked = spark.sql("SELECT 1L AS conv_id, 'add' AS instruction, '1 2' AS input, '3' AS output, 'z' AS extra")
    assert [tuple(r) for r in chat.canonical_turns(nested).collect()] == [(1, 0, "user", "hi")]
    assert [r["text"] for r in chat.canonical_turns(asked).orderBy("turn").collect()] == ["add\n\n1 2", "3"]
    with pytest.raises(ValueError):
        chat.canonical_turns(spark.sql("SELECT 1 AS unknown"))


def test_language_model(docs, none):
    found = lm.score(docs).collect()
    assert len(found) == len(ROWS) and all(r["score"] < 0 and r["base_score"] < 0 for r in found)
    assert {r["n_tokens"] for r in found if r["doc_id"] in (3, 4, 5)} == {1}
    assert lm.score(none).count() == 0


def test_embeddings(spark):
    rows = [(1, [1.0, 0.0], 0), (2, [2.0, 0.1], 0), (3, [1.0, 0.0], 1), (4, [0.0, 0.0], 0), (5, None, 0),
            (6, [float("nan"), 1.0], 0), (7, [1.0, 0.0], None), (1, [1.0, 0.0], 0), (None, [1.0, 0.0], 0)]
    schema = "vec_id bigint, embedding array<float>, label int"
    found = embedding_dedup.near_duplicates(spark.createDataFrame(rows, schema)).collect()
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in found}
    assert got == {1: (1, 1, True), 2: (1, 1, False), **{i: (0, i, True) for i in (3, 4, 5, 6, 7)}, None: (0, None, True)}
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], schema)).count() == 0


def test_embeddings_of_labels_with_a_hash_sign(spark):
    rows = [(1, [1.0, 0.0], "a#b"), (2, [2.0, 0.1], "a#b"), (3, [1.0, 0.0], "a#1"), (4, [1.0, 0.0], "a"), (5, [1.0, 0.0], "a#1")]
    found = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label string"))
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in found.collect()} == {1: (1, 1), 2: (1, 1), 3: (1, 3), 4: (0, 4), 5: (1, 3)}
