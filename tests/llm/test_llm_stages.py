"""Stages of the corpus pipeline: nothing lost, nothing that hangs on names of columns."""

import random
import re

import numpy as np
import pytest

from lexflume.llm import chat, exact_dedup, licenses, minhash, mixing, toxicity

SCHEMA = "doc_id bigint, text string, `a.b` string, `x``y` map<string,int>, n bigint"
WORDS = {"en": "the house of", "de": "das haus von", "it": "la casa di", "fr": "une maison pour"}


def corpus(n=160, langs=("en", "de", "it", "fr")):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        lang = langs[i % len(langs)]
        text = " ".join(rng.choice([*WORDS[lang].split(), f"w{rng.randrange(300)}"]) for _ in range(40))
        rows.append((i, text, lang))
    return rows


def test_stages_keep_columns_with_odd_names(spark):
    rows = [(1, "Some words", "p", {"k": 1}, 1), (2, "some words", None, None, None), (2, "some words", "q", {"k": 2}, 2)]
    rows += [(3, "other words in here", "r", {}, 3), (None, None, "s", None, 4), (4, "", "t", None, 5)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    left = exact_dedup.drop_exact_duplicates(docs)
    assert left.columns == docs.columns
    kept = sorted((r["doc_id"] or 0, r["text"] or "") for r in left.collect())
    assert kept == [(2, "some words"), (3, "other words in here"), (4, "")]
    again = exact_dedup.drop_exact_duplicates(docs.repartition(5)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, left.collect()))
    near = minhash.drop_near_duplicates(docs, 2, 80)
    assert near.columns == docs.columns and {r["doc_id"] for r in near.collect()} == {1, 3, 4, None}
    domains = mixing.fit_domains(spark.createDataFrame([(i, t, g) for i, t, g in corpus()], "doc_id bigint, text string, domain string"))
    mixed = mixing.mixed(docs, domains, {"en": 1.0, "de": 1.0})
    assert mixed.columns == docs.columns
    assert set(map(repr, mixed.collect())) <= set(map(repr, docs.collect()))


def test_domains_without_a_weight_keep_their_share(spark):
    rows = corpus()
    labelled = spark.createDataFrame(rows, "doc_id bigint, text string, domain string")
    domains = mixing.fit_domains(labelled)
    assert domains.names == ["de", "en", "fr", "it"]
    found = mixing.mix(labelled, domains, {"en": 3.0, "de": 1.0}).collect()
    tokens = np.zeros(4)
    before = np.zeros(4)
    for r in found:
        before += r["n_tokens"] * np.array(r["posteriors"])
        tokens += r["rate"] * r["n_tokens"] * np.array(r["posteriors"])
    total = before.sum()
    assert tokens[2:] == pytest.approx(before[2:], rel=1e-3)  # fr and it
    assert tokens[1] == pytest.approx(3 * tokens[0], rel=1e-3) and tokens.sum() == pytest.approx(total, rel=1e-3)
    kept = mixing.mixed(labelled, domains, {"en": 3.0, "de": 1.0}).collect()
    assert sum(r["domain"] == "it" for r in kept) >= 38


def test_posteriors_and_rates_equal_numpy(spark):
    rows = corpus(120)
    labelled = spark.createDataFrame(rows, "doc_id bigint, text string, domain string").repartition(3)
    domains = mixing.fit_domains(labelled)
    weights = {"en": 0.4, "de": 0.3, "it": 0.2, "fr": 0.1}
    found = {r["doc_id"]: r for r in mixing.mix(labelled, domains, weights).collect()}
    absent, present = np.array(domains.absent), np.array(domains.present)
    tokens, posteriors = [], []
    for _, text, _ in rows:
        held = np.array([w in set(text.split()) for w in domains.words], float)
        logs = absent + present @ held
        p = np.exp(logs - logs.max())
        posteriors.append(p / p.sum())
        tokens.append(len(text.split()))
    p, t = np.array(posteriors), np.array(tokens, float)
    assert np.allclose([found[i]["posteriors"] for i in range(len(rows))], p, atol=1e-9)
    wanted = np.array([weights[n] for n in domains.names]) * t.sum()
    rates = np.array([found[i]["rate"] for i in range(len(rows))])
    assert (rates >= 0).all() and np.allclose((rates * t) @ p, wanted, rtol=1e-4)


def test_toxic_rows_go_and_others_stay_whole(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["nice", "day", "vile", "scum"][2 * (i % 2) :][:2]) for _ in range(9)), i % 2) for i in range(400)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, text string").repartition(4)
    labels = spark.createDataFrame([(i, 1 - x, x) for i, _, x in rows], "doc_id bigint, quality int, toxic int")
    model = toxicity.train(docs, labels)
    odd = [(1, "vile scum", "p", {"k": 1}, 1), (2, "nice day", None, None, None), (2, "nice day", "q", None, 2), (None, None, "r", None, 3)]
    odd += [(5, "", "s", None, 4), (6, "nice day " * 20_000, "t", None, 5), (7, "vile scum " * 20_000, "u", None, 6)]
    frame = spark.createDataFrame(odd, SCHEMA).repartition(2)
    left = toxicity.drop_toxic(frame, model)
    assert left.columns == frame.columns
    assert sorted((r["doc_id"] or 0, r["a.b"] or "") for r in left.collect()) == [(0, "r"), (2, ""), (2, "q"), (5, "s"), (6, "t")]
    assert toxicity.drop_toxic(frame.limit(0), model).count() == 0
    told = {r["doc_id"]: r["rejected"] for r in toxicity.severity(frame, model).collect()}
    assert told[1] and told[7] and not told[6] and not told[5]


def test_conversations_without_messages_have_no_turns(spark):
    rows = [(1, [("a", "user")]), (2, []), (3, None)]
    df = spark.createDataFrame(rows, "conv_id bigint, messages array<struct<content:string,role:string>>")
    assert [r["conv_id"] for r in chat.canonical_turns(df).collect()] == [1]


PROBES = {
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated\n"
    "documentation files (the \"Software\"), to deal in the Software without restriction",
    "apache-2.0": "# SPDX-License-Identifier: Apache-2.0",
    "gpl-2": "GNU GPL v2",
    "bsd-3": "BSD 3-Clause License",
    "cc-by": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "gpl-3": "GNU General Public License v3",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that",
    "agpl": "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3",
}


def test_license_probes(spark):
    prose = ["the terms of the day and the copy of a work in use by any person"] * 60
    texts = [*PROBES.values(), "Permission is granted to walk on the grass. Redistribution of wealth; endorse this", *prose]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    found = {r["doc_id"]: r for r in licenses.scan(df).collect()}
    for i, label in enumerate(PROBES):
        assert label in found[i]["labels"].split(","), (label, found[i])
    assert found[5]["labels"] == "gpl,gpl-3" and found[len(PROBES)]["labels"] == ""
    assert all(found[i]["labels"] == "" and found[i]["score"] == 0 for i in range(len(PROBES) + 1, len(texts)))


def test_every_mandatory_phrase_has_a_mark():
    for phrase in [*(p for _, _, p in licenses.TEMPLATES), *licenses.BASE]:
        assert any(mark in phrase for mark in licenses.MARKS), phrase
    for _, words, phrase in licenses.TEMPLATES:
        assert f" {phrase} " in f" {words} "


def test_rare_words_hold_half_of_a_template(spark):
    """A placement with half of its template's rarity holds one of the rare words, whatever the corpus."""
    rng = random.Random(2)
    idf = spark.createDataFrame([(w, rng.choice([0.01, 1.0, 5.0]) + rng.random()) for w in licenses.VOCABULARY], "word string, idf double")
    rows = licenses.postings(idf).collect()
    for t in {r["template"] for r in rows}:
        those = [r for r in rows if r["template"] == t]
        assert sum(r["idf"] for r in those if not r["rare"]) * 2 < those[0]["whole"] + 1e-9
        assert max(r["idf"] for r in those) == max(r["idf"] for r in those if r["rare"])


def test_license_base_columns_equal_brute_force(spark):
    rng = random.Random(3)
    pool = ["MIT", "License", "mit", "license", "apache", "Apache", "general", "public", "GNU", "x1", "é", "the", "-", "\n", "licensE."]
    rows = [(i, " ".join(rng.choice(pool) for _ in range(rng.randrange(40)))) for i in range(300)] + [(300, None), (301, "")]
    found = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    for i, text in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
        starts = [(k, label) for p, label in licenses.BASE.items() for k in range(len(words)) if words[k : k + len(p.split())] == p.split()]
        places = [k for k, _ in starts]
        r = found[i]
        assert (r["n_words"], r["n_base"]) == (len(words), len(starts))
        assert (r["first_word"], r["last_word"]) == ((min(places), max(places)) if places else (None, None))
        assert r["base_labels"] == ",".join(sorted({label for _, label in starts}))
        assert {label for _, label in starts} <= set(r["labels"].split(","))
