"""License scans by a positional index of rare words.

Templates are notices and headers as word sequences with a mandatory phrase. The index holds the
postings (template, position) of each template's rarest words: the fewest whose rarity in the corpus
is more than half of all its words' rarity. A file's words are looked up there; postings of a template
that agree on the relative position are a candidate place, and a place that misses all of them cannot
reach half of the template's rarity. The mandatory phrase is verified word by word at the candidate
places, all words of the template vote, and a placement counts when half of its rarity voted.
Placements of the base phrases are counted beside it.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexflume.llm.relations import attach
from lexflume.session import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# What separates words once A-Z are lower-cased.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Every mandatory and base phrase holds a word that contains one of these, so no other text needs positions.
MARKS = ("licen", "hereby", "redistribution", "endorse", "unencumbered", "commons", "gpl")
# Base phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
_GNU = "this program is free software you can redistribute it and or modify it under the terms of the gnu"
_FSF = "general public license as published by the free software foundation either version"
_CC = "this work is licensed under a creative commons"
# Fixed values: (label, words of a usual notice or of the license's own text, mandatory phrase in it).
TEMPLATES = [
    ("mit", "released under the mit license", "mit license"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
        "permission is hereby granted free of charge to any person obtaining a copy",
    ),
    ("mit", "spdx license identifier mit", "license identifier mit"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("apache-2.0", "spdx license identifier apache 2 0", "license identifier apache 2 0"),
    ("gpl-3", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    ("gpl-3", "gnu general public license v3", "gnu general public license v3"),
    ("gpl-3", "gnu gpl v3", "gpl v3"),
    ("gpl-3", f"{_GNU} {_FSF} 3 of the license", f"gnu {_FSF} 3"),
    ("gpl-3", "spdx license identifier gpl 3 0", "license identifier gpl 3 0"),
    ("gpl-2", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    ("gpl-2", "gnu general public license v2", "gnu general public license v2"),
    ("gpl-2", "gnu gpl v2", "gpl v2"),
    ("gpl-2", f"{_GNU} {_FSF} 2 of the license", f"gnu {_FSF} 2"),
    ("gpl-2", "spdx license identifier gpl 2 0", "license identifier gpl 2 0"),
    ("lgpl", "licensed under the gnu lesser general public license", "lesser general public license"),
    ("lgpl", f"{_GNU} lesser {_FSF}", "gnu lesser general public license"),
    ("lgpl", "spdx license identifier lgpl", "license identifier lgpl"),
    ("agpl", "licensed under the gnu affero general public license", "affero general public license"),
    ("agpl", f"{_GNU} affero {_FSF}", "gnu affero general public license"),
    ("agpl", "spdx license identifier agpl", "license identifier agpl"),
    ("bsd", "licensed under the bsd license", "bsd license"),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        "redistribution and use in source and binary forms with or without modification are permitted",
    ),
    ("bsd-2", "bsd 2 clause license", "bsd 2 clause license"),
    ("bsd-2", "spdx license identifier bsd 2 clause", "license identifier bsd 2 clause"),
    ("bsd-3", "bsd 3 clause license", "bsd 3 clause license"),
    ("bsd-3", "spdx license identifier bsd 3 clause", "license identifier bsd 3 clause"),
    (
        "bsd-3",
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software",
        "may be used to endorse or promote products derived from this software",
    ),
    ("mpl", "subject to the terms of the mozilla public license", "mozilla public license"),
    ("mpl", "spdx license identifier mpl 2 0", "license identifier mpl 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "licensed under cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "licensed under cc by sa"),
    ("cc-by", "licensed under cc by 4 0", "licensed under cc by 4"),
    ("cc-by", f"{_CC} attribution 4 0 international license", "creative commons attribution 4 0"),
    ("cc-by-sa", f"{_CC} attribution sharealike 4 0 international license", "creative commons attribution sharealike"),
    ("cc-by-nc", f"{_CC} attribution noncommercial 4 0 international license", "creative commons attribution noncommercial"),
    ("unlicense", "unlicense for details see unlicense org", "unlicense"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
]
VOCABULARY = sorted({w for _, words, _ in TEMPLATES for w in words.split()} | {w for p in BASE for w in p.split()})


def _literals(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def word_hits(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, held, hits: license words of every text; place and word of each, of texts that may hold a notice."""
    text = F.coalesce(F.col("text"), F.lit(""))
    cut = docs.select(
        "doc_id",
        F.array_remove(F.split(F.translate(text, UPPER, LOWER), BETWEEN), "").alias("_words"),
        reduce(or_, [F.contains(F.lower(text), F.lit(mark)) for mark in MARKS]).alias("_marked"),
    )
    known = F.transform("_words", lambda w, i: F.when(F.array_contains(_literals(VOCABULARY), w), F.struct(i.cast("bigint").alias("at"), w.alias("word"))))
    return cut.select(
        "doc_id",
        F.size("_words").cast("bigint").alias("n_words"),
        F.array_intersect("_words", _literals(VOCABULARY)).alias("held"),
        F.when(F.col("_marked"), F.array_compact(known)).otherwise(F.array().cast("array<struct<at:bigint,word:string>>")).alias("hits"),
    )


def _places(hits: Column, word: str, back: int = 0) -> Column:
    """Places of a word, moved back."""
    return F.transform(F.filter(hits, lambda h: h["word"] == word), lambda h: h["at"] - back)


def _starts(hits: Column, phrase: str, back: int = 0) -> Column:
    """Places where the words of a phrase stand one after the other, moved back."""
    first, *rest = phrase.split()
    found = _places(hits, first, back)
    for k, word in enumerate(rest, back + 1):
        found = F.array_intersect(found, _places(hits, word, k))
    return found


def rarity(hits: DataFrame) -> DataFrame:
    """(word, idf) of the license words over all texts of ``hits``, with a notice or without; at most as many rows as the vocabulary."""
    held = hits.select(F.explode("held").alias("word"))
    total = hits.agg(F.count(F.lit(1))).scalar()
    return held.groupBy("word").agg(F.count(F.lit(1)).alias("df")).select("word", F.log((total + 1) / F.col("df")).alias("idf"))


def postings(idf: DataFrame) -> DataFrame:
    """template, label, phrase, phrase_at, in_template, word, idf, whole, rare: a row per word of every template.

    ``rare`` words are the template's rarest ones, as many as hold more than half of its rarity.
    """
    rows = [
        F.struct(
            F.lit(t).alias("template"),
            F.lit(label).alias("label"),
            _literals(words.split()).alias("words"),
            _literals(phrase.split()).alias("phrase"),
            F.lit(len(f" {words} "[: f" {words} ".index(f" {phrase} ")].split())).alias("phrase_at"),
        )
        for t, (label, words, phrase) in enumerate(TEMPLATES)
    ]
    stated = idf.sparkSession.range(1).select(F.explode(F.array(*rows)).alias("t")).select("t.*")
    each = stated.select("template", "label", "phrase", "phrase_at", F.posexplode("words").alias("in_template", "word")).join(idf, "word")
    of_template = Window.partitionBy("template")
    rarest = of_template.orderBy(F.col("idf").desc(), "in_template").rowsBetween(Window.unboundedPreceding, -1)
    whole = each.withColumns({"whole": F.sum("idf").over(of_template), "_before": F.coalesce(F.sum("idf").over(rarest), F.lit(0.0))})
    return whole.withColumn("rare", F.col("_before") * 2 <= F.col("whole")).drop("_before")


def placements(hits: DataFrame, idf: DataFrame) -> DataFrame:
    """_row, label, support: templates found by their rare words whose mandatory phrase stands at a voted place."""
    index = stored(postings(idf), "license-index")
    rare = F.broadcast(index.where("rare").select("word", "template", "in_template"))
    looked_up = hits.select("_row", F.explode("hits").alias("h")).select("_row", "h.at", "h.word").join(rare, "word")
    candidates = looked_up.groupBy("_row", "template").agg(F.collect_set(F.col("at") - F.col("in_template")).alias("places"))

    held = F.array_sort(F.collect_list(F.struct("in_template", "word", "idf"))).alias("words")
    template = index.groupBy("template", "label", "phrase", "phrase_at", "whole").agg(held)

    def agreeing(places: Column, word: Column, at: Column) -> Column:
        """Places of a template at which the word stands in the file."""
        return F.array_intersect(places, F.transform(F.filter("hits", lambda h: h["word"] == word), lambda h: h["at"] - at))

    phrase = F.transform("phrase", lambda w, k: F.struct(w.alias("word"), (F.col("phrase_at") + k).cast("bigint").alias("at")))
    verified = F.aggregate(phrase, F.col("places"), lambda places, p: agreeing(places, p["word"], p["at"]))
    standing = candidates.join(hits, "_row").join(F.broadcast(template), "template").withColumn("places", verified).where(F.size("places") > 0)
    votes = standing.select(
        "_row", "template", "label", "whole",
        F.explode(F.transform("words", lambda w: F.struct(w["idf"].alias("idf"), agreeing(F.col("places"), w["word"], w["in_template"]).alias("places")))).alias("v"),
    )
    votes = votes.select("_row", "template", "label", "whole", "v.idf", F.explode("v.places").alias("place"))
    voted = votes.groupBy("_row", "label", "template", "place", "whole").agg(F.sum("idf").alias("matched")).where("matched * 2 >= whole")
    return voted.groupBy("_row", "label").agg(F.max(F.least(F.lit(1.0), F.col("matched") / F.col("whole"))).alias("support"))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score: a row per row of ``docs``.

    Labels are the base ones and those of the verified placements; the score is the best placement's
    share of its template's rarity that voted, 1 for a base phrase without placement. Defined cases:
    a null or empty text has no words and no labels, score 0; overlapping places all count; a null
    doc_id is a row like any other; repeated rows get equal results; other columns are not read.
    """
    hits = stored(word_hits(docs).withColumn("_row", F.sha2(F.to_json("hits"), 256)), "license-hits")
    marked = hits.where(F.size("hits") > 0).drop("held")
    # files with the same words at the same places are looked up once
    shapes = stored(marked.groupBy("_row").agg(F.first("hits").alias("hits"), F.count(F.lit(1)).alias("_n")), "license-shapes")
    found = placements(shapes.select("_row", "hits"), rarity(hits))
    by_row = found.groupBy("_row").agg(F.collect_set("label").alias("_found"), F.max("support").alias("_support"))
    labelled = stored(shapes.select("_row", "_n").join(by_row, "_row"), "license-labels")
    joined = attach(marked, labelled, "_row", "_n", "doc_id").unionByName(
        hits.where(F.size("hits") == 0).drop("held"), allowMissingColumns=True
    )
    places = {p: _starts(F.col("hits"), p) for p in BASE}
    labels = F.array_compact(F.array(*[F.when(F.size(s) > 0, F.lit(BASE[p])) for p, s in places.items()]))
    based = joined.select(
        "doc_id", "n_words", F.concat(*places.values()).alias("_places"), labels.alias("_base"),
        F.coalesce("_found", F.array().cast("array<string>")).alias("_found"), "_support",
    )
    return based.select(
        "doc_id",
        "n_words",
        F.size("_places").cast("bigint").alias("n_base"),
        F.array_min("_places").alias("first_word"),
        F.array_max("_places").alias("last_word"),
        F.array_join(F.array_sort("_base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("_base", "_found")), ",").alias("labels"),
        F.coalesce("_support", F.when(F.size("_base") > 0, F.lit(1.0)).otherwise(F.lit(0.0))).alias("score"),
    )
