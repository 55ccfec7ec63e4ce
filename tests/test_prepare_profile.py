import hashlib
import math

import numpy as np
import pytest

from lexflume.operators import prepare, profile


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_map_labels(frame):
    df = frame([(i,) for i in (0, 1, 2, 3, 4, 5, 6, None)], "raw_label int")
    found = dict(rows(prepare.map_labels(df), "raw_label", "label"))
    assert found == {0: 0, 1: 2, 2: 2, 3: 0, 4: 0, 5: 1, 6: None, None: None}


def test_strict_mapping_fails_on_an_unknown_label(frame):
    ok = frame([(1,)], "raw_label int")
    assert prepare.map_labels(ok, strict=True).first()["label"] == 2
    with pytest.raises(Exception, match="label without a mapping: 9"):
        prepare.map_labels(frame([(9,)], "raw_label int"), strict=True).collect()


def test_pick_keyphrases_takes_the_first_present_column(frame):
    df = frame([(1, [], ["x"]), (2, None, ["y"]), (3, ["a", "b"], ["z"])], "id int, keyphrases array<string>, keywords array<string>")
    assert rows(prepare.pick_keyphrases(df), "id", "keywords_str") == [(1, ""), (2, ""), (3, "a; b")]
    assert rows(prepare.pick_keyphrases(df.drop("keyphrases")), "id", "keywords_str") == [(1, "x"), (2, "y"), (3, "z")]
    assert rows(prepare.pick_keyphrases(df.select("id")), "id", "keywords_str") == [(1, ""), (2, ""), (3, "")]


def test_select_present(frame):
    df = frame([(1, 2)], "a int, b int")
    assert prepare.select_present(df, ["b", "c", "a"]).columns == ["b", "a"]


def test_assign_split_follows_the_key_only(frame):
    df = frame([(i,) for i in range(2000)], "id int")
    split = rows(prepare.assign_split(df, "id"), "id", "split")
    assert split == rows(prepare.assign_split(df.repartition(7), "id"), "id", "split")
    for i, s in split[:50]:
        bucket = int(hashlib.md5(f"42:{i}".encode()).hexdigest()[:8], 16) % 100
        assert s == ("train" if bucket < 80 else "val" if bucket < 90 else "test")
    shares = {s: sum(x == s for _, x in split) / 2000 for s in ("train", "val", "test")}
    assert abs(shares["train"] - 0.8) < 0.05 and abs(shares["val"] - 0.1) < 0.03
    with pytest.raises(ValueError):
        prepare.assign_split(df, "id", {"train": 80, "test": 10})


def test_union_splits(frame):
    a, b = frame([(1,)], "x int"), frame([(2,), (3,)], "x int")
    assert rows(prepare.union_splits({"train": a, "test": b}), "x", "split") == [(1, "train"), (2, "test"), (3, "test")]


SENT = [
    (1, "a b c", "positive", "train"),
    (2, None, "positive", "train"),
    (3, "a", "negative", "train"),
    (4, "a b c", None, "val"),
    (5, "", "negative", "test"),
]


@pytest.fixture()
def sent(frame):
    return frame(SENT, "id int, text string, label_name string, split string")


def test_counts(sent):
    assert rows(profile.split_counts(sent), "split", "n") == [("test", 1), ("total", 5), ("train", 3), ("val", 1)]
    assert [tuple(r) for r in profile.class_counts(sent).collect()] == [("test", "negative", 1), ("train", "positive", 2), ("train", "negative", 1)]
    assert rows(profile.class_balance(sent), "split", "label_name", "share") == [
        ("test", "negative", 1.0),
        ("train", "negative", pytest.approx(1 / 3)),
        ("train", "positive", pytest.approx(2 / 3)),
    ]
    assert [r[0] for r in profile.distinct_classes(sent).collect()] == ["negative", "positive"]


def test_null_is_one_value_among_duplicates(frame):
    df = frame([("a",), ("a",), (None,), (None,), (None,), ("b",)], "t string")
    assert tuple(profile.duplicate_count(df, "t").first()) == (6, 3)
    assert tuple(profile.duplicate_count(df.where("t = 'q'"), "t").first()) == (0, 0)


def test_missing_counts_null_and_nan(frame):
    df = frame([(1, 1.0, "x"), (None, float("nan"), None), (3, None, "")], "a int, b double, c string")
    assert rows(profile.missing_by_column(df), "column_name", "n_missing") == [("a", 1), ("b", 2), ("c", 1)]


def test_length_summary_leaves_missing_lengths_out(frame):
    df = frame([(3,), (None,), (1,), (10,), (2,)], "n int")
    row = profile.length_summary(df, "n").first()
    assert (row["mean"], row["median"], row["min"], row["max"], row["n"]) == (4.0, 2.5, 1, 10, 4)


@pytest.mark.parametrize("kind", ["int", "double"])
@pytest.mark.parametrize("values", [[5, 5, 5], [0, 1, 2, 3, 4, 10], [1, None, 2], list(range(100))])
def test_histogram_is_numpys(frame, values, kind):
    cast = {"int": int, "double": float}[kind]
    df = frame([(None if v is None else cast(v),) for v in values], f"v {kind}")
    found = sorted(profile.histogram(df, "v", 7).collect(), key=lambda r: r["bin"])
    counts, edges = np.histogram([v for v in values if v is not None], bins=7)
    assert [r["n"] for r in found] == counts.tolist()
    assert [r["bin_start"] for r in found] == pytest.approx(edges[:-1].tolist())
    assert sum(r["n"] for r in found) == sum(v is not None for v in values)


def test_box_stats(frame):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 100.0]
    df = frame([("a", v) for v in values] + [("b", 4.0), ("b", None), (None, 1.0), (None, 3.0)], "g string, v double")
    found = {r["g"]: r for r in profile.box_stats(df, "v", ["g"]).collect()}
    a = found["a"]
    assert (a["q1"], a["median"], a["q3"]) == (3.0, 5.0, 7.0)
    assert (a["whisker_low"], a["whisker_high"], a["outliers"], a["n"]) == (1.0, 8.0, 1, 9)
    assert tuple(found["b"])[1:] == (4.0, 4.0, 4.0, 4.0, 4.0, 0, 1)
    assert found[None]["median"] == 2.0


def test_sample_per_class(frame):
    df = frame([(i, "big" if i % 10 else "small") for i in range(300)] + [(999, None)], "id int, label_name string")
    sample = rows(profile.sample_per_class(df, "id", n=3), "label_name", "id")
    assert [c for c, _ in sample] == ["big"] * 3 + ["small"] * 3
    assert sample == rows(profile.sample_per_class(df.repartition(9), "id", n=3), "label_name", "id")


def test_keyword_profile(frame):
    df = frame([(1, "a b", ["x"]), (2, "a b", ["y"]), (3, "a", []), (4, None, ["p", "q"])], "id int, document string, keywords_list array<string>")
    stats = profile.keyword_stats(df).first()
    assert tuple(stats) == (4, 1.0, 0, 2, pytest.approx(5 / 3))
    assert rows(profile.length_vs_keywords(df), "doc_length", "num_keywords", "n") == [(1, 0, 1), (2, 1, 2), (None, 2, 1)]
    assert profile.sample_documents(df, "id").count() == 3


def test_eda_summary_and_its_file(spark, sent, frame, tmp_path):
    keys = frame([("a b", ["x"], "train"), ("a", [], "val")], "document string, keywords_list array<string>, split string")
    profile.write_eda_summary(sent, keys, str(tmp_path / "eda"))
    record = profile.eda_summary(sent, keys).first()
    assert record["sentiment"].asDict() == {
        "total_samples": 5,
        "train_samples": 3,
        "val_samples": 1,
        "test_samples": 1,
        "classes": ["negative", "positive"],
        "avg_text_length": 2.0,
        "class_distribution": {"negative": 1, "positive": 2},
    }
    assert record["keyword"]["avg_keywords"] == 1.0 and record["keyword"]["test_samples"] == 0
    stored = spark.read.json(str(tmp_path / "eda")).first()
    assert stored["sentiment"]["class_distribution"]["positive"] == 2


def test_one_row_group(frame):
    row = profile.length_summary(frame([("a", 3)], "g string, n int"), "n", ["g"]).first()
    assert row["median"] == 3.0 and not math.isnan(row["mean"])
