import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexflume.operators import evaluate, history, report, scoring
from test_functions import lcs_by_table


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


@pytest.fixture()
def judged(frame):
    rng = random.Random(7)
    data = [(run, rng.choice([0, 0, 0, 1, 2]), rng.choice([0, 1, 2])) for run in ("a", "b") for _ in range(200)]
    data += [("c", 0, 0), ("c", 0, 0), ("c", 1, 0)]
    return frame(data, "run_id string, label int, pred int")


def test_grid_is_full_and_adds_up(judged):
    conf = evaluate.confusion(judged, ["run_id"])
    assert conf.count() == 27
    assert rows(conf.groupBy("run_id").agg(F.sum("n").alias("n")), "run_id", "n") == [("a", 200), ("b", 200), ("c", 3)]
    assert evaluate.confusion(judged).count() == 9
    assert evaluate.confusion(judged.where("label = 7")).agg(F.sum("n")).first()[0] == 0


def test_metrics_against_their_definitions(judged):
    metrics = {r["run_id"]: r for r in evaluate.classification_metrics(evaluate.confusion(judged, ["run_id"]), ["run_id"]).collect()}
    for run in ("a", "b", "c"):
        pairs = [(r["label"], r["pred"]) for r in judged.where(F.col("run_id") == run).collect()]
        p, rec, f1, sup = {}, {}, {}, {}
        for c in (0, 1, 2):
            tp = sum(t == c and g == c for t, g in pairs)
            truth, guess = sum(t == c for t, _ in pairs), sum(g == c for _, g in pairs)
            p[c], rec[c], sup[c] = (tp / guess if guess else 0), (tp / truth if truth else 0), truth
            f1[c] = 2 * p[c] * rec[c] / (p[c] + rec[c]) if p[c] + rec[c] else 0
        seen = {x for pair in pairs for x in pair}
        m = metrics[run]
        assert m["accuracy"] == pytest.approx(sum(t == g for t, g in pairs) / len(pairs))
        assert m["f1_macro"] == pytest.approx(np.mean([f1[c] for c in seen]))
        assert m["precision"] == pytest.approx(np.mean([p[c] for c in seen]))
        assert m["recall"] == pytest.approx(np.mean([rec[c] for c in seen]))
        assert m["f1_weighted"] == pytest.approx(sum(f1[c] * sup[c] for c in f1) / len(pairs))
        assert (m["f1_negative"], m["f1_neutral"], m["f1_positive"]) == pytest.approx((f1[0], f1[1], f1[2]))
        # weighted recall is accuracy
        assert sum(rec[c] * sup[c] for c in rec) / len(pairs) == pytest.approx(m["accuracy"])


def test_single_metrics_agree_with_the_record(judged):
    conf = evaluate.confusion(judged)
    whole = evaluate.classification_metrics(conf).first()
    assert evaluate.accuracy(conf).first()["accuracy"] == pytest.approx(whole["accuracy"])
    assert evaluate.macro(conf).first()["f1_macro"] == pytest.approx(whole["f1_macro"])
    assert evaluate.weighted_f1(conf).first()["f1_weighted"] == pytest.approx(whole["f1_weighted"])


def test_confusion_matrix(frame):
    df = frame([(0, 0), (0, 1), (1, 2), (0, 5), (0, None)], "label int, pred int")
    assert rows(evaluate.confusion_matrix(df), "true_label", "pred_negative", "pred_neutral", "pred_positive", "pred_other") == [
        ("negative", 1, 1, 0, 2), ("neutral", 0, 0, 1, 0), ("positive", 0, 0, 0, 0),
    ]


def test_latency_weighs_batches_not_rows(frame):
    batches = [("r", 0.4, 16), ("r", 0.8, 16), ("r", 0.1, 1), ("s", 1.0, 4)]
    found = {r["run"]: r for r in evaluate.latency(frame(batches, "run string, batch_seconds double, batch_n int"), ["run"]).collect()}
    per_row = [0.4 / 16, 0.8 / 16, 0.1]
    assert found["r"]["mean_latency_ms"] == pytest.approx(np.mean(per_row) * 1000)
    assert found["r"]["p95_latency_ms"] == pytest.approx(np.percentile(per_row, 95) * 1000)
    assert found["s"]["p95_latency_ms"] == pytest.approx(250)


def test_latency_leaves_out_empty_batches_and_missing_times(frame):
    batches = [("r", 0.4, 16), ("r", 0.8, 0), ("r", float("nan"), 4), ("r", None, 4)]
    row = evaluate.latency(frame(batches, "run string, batch_seconds double, batch_n int"), ["run"]).first()
    assert (row["mean_latency_ms"], row["p95_latency_ms"]) == (pytest.approx(25), pytest.approx(25))


def test_two_records_of_a_run_are_not_compared(frame):
    records = [("base", "sentiment", 0.5), ("tuned", "sentiment", 0.9), ("tuned", "sentiment", 0.6)]
    df = frame(records, "run_id string, task string, accuracy double")
    with pytest.raises(Exception, match="several records of run tuned"):
        report.compare_runs(df, "base", "tuned").collect()
    assert report.compare_runs(df.where("accuracy <> 0.6"), "base", "tuned").first()["difference"] == pytest.approx(0.4)


def test_references(frame):
    refs = [(1, " a -100"), (2, "-100 -100"), (3, ""), (4, "b"), (5, None)]
    df = frame(refs, "id int, reference string")
    assert rows(evaluate.clean_references(df), "id", "reference") == [(1, "a"), (4, "b")]
    assert rows(evaluate.first_n(df, 1, "id"), "id", "reference") == [(1, "a")]


def test_align_goes_by_key(frame):
    pred, truth = frame([(1, "p1"), (3, "p3")], "id int, prediction string"), frame([(3, "r3"), (2, "r2")], "id int, reference string")
    assert rows(evaluate.align(pred, truth, "id"), "id", "prediction", "reference") == [(3, "p3", "r3")]


def f(hits, a, b):
    return 2 * hits / (a + b) if a + b else 0.0


def test_rouge_against_brute_force(frame):
    rng = random.Random(8)
    texts = [" ".join(rng.choice(["the", "cat", "sat", "mat", "dog"]) for _ in range(rng.randint(0, 120))) for _ in range(40)]
    pairs = [(i, texts[i], texts[-1 - i]) for i in range(40)] + [(100, "...", "a b"), (101, "same words", "Same, words!"), (102, None, "x")]
    df = frame(pairs, "pair_id int, reference string, prediction string")
    r1 = dict(rows(evaluate.rouge_n(df, 1), "pair_id", "rouge1"))
    r2 = dict(rows(evaluate.rouge_n(df, 2), "pair_id", "rouge2"))
    rl = dict(rows(evaluate.rouge_l(df), "pair_id", "rougeL"))
    for i, a, b in pairs[:40]:
        from collections import Counter

        x, y = a.split(), b.split()
        gx, gy = list(zip(x, x[1:])), list(zip(y, y[1:]))
        assert r1[i] == pytest.approx(f(sum((Counter(x) & Counter(y)).values()), len(x), len(y)))
        assert r2[i] == pytest.approx(f(sum((Counter(gx) & Counter(gy)).values()), len(gx), len(gy)))
        assert rl[i] == pytest.approx(f(lcs_by_table(x, y), len(x), len(y)))
        assert rl[i] <= r1[i] + 1e-12
        assert r1[i] == pytest.approx(r1[39 - i])
    assert (r1[100], rl[100], r1[102]) == (0.0, 0.0, 0.0)
    assert (r1[101], r2[101], rl[101]) == (1.0, 1.0, 1.0)
    report_row = evaluate.rouge_report(df, stem=False).first()
    assert report_row["rougeL"] == pytest.approx(np.mean(list(rl.values())))
    assert report_row["num_samples_evaluated"] == len(pairs)


def test_stems_meet(frame):
    df = frame([(1, "running cats", "run cat")], "pair_id int, reference string, prediction string")
    assert evaluate.rouge_n(df, 1).first()["rouge1"] == 0.0
    assert evaluate.rouge_n(df, 1, stem=True).first()["rouge1"] == 1.0
    assert evaluate.rouge_l(df, stem=True).first()["rougeL"] == 1.0


NAN, INF = float("nan"), float("inf")


def test_best_epoch_and_checkpoints(frame):
    data = [
        ("a", 1, 0.9), ("a", 2, NAN), ("a", 3, 0.5), ("a", 4, 0.5), ("a", 5, 0.7), ("a", 6, 0.4),
        ("tie", 1, 0.3), ("tie", 2, 0.3), ("nan", 1, NAN), ("nan", 2, None), ("inf", 1, INF),
    ]
    df = frame(data, "run_id string, epoch int, val_loss double")
    assert rows(history.best_epoch(df), "run_id", "best_epoch") == [("a", 6), ("tie", 1)]
    assert rows(history.checkpoints(df), "run_id", "epoch") == [("a", 1), ("a", 3), ("a", 6), ("tie", 1)]


def test_epoch_losses(frame):
    df = frame([(1, "train", 1.0), (1, "train", 3.0), (1, "val", 5.0), (2, "train", NAN)], "epoch int, phase string, loss double")
    first, second = sorted(history.epoch_losses(df).collect())
    assert tuple(first) == (1, 2.0, 5.0)
    assert second["train_loss"] != second["train_loss"] and second["val_loss"] is None


def test_last_learning_rate_of_an_epoch(frame):
    df = frame([(1, 1, "train", 1.0, 0.2), (1, 2, "train", 1.0, 0.1), (2, 3, "train", 1.0, 0.05)], "epoch int, step int, phase string, loss double, learning_rate double")
    assert rows(history.epoch_losses(df), "epoch", "learning_rate") == [(1, 0.1), (2, 0.05)]


def test_validation(frame):
    data = [(1, "x", None), (2, "", 5), (3, None, 5), (4, "x" * 2048, 20), (5, "x" * 2049, 21), (6, "x", 0), (7, "x", 1)]
    df = frame(data, "id int, text string, max_keywords int")
    found = {r["id"]: r for r in scoring.validate_requests(df, "keyword").collect()}
    assert {i for i, r in found.items() if r["is_valid"]} == {1, 4, 7}
    assert found[1]["max_keywords"] == 10
    assert found[5]["reasons"] == ["text is longer than 2048", "max_keywords is not in 1..20"]
    assert found[2]["reasons"] == ["text is empty"] and found[3]["reasons"] == ["text is missing"]
    sent = {r["id"]: r["is_valid"] for r in scoring.validate_requests(frame([(1, "x" * 512), (2, "x" * 513)], "id int, text string"), "sentiment").collect()}
    assert sent == {1: True, 2: False}


def test_predictions(frame):
    df = frame([(1, [0.0, 2.0, 2.0])], "id int, logits array<double>")
    row = scoring.predict_sentiment(df).first()
    assert row["label"] == "neutral" and set(row["probabilities"]) == {"negative", "neutral", "positive"}
    assert row["confidence"] == row["probabilities"]["neutral"]
    assert sum(row["probabilities"].values()) == pytest.approx(1)
    assert scoring.probabilities_long(scoring.predict_sentiment(df), "id").count() == 3


def test_keyword_answers(frame):
    df = frame([(1, "t" * 201, "a; b;;c", 2), (2, "short", "", 5)], "id int, text string, generated string, max_keywords int")
    found = {r["id"]: r for r in scoring.keywords_response(df).collect()}
    assert found[1]["keywords_string"] == "a; b" and found[1]["preview"].endswith("...") and found[2]["keywords"] == []
    assert rows(scoring.ranked_keywords(scoring.keywords_response(df), "id"), "id", "rank", "keyword") == [(1, 1, "a"), (1, 2, "b")]


def test_sampled_predictions(frame):
    data = [(i, f"t{i}", 0, 1, [0.2, 0.5, 0.3]) for i in range(80)]
    df = frame(data, "id int, text string, label int, pred int, probabilities array<double>")
    sample = report.sample_predictions(df, "id")
    assert sample.count() == 50 and sample.first()["confidence"] == 0.5
    assert rows(sample, "id") == rows(report.sample_predictions(df.repartition(6), "id"), "id")
    assert report.sample_predictions(df, "id", 500).count() == 80


def test_sampled_keyword_predictions(frame):
    df = frame([(1, "short", "r", "p")], "id int, document string, reference string, prediction string")
    assert tuple(report.sample_keyword_predictions(df, "id").first()) == (1, "short...", "r", "p")


METRICS = "run_id string, task string, accuracy double, f1_macro double, rouge1 double, mean_latency_ms double"


def test_compare_leaves_out_what_a_run_lacks(frame):
    df = frame(
        [("b", "sentiment", 0.5, 0.4, None, 10.0), ("t", "sentiment", 0.9, None, None, 8.0), ("b", "keyword", None, None, 0.2, 1.0), ("z", "keyword", None, None, 0.9, 1.0)],
        METRICS,
    )
    found = {(r["task"], r["metric"]): r["difference"] for r in report.compare_runs(df, "b", "t").collect()}
    assert found == {("sentiment", "accuracy"): pytest.approx(0.4), ("sentiment", "mean_latency_ms"): -2.0}


def test_targets(frame):
    df = frame([("t", "sentiment", 0.86, 0.83, None, 49.0), ("t", "keyword", None, None, 0.35, 201.0)], METRICS)
    found = {(r["task"], r["metric"]): r["passed"] for r in report.target_check(df).collect()}
    assert found == {
        ("sentiment", "accuracy"): True, ("sentiment", "f1_macro"): False, ("sentiment", "mean_latency_ms"): True,
        ("keyword", "rouge1"): False, ("keyword", "mean_latency_ms"): False,
    }


def test_findings(frame):
    df = frame([(0, 0)] * 3 + [(0, 1)] * 2 + [(1, 1)] * 5 + [(1, 2)], "label int, pred int")
    found = [tuple(r) for r in report.confusion_findings(evaluate.confusion(df), k=5).collect()]
    assert sorted(found, key=repr) == sorted(
        [("best_class", "neutral", None, pytest.approx(5 / 6)), ("misclassified", "negative", "neutral", 2.0), ("misclassified", "neutral", "positive", 1.0)],
        key=repr,
    )


def test_records(frame):
    judged = frame([(0, 0), (1, 0)], "label int, pred int")
    batches = frame([(1.0, 2)], "batch_seconds double, batch_n int")
    row = report.sentiment_record(evaluate.confusion(judged), batches, {"model": "m", "epochs": 3}).first()
    assert (row["task"], row["model"], row["epochs"], row["accuracy"], row["mean_latency_ms"]) == ("sentiment", "m", 3, 0.5, 500.0)
    pairs = frame([(1, "a b", "a b")], "pair_id int, reference string, prediction string")
    row = report.keyword_record(pairs, batches, {"model": "k"}, stem=False).first()
    assert (row["rouge1"], row["rougeL"], row["num_samples_evaluated"], row["p95_latency_ms"]) == (1.0, 1.0, 1, 500.0)


def test_records_of_many_runs(judged, frame):
    batches = frame([("a", 1.0, 2), ("b", 1.0, 4), ("b", 3.0, 4)], "run_id string, batch_seconds double, batch_n int")
    conf = evaluate.confusion(judged, ["run_id"])
    found = {r["run_id"]: r for r in report.sentiment_record(conf, batches, {"model": "m"}, ["run_id"]).collect()}
    assert set(found) == {"a", "b", "c"}
    assert (found["a"]["mean_latency_ms"], found["b"]["mean_latency_ms"], found["c"]["mean_latency_ms"]) == (500.0, 500.0, None)
    assert found["c"]["accuracy"] == pytest.approx(2 / 3)
