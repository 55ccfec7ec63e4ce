import json

import pytest
from pyspark.sql import functions as F

from lexflume.operators import models, scoring
from lexflume.session import scratch_path, shared_dir
from lexflume.sources import corpora, metrics
from lexflume.streaming import latency
from lexflume.streaming import requests as streams

HARD = ['plain', 'a "quoted" one', "back\\slash", "two\nlines\r\nand more", "comma, semicolon;", " blanks ", "é ü 中", 'ends with "']


@pytest.fixture()
def corpus(frame):
    rows = [(t, i % 3, "positive", ("train", "val", "test")[i % 3]) for i, t in enumerate(HARD)]
    return frame(rows, "text string, label int, label_name string, split string")


def as_rows(df):
    return sorted(tuple(r) for r in df.select("text", "label", "label_name", "split").collect())


def test_split_csv_round_trip(spark, corpus, tmp_path):
    corpora.write_split_csv(corpus, str(tmp_path), "sentiment")
    assert as_rows(corpora.read_split_csv(spark, str(tmp_path), "sentiment")) == as_rows(corpus)


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_dataset_round_trip(spark, corpus, tmp_path, fmt):
    path = str(tmp_path / "set")
    corpora.write_dataset(corpus, path, fmt)
    back = corpora.read_dataset(spark, path, fmt, corpora.SENTIMENT_SCHEMA)
    assert as_rows(back) == as_rows(corpus)
    plan = back.where("split = 'val'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_unknown_format(corpus, tmp_path):
    with pytest.raises(ValueError):
        corpora.write_dataset(corpus, str(tmp_path / "x"), "xml")


def test_single_csv_files_and_empty_keywords(spark, tmp_path):
    for split in ("train", "val", "test"):
        (tmp_path / f"keywords_{split}.csv").write_text('document,keywords_str,keywords_list\n"a ""b""\nc",,[]\nd,x; y,"[\'x\', \'y\']"\n')
    found = corpora.read_split_csv(spark, str(tmp_path), "keywords")
    assert found.count() == 6
    assert sorted(r["keywords_str"] for r in found.where("split = 'val'").collect()) == ["", "x; y"]
    assert found.where("document = 'a \"b\"\\nc'").count() == 3


def test_csv_columns_go_by_name_and_bad_values_fail(spark, tmp_path):
    for split in ("train", "val", "test"):
        (tmp_path / f"sentiment_{split}.csv").write_text("label,text,label_name\n0,a,negative\n")
        (tmp_path / f"keywords_{split}.csv").write_text("document,keywords_list\nd,['x']\n")
    assert as_rows(corpora.read_split_csv(spark, str(tmp_path), "sentiment"))[0] == ("a", 0, "negative", "test")
    row = corpora.read_split_csv(spark, str(tmp_path), "keywords").first()
    assert (row["document"], row["keywords_str"], row["keywords_list"]) == ("d", "", "['x']")
    (tmp_path / "sentiment_val.csv").write_text("label,text,label_name\nzero,a,negative\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        corpora.read_split_csv(spark, str(tmp_path), "sentiment").collect()


def test_keyword_answers_of_null_and_repeated_ids(spark, frame):
    texts = [("a", "red red fox", 5), ("a", "blue sky", 5), (None, "green", 5), ("b", "...", 5)]
    asked = frame(texts, "request_id string, text string, max_keywords int")
    idf = models.idf_table(frame([("red fox",), ("blue",), ("green",)], "text string"))
    got = {(r["request_id"], r["text"]): sorted(r["keywords"]) for r in streams.answer_keywords(asked, idf).collect()}
    assert got == {("a", "red red fox"): ["fox", "red"], ("a", "blue sky"): ["blue", "sky"], (None, "green"): ["green"], ("b", "..."): []}


def test_model_is_kept_with_its_history(spark, frame, tmp_path):
    docs = frame([("good fine", 2), ("bad awful", 0), ("so so", 1)] * 5, "text string, label int")
    model, history = models.train_with_history(docs, docs, grid=(0.1, 0.5), max_iter=5, features=256)
    models.write_model(model, history, str(tmp_path / "kept"))
    again, rows = models.read_model(spark, str(tmp_path / "kept"))
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, history.collect()))
    assert history.where("chosen").count() == 1
    before, after = (sorted(map(str, models.score_classifier(docs, m).collect())) for m in (model, again))
    assert before == after


def test_manifest(spark, corpus, tmp_path):
    corpora.write_manifest(corpus, {"random_seed": 42, "classes": ["a", "b"]}, str(tmp_path / "m"))
    row = corpora.read_manifest(spark, str(tmp_path / "m")).first()
    assert (row["random_seed"], row["classes"], row["rows"]) == (42, ["a", "b"], {"train": 3, "val": 3, "test": 2})
    with pytest.raises(ValueError):
        corpora.manifest(corpus, {"colour": "red"})


def test_metrics_store(spark, frame, tmp_path):
    path = str(tmp_path / "metrics")
    assert metrics.read_metrics(spark, path).count() == 0
    metrics.write_metrics(frame([("r1", "sentiment", 0.5)], "run_id string, task string, accuracy double"), path)
    metrics.write_metrics(frame([("r2", "keyword", 0.25)], "run_id string, task string, rouge1 double"), path)
    assert metrics.read_metrics(spark, path).count() == 2
    assert [r["rouge1"] for r in metrics.read_metrics(spark, path, "keyword").collect()] == [0.25]
    metrics.write_metrics(frame([("r1", "sentiment", 0.75)], "run_id string, task string, accuracy double"), path)
    found = metrics.read_metrics(spark, path)
    assert sorted((r["run_id"], r["accuracy"]) for r in found.collect()) == [("r1", 0.75), ("r2", None)]
    with pytest.raises(ValueError):
        metrics.read_metrics(spark, path, "other")


class NamedSession:
    """Just the settings of a session."""

    def __init__(self, **settings):
        self.settings = {k.replace("_", "."): v for k, v in settings.items()}
        self.conf = self

    def get(self, key, default):
        return self.settings.get(key, default)


def test_shared_folder_is_the_sessions(tmp_path):
    named = NamedSession(spark_checkpoint_dir="hdfs:///shared/", spark_master="yarn")
    assert shared_dir(named) == "hdfs:///shared"
    assert scratch_path(named, "x").startswith("hdfs:///shared/x-")
    assert scratch_path(named, "x") != scratch_path(named, "x")


def test_temporary_folder_is_for_local_sessions_only():
    local = NamedSession(spark_master="local[2]", spark_app_id="a")
    assert shared_dir(local) == shared_dir(local) != shared_dir(NamedSession(spark_master="local[2]", spark_app_id="b"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(NamedSession(spark_master="yarn"))


def test_sample_export(spark, frame, tmp_path):
    sample = frame([(1, 'a "b"\nc', 0.5)], "id int, input_text string, confidence double")
    corpora.write_samples(sample, str(tmp_path / "s"))
    files = list((tmp_path / "s").glob("*.csv"))
    assert len(files) == 1
    assert files[0].read_text() == '"id","input_text","confidence"\n"1","a ""b""\nc","0.5"\n'


TIMES = ("asked_at", "answered_at", "response_ms")
REQUESTS = [
    {"request_id": "1", "text": "great great lovely", "max_keywords": 2},
    {"request_id": "2", "text": "", "max_keywords": 2},
    {"request_id": "3", "text": "awful awful", "max_keywords": 21},
    {"request_id": "4", "text": "...", "max_keywords": 5},
    {"request_id": "5", "text": "x" * 3000, "max_keywords": 5},
    {"request_id": "6", "text": "awful table"},
]


def arrive(folder, name, requests):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in requests))


@pytest.fixture(scope="module")
def documents(frame):
    rows = [(1, "great lovely day", 2), (2, "awful day", 0), (3, "a table", 1), (4, "great table", 2), (5, "awful paper", 0)]
    return frame(rows, "doc_id int, text string, label int")


def test_keyword_stream_equals_batch_and_restarts(spark, documents, tmp_path):
    idf = models.idf_table(documents)
    arrive(tmp_path / "in", "a.json", REQUESTS[:3])
    arrive(tmp_path / "in", "b.json", REQUESTS[3:5])
    requests = streams.request_stream(spark, str(tmp_path / "in"), files_per_trigger=1)
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    streams.stream_keywords(requests, idf, out, progress).awaitTermination()
    first = streams.read_answers(spark, out, "keyword")
    assert first.select("batch").distinct().count() == 2
    arrive(tmp_path / "in", "c.json", REQUESTS[5:])
    streams.stream_keywords(requests, idf, out, progress).awaitTermination()
    streams.stream_keywords(requests, idf, out, progress).awaitTermination()

    found = sorted(tuple(r) for r in streams.read_answers(spark, out, "keyword").drop("batch", *TIMES).collect())
    everything = spark.read.schema(streams.REQUEST_SCHEMA).json(str(tmp_path / "in"))
    checked = scoring.validate_requests(everything, "keyword")
    batch = streams.answer_keywords(checked.where("is_valid"), idf)
    assert found == sorted(tuple(r) for r in batch.drop("asked_at").collect())
    answers = {r[0]: r for r in found}
    assert set(answers) == {"1", "4", "6"}
    assert answers["1"][2] == ["great", "lovely"] and answers["4"][2] == []
    rejects = {r["request_id"]: r["reasons"] for r in streams.read_rejects(spark, out).collect()}
    assert set(rejects) == {"2", "3", "5"} and rejects["3"] == ["max_keywords is not in 1..20"]


def test_sentiment_stream(spark, documents, tmp_path):
    model = models.train_classifier(documents, documents, grid=(0.1,), max_iter=5)
    arrive(tmp_path / "in", "a.json", REQUESTS)
    out = str(tmp_path / "out")
    requests = streams.request_stream(spark, str(tmp_path / "in"))
    streams.stream_sentiment(requests, model, out, str(tmp_path / "progress")).awaitTermination()
    found = {r["request_id"]: r for r in streams.read_answers(spark, out, "sentiment").collect()}
    assert set(found) == {"1", "3", "4", "6"} and found["1"]["label"] == "positive"
    assert sum(found["1"]["probabilities"].values()) == pytest.approx(1)
    assert streams.read_rejects(spark, out).select(F.sort_array(F.collect_set("request_id"))).first()[0] == ["2", "5"]


ASKED = [
    {"request_id": "1", "text": "great table", "asked_at": "2024-01-01T00:00:05Z"},
    {"request_id": "2", "text": "awful day", "asked_at": "2024-01-01T00:00:10Z"},
    {"request_id": None, "text": "nobody's", "asked_at": "2024-01-01T00:00:11Z"},
    {"request_id": "4", "text": "timeless"},
]


def test_retries_are_answered_once(spark, documents, tmp_path):
    idf = models.Idf.of(models.idf_table(documents))
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")

    def go():
        requests = streams.without_retries(streams.request_stream(spark, str(tmp_path / "in"), files_per_trigger=1))
        streams.stream_keywords(requests, idf, out, progress).awaitTermination()
        answers = streams.read_answers(spark, out, "keyword").collect()
        return sorted((r["request_id"] or "", r["text"]) for r in answers)

    arrive(tmp_path / "in", "a.json", [*ASKED, ASKED[0]])
    arrive(tmp_path / "in", "b.json", [ASKED[1], {**ASKED[0], "asked_at": "2024-01-01T00:01:00Z"}])
    once = sorted((r["request_id"] or "", r["text"]) for r in ASKED)
    assert go() == once
    # a retry after a restart, and requests that cannot be told from others
    arrive(tmp_path / "in", "c.json", [ASKED[0], ASKED[2], ASKED[3]])
    assert go() == sorted([*once, ("", "nobody's"), ("4", "timeless")])
    # long after, the id is forgotten: the state is bounded, and the same id is a new request
    arrive(tmp_path / "in", "d.json", [{**ASKED[0], "request_id": "9", "asked_at": "2024-01-01T01:00:00Z"}])
    go()
    arrive(tmp_path / "in", "e.json", [{**ASKED[0], "asked_at": "2024-01-01T01:00:01Z"}])
    assert go().count(("1", "great table")) == 2


def test_answers_carry_their_response_time(spark, documents, tmp_path):
    arrive(tmp_path / "in", "a.json", ASKED)
    out = str(tmp_path / "out")
    requests = streams.request_stream(spark, str(tmp_path / "in"))
    streams.stream_keywords(requests, models.idf_table(documents), out, str(tmp_path / "progress")).awaitTermination()
    found = {r["text"]: r for r in streams.read_answers(spark, out, "keyword").collect()}
    assert found["timeless"]["response_ms"] is None
    asked = found["great table"]
    assert asked["response_ms"] == pytest.approx((asked["answered_at"] - asked["asked_at"]).total_seconds() * 1000, abs=1)


LOG = "asked_at timestamp, response_ms double"


def test_stream_latency_equals_batch_after_a_restart(spark, tmp_path):
    import random

    import numpy as np

    rng = random.Random(8)
    (tmp_path / "in").mkdir()
    arriving = spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    rows = []
    for part in range(4):
        some = [(1_700_000_000 + 60 * part + rng.randrange(120), rng.choice([float(rng.randrange(5)), None, float("nan"), 9.5])) for _ in range(80)]
        rows += some
        df = spark.createDataFrame(some, "s long, response_ms double").selectExpr("timestamp_seconds(s) AS asked_at", "response_ms")
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        if part % 2:
            latency.stream_latency(arriving, out, progress).awaitTermination()
    found = {r["window_start"]: r for r in latency.read_latency(spark, out).collect()}
    whole = {r["window_start"]: r for r in latency.by_window(spark.read.schema(LOG).parquet(str(tmp_path / "in"))).collect()}
    assert found == whole
    for start, r in found.items():
        held = [v for s, v in rows if v is not None and v == v and 0 <= s - start.timestamp() < 60]
        held.sort()
        assert (r["n"], r["max_latency_ms"]) == (len(held), held[-1])
        assert r["mean_latency_ms"] == pytest.approx(np.mean(held))
        assert r["p95_latency_ms"] == held[int(np.ceil(0.95 * len(held))) - 1]


def test_late_answers_change_nothing(spark, tmp_path):
    (tmp_path / "in").mkdir()
    arriving = spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    for seconds in (0, 3600, 3700, 1, 3650):  # the fourth comes an hour late, the last is in time
        one = spark.sql(f"SELECT timestamp_seconds({seconds}) AS asked_at, double(5) AS response_ms")
        one.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        latency.stream_latency(arriving, out, progress).awaitTermination()
    found = latency.read_latency(spark, out).selectExpr("unix_seconds(window_start) AS s", "n").collect()
    assert {r["s"]: r["n"] for r in found} == {0: 1, 3600: 2, 3660: 1}
