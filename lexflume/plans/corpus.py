"""Queries: sources, sinks and corpus preparation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexflume.constants import CLASS_NAMES
from lexflume.functions.text import keyword_list_literal, parse_keyword_list
from lexflume.operators import prepare, report
from lexflume.plans.fixtures import Views, sql_class, sql_split
from lexflume.plans.registry import registered
from lexflume.plans.reports import both_runs
from lexflume.session import scratch_path
from lexflume.sources import corpora, metrics


@registered(
    "SELECT split, text, label, label_name, count(*) AS n FROM sent GROUP BY ALL",
    views=("sent",),
)
def read_split_csv(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "sentiment-csv")
    corpora.write_split_csv(v.sent().drop("doc_id"), path, "sentiment")
    back = corpora.read_split_csv(v.spark, path, "sentiment")
    return back.groupBy("split", "text", "label", "label_name").agg(F.count(F.lit(1)).alias("n"))


@registered(
    "SELECT doc_id AS id, text, 'train' AS split FROM documents UNION ALL "
    "SELECT conv_id AS id, text, 'val' AS split FROM conversations UNION ALL "
    "SELECT item_id AS id, text, 'test' AS split FROM benchmark"
)
def union_splits(v: Views) -> DataFrame:
    return prepare.union_splits(
        {
            "train": v.table("documents").select(F.col("doc_id").alias("id"), "text"),
            "val": v.table("conversations").select(F.col("conv_id").alias("id"), "text"),
            "test": v.table("benchmark").select(F.col("item_id").alias("id"), "text"),
        }
    )


@registered(
    "SELECT doc_id, document, array_to_string(keyphrases, '; ') AS keywords_str, "
    "CAST(len(keyphrases) AS INTEGER) AS n_keywords, split FROM keys",
    views=("keys",),
)
def write_dataset(v: Views) -> DataFrame:
    keys = prepare.pick_keyphrases(v.keys()).withColumn("keywords_list", keyword_list_literal(F.col("keywords_list")))
    stored = prepare.select_present(keys, ["doc_id", "document", "keywords_str", "keywords_list", "split"])
    path = scratch_path(v.spark, "keywords")
    corpora.write_dataset(stored, path, "csv")
    schema = stored.drop("split").schema
    back = corpora.read_dataset(v.spark, path, "csv", schema)
    listed = parse_keyword_list(F.col("keywords_list"))
    return back.select("doc_id", "document", "keywords_str", F.size(listed).alias("n_keywords"), "split")


@registered(
    "SELECT 42 AS random_seed, 'stand-in data' AS license, 'negative; neutral; positive' AS classes, split, "
    "count(*) AS n FROM sent GROUP BY split",
    views=("sent",),
)
def write_manifest(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "manifest")
    meta = {
        "random_seed": 42,
        "dataset": "sentiment",
        "license": "stand-in data",
        "classes": list(CLASS_NAMES.values()),
    }
    corpora.write_manifest(v.sent(), meta, path)
    back = corpora.read_manifest(v.spark, path)
    return back.select(
        "random_seed", "license", F.array_join("classes", "; ").alias("classes"), F.explode("rows").alias("split", "n")
    )


@registered(
    "SELECT 'keywords' AS dataset, split, count(*) AS n, (SELECT count(*) FROM keys WHERE document IS NULL) AS missing FROM keys GROUP BY split "
    "UNION ALL SELECT 'sentiment' AS dataset, split, count(*) AS n, (SELECT count(*) FROM sent WHERE text IS NULL) AS missing "
    "FROM sent GROUP BY split",
    views=("keys", "sent"),
)
def write_corpus(v: Views) -> DataFrame:
    """Both datasets written as Parquet, and one manifest with the counts of the writes."""
    path = scratch_path(v.spark, "corpus")
    keys = prepare.pick_keyphrases(v.keys()).select("doc_id", "document", "keywords_str", "split")
    counts = {
        "keywords": ({"format": "parquet"}, corpora.write_dataset(keys, f"{path}/keywords", text="document")),
        "sentiment": (
            {"format": "parquet", "classes": list(CLASS_NAMES.values())},
            corpora.write_dataset(v.sent(), f"{path}/sentiment", text="text"),
        ),
    }
    corpora.write_corpus_manifest(v.spark, counts, {"random_seed": 42}, f"{path}/manifest")
    back = corpora.read_corpus_manifest(v.spark, f"{path}/manifest").select(F.explode("datasets").alias("dataset", "d"))
    rows = back.select("dataset", F.explode("d.rows").alias("split", "n"), F.col("d.missing").alias("missing"))
    return rows.where("n > 0")


_RUN_COLUMNS = ("accuracy", "f1_macro", "precision", "recall", "f1_weighted", "f1_positive", "f1_neutral", "f1_negative")
_RUNS_SQL = "SELECT run_id, 'sentiment' AS task, " + ", ".join(f"round({c}, 6) AS {c}" for c in _RUN_COLUMNS) + " FROM runs"


def _stored_metrics(v: Views) -> str:
    path = scratch_path(v.spark, "metrics")
    metrics.write_metrics(both_runs(v), path)
    return path


@registered(_RUNS_SQL, views=("runs",))
def write_metrics(v: Views) -> DataFrame:
    back = metrics.read_metrics(v.spark, _stored_metrics(v))
    return back.select("run_id", "task", *[F.round(c, 6).alias(c) for c in _RUN_COLUMNS])


@registered(
    "SELECT run_id, task, metric, round(value, 6) AS value FROM (SELECT run_id, 'sentiment' AS task, accuracy, "
    'f1_macro, "precision", "recall", f1_weighted, f1_positive, f1_neutral, f1_negative FROM runs) '
    'UNPIVOT (value FOR metric IN (accuracy, f1_macro, "precision", "recall", f1_weighted, f1_positive, '
    "f1_neutral, f1_negative))",
    views=("runs",),
)
def read_metrics(v: Views) -> DataFrame:
    back = metrics.read_metrics(v.spark, _stored_metrics(v), "sentiment")
    return report.metrics_long(back).withColumn("value", F.round("value", 6))


@registered(
    "SELECT id, raw_label, CAST(CASE WHEN raw_label IN (0, 3, 4) THEN 0 WHEN raw_label = 5 THEN 1 "
    "WHEN raw_label IN (1, 2) THEN 2 END AS INTEGER) AS label, raw_label <= 5 AS is_mapped FROM rawlab",
    views=("rawlab",),
)
def map_labels(v: Views) -> DataFrame:
    return prepare.map_labels(v.rawlab())


@registered(
    f"SELECT vec_id, label, {sql_class('label')} AS label_name FROM logits",
    views=("logits",),
)
def label_names(v: Views) -> DataFrame:
    return prepare.label_names(v.logits().select("vec_id", "label"))


@registered(
    "SELECT doc_id, array_to_string(keyphrases, '; ') AS keywords_str, "
    "CAST(len(keyphrases) AS INTEGER) AS n_keywords FROM keys",
    views=("keys",),
)
def pick_keyphrases(v: Views) -> DataFrame:
    picked = prepare.pick_keyphrases(v.keys())
    return picked.select("doc_id", "keywords_str", F.size("keywords_list").alias("n_keywords"))


@registered(f"SELECT doc_id, {sql_split('doc_id')} AS split FROM documents")
def assign_split(v: Views) -> DataFrame:
    return prepare.assign_split(v.table("documents").select("doc_id"), "doc_id")


@registered(
    "SELECT doc_id, array_to_string(keyphrases, '; ') AS joined FROM keys",
    views=("keys",),
)
def join_keywords(v: Views) -> DataFrame:
    return prepare.join_keyphrases(v.keys(), "keyphrases", "joined").select("doc_id", "joined")


@registered("SELECT doc_id, lang, n_chars FROM documents")
def select_present(v: Views) -> DataFrame:
    return prepare.select_present(v.table("documents"), ["doc_id", "lang", "keywords_list", "n_chars"])
