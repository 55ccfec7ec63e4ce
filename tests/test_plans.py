"""What the physical plans must and must not hold."""

import os
import re

import pytest

import __spark_entry__ as entry_module

FOLDER = os.environ.get("LEXFLUME_TESTDATA", "/root/testdata/sf0.001")
QUERIES = entry_module.queries()
# These run jobs while they are built (streams, training, stored tables).
EAGER = {"train_classifier", "score_classifier", "score_stored_classifier", "setting_history", "stream_sentiment", "stream_keywords", "stream_retries", "stream_latency"}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="given tables are not here")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def built(spark, name):
    return plan(QUERIES[name](spark, FOLDER))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_cross_join_and_no_row_at_a_time_python(spark, name):
    text = built(spark, name)
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "FlatMapGroupsInPandas"):
        assert unwanted not in text, unwanted


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_windows_over_all_rows_see_bucket_totals_only(spark, name):
    lines = built(spark, name).splitlines()
    for i, line in enumerate(lines):
        if re.match(r"^[\s:+*()\d-]*Window \[", line) and any("Exchange SinglePartition" in x for x in lines[i + 1 : i + 3]):
            assert "sum(_rows#" in line, line


def test_the_window_check_sees_them(spark):
    assert "Exchange SinglePartition" in built(spark, "shuffle_and_batch")


def shuffles(text):
    """Every exchange but broadcasts and exchanges used again."""
    return len(re.findall(r"(?<![A-Za-z])Exchange ", text))


@pytest.mark.parametrize(
    "name, limit",
    [
        ("word_count", 0),
        ("tokens", 0),
        ("softmax", 0),
        ("predict_sentiment", 0),
        ("map_labels", 0),
        ("assign_split", 0),
        ("pick_keyphrases", 0),
        ("baseline_keywords", 0),
        ("split_keywords", 0),
        ("validate_requests", 0),
        ("confusion", 1),
        ("duplicate_count", 2),
        ("missing_by_column", 1),
        ("epoch_losses", 1),
    ],
)
def test_no_more_shuffles_than_needed(spark, name, limit):
    found = built(spark, name)
    joins = 2 * found.count("SortMergeJoin")
    assert shuffles(found) - joins <= limit, found


def test_rouge_moves_nothing(spark, frame):
    from lexflume.operators import evaluate

    pairs = spark.range(5).selectExpr("id AS pair_id", "'a b' AS reference", "'b a' AS prediction")
    for df in (evaluate.rouge_n(pairs, 2), evaluate.rouge_l(pairs), evaluate.rouge_l(pairs, stem=True)):
        assert "Exchange" not in plan(df)


@pytest.mark.parametrize(
    "name, columns",
    [("word_count", "doc_id:bigint,text:string"), ("duplicate_count", "text:string"), ("assign_split", "doc_id:bigint"), ("histogram_values", "value:double"), ("softmax", "vec_id:bigint,embedding:array<float>")],
)
def test_scans_read_used_columns_only(spark, name, columns):
    found = set(re.findall(r"ReadSchema: struct<(.*?)>(?=\s|$|,|\))", built(spark, name)))
    assert found == {columns}


def test_filters_reach_the_scan(spark):
    from lexflume.plans.fixtures import Views

    text = plan(Views(spark, FOLDER).table("documents").where("lang = 'en'").select("doc_id"))
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,en)]" in text


def test_samples_are_cut_before_the_shuffle(spark):
    text = built(spark, "sample_per_class")
    assert re.search(r"WindowGroupLimit .*Partial", text)
    assert "TakeOrderedAndProject" in built(spark, "first_n")
