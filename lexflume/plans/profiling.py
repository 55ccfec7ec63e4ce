"""Queries: profiling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexflume.functions import text
from lexflume.operators import prepare, profile
from lexflume.plans.fixtures import Views, sql_key, sql_tokens, sql_words
from lexflume.plans.registry import registered
from lexflume.session import scratch_path


def _rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in cols})


def _keywords(v: Views) -> DataFrame:
    return prepare.pick_keyphrases(v.keys())


def _lengths(v: Views) -> DataFrame:
    return v.sent().withColumn("text_length", text.word_count(F.col("text")))


@registered(
    "SELECT coalesce(split, 'total') AS split, count(*) AS n FROM splits GROUP BY ROLLUP (split)",
    views=("splits",),
)
def split_counts(v: Views) -> DataFrame:
    return profile.split_counts(v.splits())


@registered("SELECT doc_id, text, label_name, split FROM sent ORDER BY doc_id LIMIT 5", views=("sent",))
def head_rows(v: Views) -> DataFrame:
    return profile.head_rows(v.sent().select("doc_id", "text", "label_name", "split"), "doc_id")


@registered("SELECT split, label_name, count(*) AS n FROM sent GROUP BY ALL", views=("sent",))
def class_counts(v: Views) -> DataFrame:
    return profile.class_counts(v.sent())


@registered(
    "SELECT split, label_name, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY split), 6) AS share "
    "FROM sent GROUP BY split, label_name",
    views=("sent",),
)
def class_balance(v: Views) -> DataFrame:
    return _rounded(profile.class_balance(v.sent()), "share")


@registered(f"SELECT doc_id, CAST({sql_words('text')} AS INTEGER) AS n_words FROM documents")
def word_count(v: Views) -> DataFrame:
    return v.table("documents").select("doc_id", text.word_count(F.col("text")).alias("n_words"))


@registered(
    "SELECT label_name, round(avg(w), 6) AS mean, median(w) AS median, CAST(min(w) AS INTEGER) AS min, "
    f"CAST(max(w) AS INTEGER) AS max, count(w) AS n FROM (SELECT label_name, {sql_words('text')} AS w FROM sent) "
    "GROUP BY label_name",
    views=("sent",),
)
def length_summary(v: Views) -> DataFrame:
    return _rounded(profile.length_summary(_lengths(v), "text_length", ["label_name"]), "mean")


def _histogram_sql(values: str, bins: int) -> str:
    return (
        f"WITH v AS ({values}), e AS (SELECT min(x) AS a, max(x) AS b FROM v), "
        "g AS (SELECT CASE WHEN a = b THEN a - 0.5 ELSE a END AS low, CASE WHEN a = b THEN b + 0.5 ELSE b END AS high FROM e) "
        f"SELECT CAST(i.range AS INTEGER) AS bin, round(low + i.range * ((high - low) / {bins}), 6) AS bin_start, "
        f"round(low + (i.range + 1) * ((high - low) / {bins}), 6) AS bin_end, "
        f"(SELECT count(*) FROM v WHERE least(floor((x - low) / (high - low) * {bins}), {bins - 1}) = i.range) AS n "
        f"FROM range({bins}) i, g"
    )


@registered(_histogram_sql(f"SELECT CAST({sql_words('text')} AS DOUBLE) AS x FROM documents", 50))
def histogram(v: Views) -> DataFrame:
    lengths = v.table("documents").select(text.word_count(F.col("text")).alias("n_words"))
    return _rounded(profile.histogram(lengths, "n_words", 50), "bin_start", "bin_end")


@registered(_histogram_sql("SELECT value AS x FROM events", 20))
def histogram_values(v: Views) -> DataFrame:
    return _rounded(profile.histogram(v.table("events"), "value", 20), "bin_start", "bin_end")


_BOX_SQL = (
    "q AS (SELECT g, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q3 "
    "FROM v GROUP BY g) SELECT v.g AS {name}, round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median, "
    "round(any_value(q3), 6) AS q3, "
    "min(x) FILTER (WHERE x BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5) AS whisker_low, "
    "max(x) FILTER (WHERE x BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5) AS whisker_high, "
    "count(*) FILTER (WHERE x NOT BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5) AS outliers, "
    "count(*) AS n FROM v JOIN q ON v.g = q.g GROUP BY v.g"
)


@registered(
    f"SELECT * FROM (WITH v AS (SELECT label_name AS g, CAST({sql_words('text')} AS INTEGER) AS x FROM sent), "
    + _BOX_SQL.format(name="label_name")
    + ")",
    views=("sent",),
)
def box_stats(v: Views) -> DataFrame:
    return _rounded(profile.box_stats(_lengths(v), "text_length", ["label_name"]), "q1", "median", "q3")


@registered("WITH v AS (SELECT event_type AS g, value AS x FROM events), " + _BOX_SQL.format(name="event_type"))
def box_stats_values(v: Views) -> DataFrame:
    return _rounded(profile.box_stats(v.table("events"), "value", ["event_type"]), "q1", "median", "q3")


@registered(
    "SELECT label_name, doc_id, text, CAST(r AS INTEGER) AS sample_no FROM (SELECT label_name, doc_id, text, "
    f"row_number() OVER (PARTITION BY label_name ORDER BY {sql_key('doc_id')}, doc_id) AS r FROM sent) WHERE r <= 2",
    views=("sent",),
)
def sample_per_class(v: Views) -> DataFrame:
    return profile.sample_per_class(v.sent(), "doc_id").select("label_name", "doc_id", "text", "sample_no")


@registered(
    "SELECT conv_id, turn, CASE WHEN well_formed THEN array_to_string(CASE WHEN len(toks) = 0 THEN [''] ELSE toks END, '|') "
    "ELSE '' END AS parsed, CASE WHEN well_formed THEN CAST(greatest(len(toks), 1) AS INTEGER) ELSE 0 END AS n FROM literal",
    views=("literal",),
)
def parse_keyword_list(v: Views) -> DataFrame:
    parsed = v.literal().withColumn("p", text.parse_keyword_list(F.col("literal")))
    return parsed.select("conv_id", "turn", F.array_join("p", "|").alias("parsed"), F.size("p").alias("n"))


_MIXED = """[None, "it's", 'say "so"', u'\\x41\\u00e9\\n', """


@registered(
    "SELECT conv_id, turn, CASE WHEN well_formed THEN array_to_string(['it''s', 'say \"so\"', 'Aé' || chr(10)] || toks || ['7', 'True'], '|') "
    "ELSE '' END AS parsed, CASE WHEN well_formed THEN CAST(6 + len(toks) AS INTEGER) ELSE 0 END AS n FROM literal",
    views=("literal",),
)
def parse_mixed_lists(v: Views) -> DataFrame:
    """Lists of strings in both quotes with escapes, ``None``, numbers and booleans; a third of the turns lacks a bracket."""
    quoted = F.transform(text.tokens(F.col("text")), lambda t: F.concat(F.lit("'"), t, F.lit("', ")))
    turns = v.table("conversations").withColumn("literal", F.concat(F.lit(_MIXED), F.array_join(quoted, ""), F.lit("7, True,")))
    closed = F.concat("literal", F.when(F.col("role") == "system", F.lit("")).otherwise(F.lit(" ]")))
    parsed = turns.withColumn("p", text.parse_keyword_list(closed))
    return parsed.select("conv_id", "turn", F.array_join("p", "|").alias("parsed"), F.size("p").alias("n"))


@registered(
    "SELECT count(*) AS n_documents, round(avg(len(keyphrases)), 6) AS avg_keywords, "
    "CAST(min(len(keyphrases)) AS INTEGER) AS min_keywords, CAST(max(len(keyphrases)) AS INTEGER) AS max_keywords, "
    f"round(avg({sql_words('document')}), 6) AS avg_doc_length FROM keys",
    views=("keys",),
)
def keyword_stats(v: Views) -> DataFrame:
    return _rounded(profile.keyword_stats(_keywords(v)), "avg_keywords", "avg_doc_length")


@registered(
    f"SELECT CAST({sql_words('document')} AS INTEGER) AS doc_length, CAST(len(keyphrases) AS INTEGER) AS num_keywords, "
    "count(*) AS n FROM keys GROUP BY ALL",
    views=("keys",),
)
def length_vs_keywords(v: Views) -> DataFrame:
    return profile.length_vs_keywords(_keywords(v))


@registered(
    "SELECT doc_id, substring(document, 1, 200) || '...' AS preview, array_to_string(keyphrases, '; ') AS keywords_str, "
    f"CAST(len(keyphrases) AS INTEGER) AS num_keywords FROM keys ORDER BY {sql_key('doc_id')}, doc_id LIMIT 3",
    views=("keys",),
)
def sample_documents(v: Views) -> DataFrame:
    return profile.sample_documents(_keywords(v), "doc_id")


@registered(
    "WITH j AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id)) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_missing FROM j"
        for c in ("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic")
    )
)
def missing_by_column(v: Views) -> DataFrame:
    return profile.missing_by_column(v.table("documents").join(v.table("labels"), "doc_id", "left"))


@registered(
    "SELECT count(*) AS n_rows, count(*) - count(DISTINCT coalesce('v' || text, 'null')) AS n_duplicates FROM documents"
)
def duplicate_count(v: Views) -> DataFrame:
    return profile.duplicate_count(v.table("documents"), "text")


@registered("SELECT DISTINCT label_name FROM sent WHERE label_name IS NOT NULL", views=("sent",))
def distinct_classes(v: Views) -> DataFrame:
    return profile.distinct_classes(v.sent())


def _samples_sql(view: str) -> str:
    per_split = ", ".join(f"count(*) FILTER (WHERE split = '{s}') AS {s}_samples" for s in ("train", "val", "test"))
    return f"count(*) AS total_samples, {per_split} FROM {view}"


@registered(
    "SELECT s.total_samples, s.train_samples, s.val_samples, s.test_samples, s.classes, round(s.avg_text_length, 6) AS "
    "avg_text_length, d.class_distribution, k.total_samples AS kw_total_samples, k.train_samples AS kw_train_samples, "
    "k.val_samples AS kw_val_samples, k.test_samples AS kw_test_samples, round(k.avg_keywords, 6) AS avg_keywords, "
    "round(k.avg_doc_length, 6) AS avg_doc_length FROM "
    "(SELECT string_agg(DISTINCT label_name, ', ' ORDER BY label_name) FILTER (WHERE split = 'train') AS classes, "
    f"avg({sql_words('text')}) FILTER (WHERE split = 'train') AS avg_text_length, {_samples_sql('sent')}) s, "
    "(SELECT string_agg(label_name || '=' || n, ', ' ORDER BY label_name) AS class_distribution FROM "
    "(SELECT label_name, count(*) AS n FROM sent WHERE split = 'train' GROUP BY label_name)) d, "
    "(SELECT avg(len(keyphrases)) FILTER (WHERE split = 'train') AS avg_keywords, "
    f"avg({sql_words('document')}) FILTER (WHERE split = 'train') AS avg_doc_length, {_samples_sql('keys')}) k",
    views=("sent", "keys"),
)
def eda_summary(v: Views) -> DataFrame:
    """The summary record, stored as JSON and read again."""
    path, record = scratch_path(v.spark, "eda"), profile.eda_summary(v.sent(), _keywords(v))
    profile.write_eda_summary(v.sent(), _keywords(v), path)
    record = v.spark.read.schema(record.schema).option("mode", "FAILFAST").json(path)
    samples = ("total_samples", "train_samples", "val_samples", "test_samples")
    shares = F.transform(
        F.map_entries("sentiment.class_distribution"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))
    )
    return record.select(
        *[F.col(f"sentiment.{c}") for c in samples],
        F.array_join("sentiment.classes", ", ").alias("classes"),
        F.round("sentiment.avg_text_length", 6).alias("avg_text_length"),
        F.array_join(shares, ", ").alias("class_distribution"),
        *[F.col(f"keyword.{c}").alias(f"kw_{c}") for c in samples],
        F.round("keyword.avg_keywords", 6).alias("avg_keywords"),
        F.round("keyword.avg_doc_length", 6).alias("avg_doc_length"),
    )


@registered(f"SELECT doc_id, array_to_string({sql_tokens('text')}, ' ') AS toks FROM documents")
def tokens(v: Views) -> DataFrame:
    return v.table("documents").select("doc_id", F.array_join(text.tokens(F.col("text")), " ").alias("toks"))
