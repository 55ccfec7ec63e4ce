"""Queries: classifier, keyword extraction, training history."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexflume.operators import evaluate, history, keyphrases, models, scoring
from lexflume.plans.fixtures import Views, sql_tokens
from lexflume.plans.registry import registered
from lexflume.session import scratch_path


@lru_cache(maxsize=None)
def _stored_model(application: str, folder: str) -> str:
    """Path of the classifier of one folder's tables: trained once per session, then read by every query."""
    v = Views(SparkSession.getActiveSession(), folder)
    path = scratch_path(v.spark, "classifier")
    sent = v.sent()
    model, tried = models.train_with_history(sent.where("split = 'train'"), sent.where("split = 'val'"))
    models.write_model(model, tried, path)
    return path


def trained(v: Views) -> tuple[DataFrame, models.PipelineModel]:
    """Labelled rows, and the stored classifier."""
    return v.sent(), models.read_model(v.spark, _stored_model(v.spark.sparkContext.applicationId, v.folder))[0]


@registered()
def train_classifier(v: Views) -> DataFrame:
    """How the trained model does on each split."""
    sent, model = trained(v)
    scored = scoring.with_predictions(models.score_classifier(sent.select("split", "label", "text"), model))
    conf = evaluate.confusion(scored, ["split"])
    return evaluate.classification_metrics(conf, ["split"])


@registered()
def score_classifier(v: Views) -> DataFrame:
    """What the trained model says of each text."""
    sent, model = trained(v)
    scored = models.score_classifier(sent.select("doc_id", "text"), model)
    answered = scoring.predict_sentiment(scored)
    return answered.select("doc_id", "label", F.round("confidence", 6).alias("confidence"))


@registered(
    "SELECT doc_id, true AS same, true AS sums_to_one, true AS label_fits FROM sent",
    views=("sent",),
)
def score_stored_classifier(v: Views) -> DataFrame:
    """Saved, loaded, saved and loaded again: the same answer for every row, and each one well-formed."""
    sent, model = trained(v)
    path = scratch_path(v.spark, "classifier")
    models.write_model(model, models.read_model(v.spark, _stored_model(v.spark.sparkContext.applicationId, v.folder))[1], path)
    again = models.read_model(v.spark, path)[0]
    texts = sent.select("doc_id", "text")
    first = scoring.predict_sentiment(models.score_classifier(texts, model)).select("doc_id", "label", "confidence", "probabilities")
    second = scoring.predict_sentiment(models.score_classifier(texts, again)).select("doc_id", F.col("probabilities").alias("other"))
    p, q = F.map_values("probabilities"), F.map_values("other")
    apart = F.array_max(F.zip_with(p, q, lambda a, b: F.abs(a - b)))
    total = F.aggregate(p, F.lit(0.0), lambda s, x: s + x)
    return first.join(second, "doc_id").select(
        "doc_id",
        (apart < 1e-9).alias("same"),
        (F.abs(total - 1) < 1e-9).alias("sums_to_one"),
        (F.element_at("probabilities", F.col("label")) == F.array_max(p)).alias("label_fits"),
    )


@registered(
    "SELECT setting, strength, setting = 1 AS was_best_so_far_first, true AS chosen_is_lowest, CAST(1 AS BIGINT) AS chosen "
    f"FROM (VALUES {', '.join(f'({i + 1}, CAST({g} AS DOUBLE))' for i, g in enumerate(models.GRID))}) AS t(setting, strength)"
)
def setting_history(v: Views) -> DataFrame:
    """The stored history of the settings tried, read as a training history: the chosen one is its best epoch."""
    kept = models.read_model(v.spark, _stored_model(v.spark.sparkContext.applicationId, v.folder))[1]
    runs = kept.select(F.lit("grid").alias("run_id"), F.col("setting").alias("epoch"), F.col("validation_loss").alias("val_loss"))
    best = history.best_epoch(runs).select("best_epoch").scalar()
    first = history.checkpoints(runs).agg(F.min("epoch")).scalar()
    chosen = kept.where("chosen")
    return kept.select(
        "setting",
        "strength",
        (F.col("setting") == first).alias("was_best_so_far_first"),
        (best == chosen.agg(F.max("setting")).scalar()).alias("chosen_is_lowest"),
        chosen.agg(F.count(F.lit(1))).scalar().alias("chosen"),
    )


@registered(
    "SELECT doc_id, (SELECT label FROM sent WHERE split = 'train' GROUP BY label ORDER BY count(*) DESC, label LIMIT 1) "
    "AS pred, "
    + ", ".join(
        f"(SELECT round(count(*) FILTER (WHERE label = {i}) / count(*), 6) FROM sent WHERE split = 'train') AS p{i}"
        for i in range(3)
    )
    + " FROM sent WHERE split = 'test'",
    views=("sent",),
)
def baseline_classifier(v: Views) -> DataFrame:
    sent = v.sent()
    scored = models.baseline_classifier(
        sent.where("split = 'train'"), sent.where("split = 'test'").select("doc_id")
    )
    return scored.select(
        "doc_id", "pred", *[F.round(F.element_at("probabilities", i + 1), 6).alias(f"p{i}") for i in range(3)]
    )


_TF = (
    "tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, "
    f"unnest({sql_tokens('text')}) AS term FROM documents) GROUP BY doc_id, term)"
)
_TOP = (
    "SELECT doc_id, CAST(r AS INTEGER) AS rank, term, score FROM (SELECT *, "
    "row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, term) AS r FROM scored) WHERE r <= 10"
)


@registered(
    f"WITH {_TF}, idf AS (SELECT term, ln(((SELECT count(*) FROM documents) + 1) / (count(*) + 1)) AS idf FROM tf GROUP BY term), "
    f"scored AS (SELECT doc_id, term, round(tf * idf, 6) AS score FROM tf JOIN idf USING (term)) {_TOP}"
)
def extract_keywords(v: Views) -> DataFrame:
    return models.extract_keywords(v.table("documents"))


@registered(
    "WITH turns AS (SELECT row_number() OVER () AS rid, CASE WHEN role <> 'system' THEN conv_id END AS conv_id, text FROM conversations), "
    f"tf AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest({sql_tokens('text')}) AS term FROM turns) GROUP BY rid, term), "
    "idf AS (SELECT term, ln(((SELECT count(*) FROM turns) + 1) / (count(*) + 1)) AS idf FROM tf GROUP BY term), "
    "scored AS (SELECT rid, term, round(tf * idf, 6) AS score FROM tf JOIN idf USING (term)) "
    "SELECT conv_id, CAST(r AS INTEGER) AS rank, term, score FROM (SELECT *, "
    "row_number() OVER (PARTITION BY rid ORDER BY score DESC, term) AS r FROM scored) JOIN turns USING (rid) WHERE r <= 5"
)
def keywords_of_turns(v: Views) -> DataFrame:
    """Rows with repeated and null keys: every row has a ranking of its own."""
    turns = v.table("conversations").select(F.expr("CASE WHEN role <> 'system' THEN conv_id END AS conv_id"), "text")
    return models.extract_keywords(turns, 5, key="conv_id")


@registered(f"WITH {_TF}, scored AS (SELECT doc_id, term, CAST(tf AS DOUBLE) AS score FROM tf) {_TOP}")
def baseline_keywords(v: Views) -> DataFrame:
    return models.baseline_keywords(v.table("documents"))


@registered(
    "SELECT run_id, epoch, round(train_loss, 6) AS train_loss, round(val_loss, 6) AS val_loss FROM epochs",
    views=("epochs",),
)
def epoch_losses(v: Views) -> DataFrame:
    epochs = history.epoch_losses(v.history(), ["run_id"])
    return epochs.withColumns({c: F.round(c, 6) for c in ("train_loss", "val_loss")})


@registered(
    "SELECT run_id, arg_min(epoch, (val_loss, epoch)) AS best_epoch, round(min(val_loss), 6) AS best_val_loss "
    "FROM epochs WHERE val_loss < CAST('inf' AS DOUBLE) GROUP BY run_id",
    views=("epochs",),
)
def best_epoch(v: Views) -> DataFrame:
    best = history.best_epoch(history.epoch_losses(v.history(), ["run_id"]))
    return best.withColumn("best_val_loss", F.round("best_val_loss", 6))


@registered(
    "SELECT run_id, epoch, round(val_loss, 6) AS val_loss FROM (SELECT *, min(val_loss) OVER (PARTITION BY run_id "
    "ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM epochs "
    "WHERE val_loss < CAST('inf' AS DOUBLE)) WHERE before IS NULL OR val_loss < before",
    views=("epochs",),
)
def checkpoints(v: Views) -> DataFrame:
    kept = history.checkpoints(history.epoch_losses(v.history(), ["run_id"]))
    return kept.withColumn("val_loss", F.round("val_loss", 6))


# Tokens with `|` between pieces; stop words stand in a tenth of all rows.
_FREE = (
    "cut AS (SELECT doc_id, list_filter(string_split_regex(regexp_replace(lower(text), '[.,;:!?()\\[\\]{}\"|\\r\\n]+', ' | ', 'g'), "
    "'[^a-z0-9|]+'), lambda t: t <> '') AS toks FROM documents), "
    f"seen AS (SELECT DISTINCT doc_id, unnest({sql_tokens('text')}) AS token FROM documents), "
    "stops AS (SELECT token FROM seen GROUP BY token HAVING count(*) >= 0.1 * (SELECT count(*) FROM documents)), "
    "spots AS (SELECT doc_id, unnest(toks) AS token, generate_subscripts(toks, 1) AS p FROM cut), "
    "free AS (SELECT *, p - row_number() OVER (PARTITION BY doc_id ORDER BY p) AS run FROM spots "
    "WHERE token <> '|' AND token NOT IN (SELECT token FROM stops))"
)
# Phrases of 2, 3 and 4 words between stop words, a row per occurrence.
_GRAMS = " UNION ALL ".join(
    f"SELECT doc_id, {n} AS words, string_agg(token, ' ') OVER w AS phrase, count(*) OVER w AS held FROM free "
    f"WINDOW w AS (PARTITION BY doc_id, run ORDER BY p ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING)"
    for n in (2, 3, 4)
)
_PHRASES = (
    f"WITH {_FREE}, grams AS (SELECT doc_id, words, phrase FROM ({_GRAMS}) WHERE held = words), "
    "counted AS (SELECT phrase, any_value(words) AS words, count(*) AS f, count(DISTINCT doc_id) AS doc_freq "
    "FROM grams GROUP BY phrase HAVING count(*) >= 2), "
    "inner_ AS (SELECT DISTINCT phrase AS longer, f, array_to_string(string_split(phrase, ' ')[i:j], ' ') AS phrase "
    "FROM counted, range(1, 5) x(i), range(2, 5) y(j) WHERE i < j AND j <= words AND j - i + 1 < words), "
    "around AS (SELECT phrase, CAST(sum(f) AS BIGINT) AS around, count(*) AS around_n FROM inner_ GROUP BY phrase), "
    "weighed AS (SELECT phrase, words, f, doc_freq, coalesce(around, 0) AS around, coalesce(around_n, 0) AS around_n, "
    "round(ln(((SELECT count(*) FROM documents) + 1) / (doc_freq + 1)) * log2(1.0 + words) * "
    "CASE WHEN around_n > 0 THEN (f - around / around_n) / f ELSE 1.0 END, 6) AS weight FROM counted LEFT JOIN around USING (phrase)) "
)


@registered(_PHRASES + "SELECT phrase, CAST(words AS INTEGER) AS words, f, doc_freq, around, around_n, weight FROM weighed")
def phrase_table(v: Views) -> DataFrame:
    """What the corpus knows of its phrases."""
    return keyphrases.learn_phrases(v.table("documents")).table.rows.drop("n_docs")


@registered(
    _PHRASES
    + ", scored AS (SELECT doc_id, phrase AS term, round(count(*) * any_value(weight), 6) AS score FROM grams JOIN weighed USING (phrase) "
    "GROUP BY doc_id, phrase HAVING round(count(*) * any_value(weight), 6) > 0) "
    "SELECT doc_id, CAST(r AS INTEGER) AS rank, term, score FROM (SELECT *, "
    "row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, term) AS r FROM scored) WHERE r <= 10"
)
def extract_keyphrases(v: Views) -> DataFrame:
    """The ten best phrases of every document."""
    return keyphrases.extract_keyphrases(v.table("documents"))
