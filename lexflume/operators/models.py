"""Models as Spark jobs: text classifier, its baseline, keyword extraction."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from lexflume.constants import CLASS_IDS, DEFAULT_KEYWORDS
from lexflume.functions.items import token_counts, token_totals
from lexflume.functions.text import join_keywords
from lexflume.operators.keyed import KeyedTable
from lexflume.session import stored

# Width of the hashed term space: the fitted model is classes x this many numbers.
FEATURES = 1 << 14
# Regularization strengths tried against the validation rows.
GRID = (0.01, 0.1)


def train_classifier(
    train: DataFrame,
    validation: DataFrame,
    text: str = "text",
    label: str = "label",
    grid: Sequence[float] = GRID,
    max_iter: int = 20,
    features: int = FEATURES,
) -> PipelineModel:
    """Three-class text classifier; the setting with the lowest validation loss wins."""
    return train_with_history(train, validation, text, label, grid, max_iter, features)[0]


def train_with_history(
    train: DataFrame,
    validation: DataFrame,
    text: str = "text",
    label: str = "label",
    grid: Sequence[float] = GRID,
    max_iter: int = 20,
    features: int = FEATURES,
) -> tuple[PipelineModel, DataFrame]:
    """The classifier and its history: one row (setting, strength, validation_loss, chosen) per setting tried.

    Gradients are summed on the executors; only coefficients (classes x
    ``features``) reach the driver. Terms are hashed once for all settings; with
    more distinct terms than ``features`` some share a column.
    """
    hashed = PipelineModel(
        stages=[
            RegexTokenizer(inputCol=text, outputCol="_terms", pattern="[^a-z0-9]+", minTokenLength=1),
            HashingTF(inputCol="_terms", outputCol="_tf", numFeatures=features),
        ]
    )

    def prepared(df: DataFrame) -> DataFrame:
        known = df.where(F.col(text).isNotNull() & F.col(label).isNotNull()).select(text, label)
        return hashed.transform(known).select(label, "_tf").persist(StorageLevel.MEMORY_AND_DISK)

    seen, held_out = prepared(train), prepared(validation)
    loss = MulticlassClassificationEvaluator(labelCol=label, metricName="logLoss")
    try:
        scaled = IDF(inputCol="_tf", outputCol="features").fit(seen)
        tried = []
        for strength in grid:
            learner = LogisticRegression(labelCol=label, family="multinomial", maxIter=max_iter, regParam=strength)
            fitted = learner.fit(scaled.transform(seen))
            # the summary of two classes holds the session, which must not travel with the model
            fitted._java_obj.setSummary(train.sparkSession._jvm.scala.Option.empty())
            tried.append((loss.evaluate(fitted.transform(scaled.transform(held_out))), fitted))
    finally:
        seen.unpersist()
        held_out.unpersist()
    best = min(range(len(tried)), key=lambda i: tried[i][0])
    history = train.sparkSession.createDataFrame(
        [(i + 1, float(strength), found, i == best) for i, (strength, (found, _)) in enumerate(zip(grid, tried, strict=True))],
        "setting int, strength double, validation_loss double, chosen boolean",
    )
    return PipelineModel(stages=[*hashed.stages, scaled, tried[best][1]]), history


def write_model(model: PipelineModel, history: DataFrame, path: str) -> None:
    """Keep a trained classifier under ``<path>/model`` and its history under ``<path>/history``."""
    model.write().overwrite().save(f"{path}/model")
    history.write.mode("overwrite").parquet(f"{path}/history")


def read_model(spark: SparkSession, path: str) -> tuple[PipelineModel, DataFrame]:
    """What ``write_model`` kept."""
    return PipelineModel.load(f"{path}/model"), spark.read.parquet(f"{path}/history")


def score_classifier(df: DataFrame, model: PipelineModel, text: str = "text") -> DataFrame:
    """Add the model's ``logits``, one per class; a class never trained on gets -inf.

    A null text is scored as an empty one.
    """
    scored = model.transform(df.withColumn(text, F.coalesce(text, F.lit(""))))
    logits = vector_to_array("rawPrediction")
    unseen = F.array_repeat(F.lit(float("-inf")), len(CLASS_IDS) - F.size(logits))
    return scored.select(*df.columns, F.concat(logits, unseen).alias("logits"))


def baseline_classifier(train: DataFrame, test: DataFrame, label: str = "label") -> DataFrame:
    """Score without a model: most frequent training class, class shares as probabilities."""
    counts = train.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    shares = F.array(
        *[F.coalesce(F.sum(F.when(F.col(label) == c, F.col("n"))), F.lit(0)) / F.sum("n") for c in CLASS_IDS]
    )
    guess = counts.agg(
        F.struct(
            F.max_by(label, F.struct("n", -F.col(label))).alias("pred"),
            shares.alias("probabilities"),
        )
    ).scalar()
    return (
        test.withColumn("_g", guess)
        .withColumn("pred", F.col("_g.pred"))
        .withColumn("probabilities", F.col("_g.probabilities"))
        .drop("_g")
    )


def _idf(n_docs, doc_freq):
    return F.log((n_docs + 1) / (doc_freq + 1))


def idf_table(df: DataFrame, text: str = "text") -> DataFrame:
    """Rows (term, doc_freq, n_docs, idf): what keyword scoring has to know of a corpus.

    A term counts once per document row and is combined in every task, so only
    distinct terms travel.
    """
    n_docs = df.agg(F.count(F.lit(1))).scalar()
    found = token_totals(df, text, once=True).select(F.col("token").alias("term"), F.col("n").alias("doc_freq"))
    found = found.withColumn("n_docs", n_docs)
    return found.withColumn("idf", _idf(F.col("n_docs"), F.col("doc_freq")))


@dataclass(frozen=True)
class Idf:
    """A stored IDF table ready for look-ups; make it once for a stream or for many frames."""

    table: KeyedTable
    n_docs: int

    @staticmethod
    def of(table: DataFrame, **limits: int) -> Idf:
        often = "doc_freq" if "doc_freq" in table.columns else None
        return Idf(KeyedTable(table, "term", often=often, **limits), table.agg(F.max("n_docs")).first()[0] or 0)


def with_ranked_terms(
    df: DataFrame, k: int, idf: Idf, text: str = "text", out: str = "ranked", keep: Sequence[str] | None = None
) -> DataFrame:
    """``df`` (its columns ``keep``, or all) with ``out``, each row's ``k`` best terms as an array of (term, score).

    A row's terms are counted, looked up, scored and sorted within the row. Scores are rounded before
    they are ranked, so the order does not hang on the last digit. Terms the table lacks get the idf
    of a term in no document.
    """
    counted = df.withColumn("_counted", token_counts(F.col(text)))
    terms = F.transform("_counted", lambda c: c["item"])
    unseen = math.log(idf.n_docs + 1)
    kept = [c for c in df.columns if keep is None or c in keep]
    known = idf.table.look_up(counted, terms, "idf", unseen, "_idf", [*kept, "_counted"])
    scored = F.zip_with(
        "_counted", "_idf", lambda c, w: F.struct((-F.round(c["n"] * w, 6)).alias("w"), c["item"].alias("term"))
    )
    best = F.transform(
        F.slice(F.array_sort(scored), 1, k), lambda t: F.struct(t["term"].alias("term"), (-t["w"]).alias("score"))
    )
    return known.select(*kept, best.alias(out))


def _ranked_rows(df: DataFrame, key: str, ranked: str) -> DataFrame:
    rows = df.select(key, F.posexplode_outer(ranked).alias("pos", "t")).where(F.col("t").isNotNull())
    return rows.select(key, (F.col("pos") + 1).alias("rank"), F.col("t.term").alias("term"), F.col("t.score").alias("score"))


def extract_keywords(
    df: DataFrame,
    k: int = DEFAULT_KEYWORDS,
    idf: DataFrame | Idf | None = None,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Top ``k`` terms per row by tf-idf, idf = ln((N + 1) / (df + 1)).

    Without a stored ``idf`` table that of this corpus is stored first. Every row has a ranking of its
    own, also where keys are equal or null.
    """
    if not isinstance(idf, Idf):
        idf = Idf.of(stored(idf_table(df, text), "idf") if idf is None else idf)
    ranked = with_ranked_terms(df.select(key, F.col(text).alias("_text")), k, idf, "_text", keep=[key])
    return _ranked_rows(ranked, key, "ranked")


def baseline_keywords(df: DataFrame, k: int = DEFAULT_KEYWORDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Top ``k`` terms per document by frequency alone; works within each row."""
    counted = df.select(key, token_counts(F.col(text)).alias("_counted"))
    by_frequency = F.sort_array(
        F.transform("_counted", lambda c: F.struct((-c["n"]).alias("w"), c["item"].alias("term")))
    )
    top = counted.select(key, F.posexplode_outer(F.slice(by_frequency, 1, k)).alias("pos", "t"))
    return top.where(F.col("t").isNotNull()).select(
        key, (F.col("pos") + 1).alias("rank"), F.col("t.term").alias("term"), (-F.col("t.w")).cast("double").alias("score")
    )


def keywords_per_document(ranked: DataFrame, key: str = "doc_id") -> DataFrame:
    """Ranked keyword rows to one list and string per document."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct("rank", "term"))), lambda x: x["term"])
    return ranked.groupBy(key).agg(listed.alias("keywords")).withColumn("generated", join_keywords(F.col("keywords")))
