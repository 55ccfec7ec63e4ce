"""Toxicity by cumulative-link ordinal regression on sparse text features.

``P(grade >= k) = sigmoid(w.x - theta_k)`` with one weight vector for all thresholds
``theta_1 < theta_2 < ...``; the severity of a text is its expected grade. Features say which words
and four-letter word parts occur in a text. They are chosen on, and the model is fitted to, a
bounded sample of labelled rows; every row is scored over its whole text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexflume.llm.texts import pieces, release
from lexflume.session import stored

# Labelled rows that the classifier is fitted on at most (lowest hashes of doc_id).
FIT_ROWS = 20_000
# Features at most, and how many standard errors apart their rates in toxic and other rows must be.
FEATURES = 2_000
LEAST_Z = 5.0
LEAST_ROWS = 3
PART = 4
# Words whose features a task remembers.
CACHED_WORDS = 400_000
WORD = re.compile(r"\w+")


@dataclass
class Ordinal:
    """Features with shared weights, and ordered thresholds of the grades 1, 2, ..."""

    index: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    thresholds: np.ndarray = field(default_factory=lambda: np.full(1, 30.0))

    def at_least(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ... as columns."""
        return 1 / (1 + np.exp(-np.clip(scores[:, None] - self.thresholds[None, :], -40, 40)))


def word_features(word: str) -> set[str]:
    """The word itself and its inner parts, marked apart."""
    return {f"={word}"} | {word[i : i + PART] for i in range(len(word) - PART + 1)}


def distinct_words(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


def _count_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows per feature, apart for grade 0 and higher, combined within pieces of the partition."""
    for batch in pieces(batches):
        toxic, other = Counter(), Counter()
        for text, grade in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            found: set[str] = set()
            for word in distinct_words(text):
                found |= word_features(word)
            (toxic if grade else other).update(found)
        names = list(toxic.keys() | other.keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([toxic[n] for n in names]), pa.array([other[n] for n in names])],
            names=["feature", "toxic", "other"],
        )


class Scorer:
    """Sums of feature weights of whole texts; remembers the features of words."""

    def __init__(self, index: dict[str, int]):
        self.index, self.known = index, {}

    def features(self, text: str | None) -> list[int]:
        found: set[int] = set()
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        for word in distinct_words(text):
            held = self.known.get(word)
            if held is None:
                held = tuple(i for f in word_features(word) if (i := self.index.get(f)) is not None)
                self.known[word] = held
            if held:
                found.update(held)
        return sorted(found)


def fit_ordinal(rows: list[list[int]], grades: np.ndarray, width: int, steps: int = 500, l2: float = 1e-5) -> Ordinal:
    """Maximum likelihood by Adam over sparse 0/1 rows; thresholds stay ordered by positive gaps."""
    top = int(grades.max())
    lengths = np.array([len(r) for r in rows])
    columns = np.fromiter((c for r in rows for c in r), np.int64, lengths.sum())
    owner = np.repeat(np.arange(len(rows)), lengths)
    # parameters: weights, first threshold, logs of the gaps between thresholds
    p = np.zeros(width + top)
    shares = np.array([np.clip((grades >= k).mean(), 1e-4, 1 - 1e-4) for k in range(1, top + 1)])
    starts = np.log((1 - shares) / shares)
    p[width] = starts[0]
    p[width + 1 :] = np.log(np.maximum(np.diff(starts), 0.1))
    m, v = np.zeros_like(p), np.zeros_like(p)
    at = np.arange(len(grades))
    for step in range(1, steps + 1):
        gaps = np.exp(p[width + 1 :])
        thresholds = p[width] + np.r_[0.0, np.cumsum(gaps)]
        scores = np.bincount(owner, p[:width][columns], len(rows))
        c = 1 / (1 + np.exp(-np.clip(scores[:, None] - thresholds, -40, 40)))
        c = np.c_[np.ones(len(rows)), c, np.zeros(len(rows))]
        here, above = c[at, grades], c[at, grades + 1]
        likely = np.maximum(here - above, 1e-12)
        by_score = -(1 - here - above) / len(rows)
        by_threshold = np.zeros(top + 2)
        np.add.at(by_threshold, grades, here * (1 - here) / likely)
        np.add.at(by_threshold, grades + 1, -above * (1 - above) / likely)
        by_threshold = by_threshold[1 : top + 1] / len(rows)
        g = np.empty_like(p)
        g[:width] = np.bincount(columns, by_score[owner], width) + l2 * p[:width]
        g[width] = by_threshold.sum()
        g[width + 1 :] = [by_threshold[k + 1 :].sum() * gaps[k] for k in range(top - 1)]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        p -= 0.2 * (1 - step / (steps + 1)) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return Ordinal({}, p[:width], p[width] + np.r_[0.0, np.cumsum(np.exp(p[width + 1 :]))])


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """Stored (text, toxic): at most ``rows`` labelled rows with distinct texts; a repeated label counts as its worst."""
    votes = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = votes.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    joined = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").where("text IS NOT NULL")
    return stored(joined.groupBy("text").agg(F.max("toxic").cast("int").alias("toxic")), "labelled")


def train(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Ordinal:
    """Model from documents and 0/1 labels.

    The labels only say toxic or not. Grades are 0 for not toxic, and 1 or 2 for the lower and upper
    half of the toxic rows by the number of chosen features that toxic rows have more often.
    Without labels of both kinds the model calls nothing toxic (all 0) or everything (all 1).
    """
    sample = labelled_sample(docs, labels, rows)
    n = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    clean, toxic = n.get(0, 0), sum(v for k, v in n.items() if k)
    if not clean or not toxic:
        return Ordinal(thresholds=np.full(1, -30.0 if toxic else 30.0))
    counts = sample.mapInArrow(_count_batches, "feature string, toxic bigint, other bigint")
    totals = counts.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    rate = (F.col("toxic") + F.col("other")) / F.lit(float(clean + toxic))
    spread = F.sqrt(rate * (1 - rate) * F.lit(1 / clean + 1 / toxic)) + F.lit(1e-12)
    z = (F.col("toxic") / F.lit(float(toxic)) - F.col("other") / F.lit(float(clean))) / spread
    best = (
        totals.where(F.col("toxic") + F.col("other") >= LEAST_ROWS)
        .withColumn("z", z)
        .where(F.abs("z") >= LEAST_Z)
        .orderBy(F.abs("z").desc(), "feature")
        .limit(FEATURES)
        .collect()
    )
    index = {r["feature"]: i for i, r in enumerate(best)}
    toxic_side = np.array([r["z"] > 0 for r in best], bool)

    def sparse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(index)
        for batch in pieces(batches):
            found = [scorer.features(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.list_(pa.int32())), batch.column(1)], names=["features", "toxic"]
            )

    fitted = sample.select("text", "toxic").mapInArrow(sparse, "features array<int>, toxic int").collect()
    features = [r["features"] for r in fitted]
    marked = np.array([r["toxic"] > 0 for r in fitted])
    evidence = np.array([toxic_side[f].sum() if f else 0 for f in features])
    grades = np.where(marked, 1 + (evidence > np.median(evidence[marked])), 0).astype(np.int64)
    model = fit_ordinal(features, grades, len(index))
    model.index = index
    return model


def _scored(model: Ordinal) -> Callable[[list[str | None]], tuple[np.ndarray, np.ndarray]]:
    scorer = Scorer(model.index)

    def score(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        sums = np.array([model.weights[f].sum() if (f := scorer.features(t)) else 0.0 for t in texts])
        above = model.at_least(sums)
        return above.sum(axis=1), above

    return score


def severity(docs: DataFrame, model: Ordinal) -> DataFrame:
    """doc_id, severity (expected grade), p_toxic, grade (most likely), rejected (p_toxic >= 0.5): a row per row.

    Defined cases: a null, empty or wordless text has no features and the severity of the
    intercepts; a null doc_id stays null; repeated rows get equal results; other columns are not read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def go(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _scored(model)
        for batch in pieces(batches):
            expected, above = score(batch.column(1).to_pylist())
            cumulative = np.c_[np.ones(len(above)), above, np.zeros(len(above))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(expected),
                    pa.array(above[:, 0].copy()),
                    pa.array((cumulative[:, :-1] - cumulative[:, 1:]).argmax(axis=1).astype(np.int32)),
                    pa.array(above[:, 0] >= 0.5),
                ],
                names=["doc_id", "severity", "p_toxic", "grade", "rejected"],
            )

    schema = f"doc_id {kind}, severity double, p_toxic double, grade int, rejected boolean"
    return docs.select("doc_id", "text").mapInArrow(go, schema)


def drop_toxic(docs: DataFrame, model: Ordinal) -> DataFrame:
    """``docs`` without the rows whose P(grade >= 1) reaches one half; all columns kept, no shuffle.

    Only texts go to Python, and one boolean for each comes back. A null, empty or wordless text has the
    chance of the intercepts; repeated rows go or stay together; an empty table stays empty.
    """

    @F.arrow_udf("boolean")
    def toxic(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        release()
        score = _scored(model)
        for texts in batches:
            parts = [score(p.column(0).to_pylist())[1][:, 0] >= 0.5 for p in pieces([pa.RecordBatch.from_arrays([texts], ["t"])])]
            yield pa.array(np.concatenate([np.empty(0, bool), *parts]))
            pa.default_memory_pool().release_unused()

    return docs.where(~toxic(F.col("text")))
