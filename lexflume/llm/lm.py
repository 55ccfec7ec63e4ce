"""LM scoring by a log-bilinear neural model trained with noise-contrastive estimation.

Word counts are gathered over all training rows. The most frequent words are classes of their own;
all others share classes by their last two letters, within which a word's share is its count plus
one (one more for words never seen). The model predicts the next class from the embeddings of the
two before it: ``score(w | h) = (sum_j c_j * r_hj) . q_w + b_w``. Replicas are trained in numpy on
the partitions of all training rows and averaged; scoring normalises over all classes by
batched matrix products, so the probabilities of all words sum to one.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexflume.llm.texts import lowered, pieces, words
from lexflume.session import stored

END = "\n"  # cannot be a word
TOP_WORDS = 1024
BUCKETS = 256
CLASSES = TOP_WORDS + BUCKETS
# Words whose counts every task holds; those of all others are joined.
DICTIONARY = 131_072
COUNTED_WORDS = 100_000
WIDTH = 16
CONTEXT = 2
BATCH = 4096
# Contexts normalised at one time: their scores over all classes stay near the processor.
NORMALISED = 256
NOISE = 32
LEARNING_RATE = 0.05
ROUNDS = 2
BLOCK = 64
SEED = 11
LN10 = float(np.log(10.0))


def held_out(key: Column) -> Column:
    """Whether a row is kept from training: crc32 of its id as text, modulo 7, is 2."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(7)) == 2, F.lit(False))


def bucket(word: str) -> int:
    """Class of a word that is none itself, by its last two letters."""
    return TOP_WORDS + zlib.crc32(word[-2:].encode()) % BUCKETS


def _count_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def flushed() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays(
            [pa.array(list(counts.keys()), pa.binary()).cast(pa.string()), pa.array(list(counts.values()), pa.int64())],
            names=["word", "n"],
        )
        counts.clear()
        return out

    for batch in pieces(batches):
        for text in lowered(batch.column(0)):
            counts.update(words(text))
        counts[END.encode()] += batch.num_rows
        if len(counts) > COUNTED_WORDS:
            yield flushed()
    if counts:
        yield flushed()


def word_counts(docs: DataFrame) -> DataFrame:
    """Stored (word, c) over all training rows, the end of a text being the word ``\\n``."""
    partial = docs.select("text").mapInArrow(_count_batches, "word string, n bigint")
    return stored(partial.groupBy("word").agg(F.sum("n").alias("c")), "word-counts")


@dataclass(frozen=True)
class Lexicon:
    """What tasks know of the corpus: totals, the frequent words with their counts, sums of class buckets."""

    total: int
    distinct: int
    words: list[str]
    counts: list[int]
    bucket_sums: list[float]
    class_counts: list[float]

    @property
    def base_log(self) -> float:
        return float(np.log10(self.total + self.distinct + 1))


def lexicon(counts: DataFrame) -> Lexicon:
    """Bounded by DICTIONARY words and CLASSES sums."""
    totals = counts.agg(F.sum("c"), F.count(F.lit(1))).first()
    frequent = counts.orderBy(F.col("c").desc(), "word").limit(DICTIONARY).collect()
    names, held = [r["word"] for r in frequent], [r["c"] for r in frequent]
    top = frequent[:TOP_WORDS]
    # buckets: sums over all words, less the words that are classes themselves
    number = F.pmod(F.crc32(F.right("word", F.lit(2)).cast("binary")), F.lit(BUCKETS))
    sums = np.ones(BUCKETS)
    mass = np.zeros(BUCKETS)
    for r in counts.groupBy(number.alias("b")).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("n")).collect():
        sums[r["b"]] += r["c"] + r["n"]
        mass[r["b"]] += r["c"]
    for r in top:
        b = bucket(r["word"]) - TOP_WORDS
        sums[b] -= r["c"] + 1
        mass[b] -= r["c"]
    classes = [float(r["c"]) for r in top] + [0.0] * (TOP_WORDS - len(top)) + mass.tolist()
    return Lexicon(totals[0] or 0, totals[1] or 0, names, held, sums.tolist(), classes)


def _map_batches(batches: Iterable[pa.RecordBatch], lex: Lexicon) -> Iterator[pa.RecordBatch]:
    index = {w.encode(): i for i, w in enumerate(lex.words)}
    logs = np.log10(np.array(lex.counts + [0], float) + 1)  # of an unknown word 0: added by the join
    known = np.array([1] * len(lex.words) + [0])
    classes = np.array([i if i < TOP_WORDS else bucket(w) for i, w in enumerate(lex.words)] + [0])
    within = np.concatenate([np.zeros(TOP_WORDS), np.log10(np.array(lex.bucket_sums))])
    end = index.get(END.encode(), -1)
    end_class = classes[end] if end >= 0 else bucket(END)
    for batch in pieces(batches, size=2 << 20):
        rows = []
        for text in lowered(batch.column(2)):
            found = words(text)
            at = np.fromiter(map(index.get, found, repeat(-1)), np.int64, len(found))
            at = np.append(at, end)
            cls = classes[at]
            rare: Counter = Counter()
            for i in np.flatnonzero(at[:-1] < 0):
                word = found[i].decode("utf-8", "replace")
                cls[i] = bucket(word)
                rare[word] += 1
            cls[-1] = end_class
            inner = cls >= TOP_WORDS
            rows.append((
                len(at), int(known[at].sum()), float(logs[at].sum() - len(at) * lex.base_log),
                float(logs[at][inner].sum() - within[cls].sum()), cls.astype(np.uint16).tobytes(), list(rare.items()),
            ))
        columns = list(zip(*rows, strict=True))
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.map_(pa.string(), pa.int64())]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(3), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
            names=["uid", "doc_id", "held_out", "n_tokens", "n_known", "base", "inner", "classes", "rare"],
        )


@dataclass
class Bilinear:
    """Context vectors, their position weights, class vectors and biases."""

    context: np.ndarray  # (CLASSES + 1, WIDTH); the last is what stands before a text
    position: np.ndarray  # (CONTEXT, WIDTH)
    target: np.ndarray  # (CLASSES, WIDTH)
    bias: np.ndarray  # (CLASSES,)
    norms: np.ndarray | None = None  # of the contexts met so far; a model that still learns must not keep any

    @classmethod
    def fresh(cls, log_unigram: np.ndarray) -> Bilinear:
        r = np.random.default_rng(SEED)
        return cls(
            r.normal(0, 0.1, (CLASSES + 1, WIDTH)), np.ones((CONTEXT, WIDTH)), r.normal(0, 0.1, (CLASSES, WIDTH)), log_unigram.copy()
        )

    def parts(self) -> list[np.ndarray]:
        return [self.context, self.position, self.target, self.bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    @classmethod
    def of_flat(cls, values: np.ndarray) -> Bilinear:
        shapes = [(CLASSES + 1, WIDTH), (CONTEXT, WIDTH), (CLASSES, WIDTH), (CLASSES,)]
        cuts = np.cumsum([int(np.prod(s)) for s in shapes])[:-1]
        return cls(*(v.reshape(s).copy() for v, s in zip(np.split(values, cuts), shapes, strict=True)))

    def predicted(self, before: np.ndarray) -> np.ndarray:
        return sum(self.context[before[:, j]] * self.position[j] for j in range(CONTEXT))

    def log_norms(self, before: np.ndarray) -> np.ndarray:
        """Log of the normaliser of each context, by matrix products over distinct contexts not met before.

        The table of all contexts has a fixed size (6.6 MB): a task normalises each context once.
        """
        if self.norms is None:
            self.norms = np.full((CLASSES + 1) ** CONTEXT, np.nan, np.float32)
        codes = before[:, 0].copy()
        for j in range(1, CONTEXT):
            codes += before[:, j] * (CLASSES + 1) ** j
        fresh = codes[np.isnan(self.norms[codes])]
        if len(fresh):
            marked = np.zeros(len(self.norms), bool)
            marked[fresh] = True
            fresh = np.flatnonzero(marked)
            target, bias = self.target.astype(np.float32).T.copy(), self.bias.astype(np.float32)
            for a in range(0, len(fresh), NORMALISED):
                part = fresh[a : a + NORMALISED]
                contexts = np.stack([part // (CLASSES + 1) ** j % (CLASSES + 1) for j in range(CONTEXT)], axis=1)
                scores = self.predicted(contexts).astype(np.float32) @ target
                scores += bias
                top = scores.max(axis=1, keepdims=True)
                scores -= top
                self.norms[part] = top[:, 0] + np.log(np.exp(scores, out=scores).sum(axis=1))
        return self.norms[codes]

    def log_probabilities(self, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        scores = np.einsum("ij,ij->i", self.predicted(before), self.target[after]) + self.bias[after]
        return scores - self.log_norms(before)


def contexts(classes: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(the CONTEXT classes before, class) of every token of a text."""
    after = np.frombuffer(classes, np.uint16).astype(np.int64)
    padded = np.concatenate([np.full(CONTEXT, CLASSES), after])
    return np.stack([padded[CONTEXT - 1 - j : len(padded) - 1 - j] for j in range(CONTEXT)], axis=1), after


def _summed(rows: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    return np.stack([np.bincount(rows, values[:, i], size) for i in range(values.shape[1])], axis=1)


def nce_step(model: Bilinear, before: np.ndarray, after: np.ndarray, noise: np.ndarray, log_noise: np.ndarray, squares: list[np.ndarray]) -> None:
    """One AdaGrad step of noise-contrastive estimation; the batch shares its noise samples."""
    h = model.predicted(before)
    shift = np.log(len(noise)) + log_noise
    true = np.einsum("ij,ij->i", h, model.target[after]) + model.bias[after] - shift[after]
    false = h @ model.target[noise].T + model.bias[noise] - shift[noise]
    g_true = -1 / (1 + np.exp(np.clip(true, -30, 30)))
    g_false = 1 / (1 + np.exp(np.clip(-false, -30, 30)))
    by_h = g_true[:, None] * model.target[after] + g_false @ model.target[noise]
    n = len(after)
    g_target = _summed(after, g_true[:, None] * h, CLASSES)
    np.add.at(g_target, noise, g_false.T @ h)
    g_bias = np.bincount(after, g_true, CLASSES)
    np.add.at(g_bias, noise, g_false.sum(axis=0))
    g_context = sum(_summed(before[:, j], by_h * model.position[j], CLASSES + 1) for j in range(CONTEXT))
    g_position = np.stack([(by_h * model.context[before[:, j]]).sum(axis=0) for j in range(CONTEXT)])
    for p, g, s in zip(model.parts(), (g_context, g_position, g_target, g_bias), squares, strict=True):
        g /= n
        s += g * g
        p -= LEARNING_RATE * g / (np.sqrt(s) + 1e-8)


def _train_batches(batches: Iterable[pa.RecordBatch], flat: np.ndarray, log_noise: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A replica trained on all tokens of the partition, as weighted blocks of parameters."""
    model = Bilinear.of_flat(flat)
    squares = [np.zeros_like(p) for p in model.parts()]
    chance = np.exp(log_noise)
    chance /= chance.sum()
    r = np.random.default_rng(SEED)
    tokens, waiting, size = 0, [], 0

    def learn(held: list[tuple[np.ndarray, np.ndarray]]) -> None:
        before, after = np.concatenate([b for b, _ in held]), np.concatenate([a for _, a in held])
        order = r.permutation(len(after))
        for a in range(0, len(order), BATCH):
            pick = order[a : a + BATCH]
            nce_step(model, before[pick], after[pick], r.choice(CLASSES, NOISE, p=chance), log_noise, squares)

    for batch in pieces(batches):
        for classes in batch.column(0).to_pylist():
            pair = contexts(classes)
            waiting.append(pair)
            size += len(pair[1])
            tokens += len(pair[1])
            if size >= 64 * BATCH:
                learn(waiting)
                waiting, size = [], 0
    if waiting:
        learn(waiting)
    if tokens:
        values = model.flat()
        cuts = np.array_split(values, BLOCK)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(BLOCK), pa.int32()), pa.array([tokens] * BLOCK, pa.int64()), pa.array([c.tobytes() for c in cuts], pa.binary())],
            names=["block", "tokens", "params"],
        )


def _average(rows: pd.DataFrame) -> pd.DataFrame:
    total = rows["tokens"].sum()
    mean = sum(np.frombuffer(v, np.float64) * (n / total) for v, n in zip(rows["params"], rows["tokens"], strict=True))
    return pd.DataFrame({"block": [rows["block"].iloc[0]], "tokens": [total], "params": [mean.tobytes()]})


def train(mapped: DataFrame, lex: Lexicon) -> Bilinear:
    """Model from all training rows of ``mapped``: each round trains on its share of rows and averages replicas.

    Replicas meet block by block in Spark; one averaged set of parameters reaches the driver.
    """
    mass = np.array(lex.class_counts) + 0.5
    log_unigram = np.log(mass / mass.sum())
    model = Bilinear.fresh(log_unigram)
    for turn in range(ROUNDS):
        flat = model.flat()
        share = mapped.where(~F.col("held_out") & (F.pmod(F.xxhash64("uid"), F.lit(ROUNDS)) == turn)).select("classes")
        replicas = share.mapInArrow(
            lambda batches, flat=flat: _train_batches(batches, flat, log_unigram), "block int, tokens bigint, params binary"
        )
        blocks = replicas.groupBy("block").applyInPandas(_average, "block int, tokens bigint, params binary").collect()
        if blocks:
            blocks.sort(key=lambda r: r["block"])
            model = Bilinear.of_flat(np.concatenate([np.frombuffer(b["params"], np.float64) for b in blocks]))
    return model


def _score_batches(batches: Iterable[pa.RecordBatch], flat: np.ndarray) -> Iterator[pa.RecordBatch]:
    model = Bilinear.of_flat(flat)
    for batch in pieces(batches, size=1 << 20):
        pairs = [contexts(c) for c in batch.column(1).to_pylist()]
        logs = model.log_probabilities(np.concatenate([b for b, _ in pairs]), np.concatenate([a for _, a in pairs]))
        starts = np.cumsum([0] + [len(a) for _, a in pairs[:-1]])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.add.reduceat(logs, starts) / LN10)], names=["uid", "model"]
        )


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: a row per row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the A-Z-lower-cased whole text, then one end of text. Scores
    are log10 probabilities of the whole text. Defined cases: a null or empty text is its end alone;
    a null doc_id trains; repeated rows count as often as they stand there; without training rows
    all words are unknown; an empty table gives an empty result; other columns are not read.
    """
    out = held_out(F.col("doc_id"))
    counts = word_counts(docs.where(~out))
    lex = lexicon(counts)
    kind = docs.schema["doc_id"].dataType.simpleString()
    numbered = docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "text", out.alias("held_out"))
    shared = docs.sparkSession.sparkContext.broadcast(lex)
    mapped = stored(
        numbered.mapInArrow(
            lambda batches: _map_batches(batches, shared.value),
            f"uid bigint, doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base double, inner double, "
            "classes binary, rare map<string,bigint>",
        ),
        "lm-tokens",
    )
    flat = train(mapped, lex).flat()
    modelled = mapped.select("uid", "classes").mapInArrow(
        lambda batches: _score_batches(batches, flat), "uid bigint, model double"
    )
    rare = mapped.select("uid", F.explode("rare").alias("word", "n")).join(counts, "word")
    sums = rare.groupBy("uid").agg(
        F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("logs"), F.sum("n").alias("more")
    )
    whole = mapped.drop("classes", "rare").join(modelled, "uid").join(sums, "uid", "left")
    logs = F.coalesce("logs", F.lit(0.0))
    return whole.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(lex.total).cast("bigint").alias("train_tokens"),
        (F.col("base") + logs).alias("base_score"),
        (F.col("model") + F.col("inner") + logs).alias("score"),
    )
