"""Language identification by hyperdimensional profiles.

Every letter has a random +-1 vector. A trigram is the product of its letters' vectors, permuted
(rotated) by their place; a document is the bundle (sum) of its trigrams, and a language the bundle
of its documents. A document has the language of the prototype with the largest cosine.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexflume.llm.texts import pieces
from lexflume.session import stored

DIMENSIONS = 1024
# Letters share this many vectors: a to z and the gap have their own, all others are dealt over the rest.
SYMBOLS = 64
SEED = 20240229
UNKNOWN = "und"


def held_out(key: Column) -> Column:
    """Whether a row is kept from training: crc32 of its id as text, modulo 3, is 1."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


@lru_cache(maxsize=1)
def symbol_table() -> np.ndarray:
    """Symbol of every code point: 0 for what is no letter, 1..26 for a-z of either case, then the others."""
    table = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        if chr(c).isalpha():
            low = chr(c).lower()
            first = ord(low[0])
            table[c] = first - 96 if 97 <= first <= 122 else 27 + first % (SYMBOLS - 27)
    return table


@lru_cache(maxsize=1)
def trigram_vectors() -> np.ndarray:
    """+-1 vector of every trigram of symbols."""
    letters = np.random.default_rng(SEED).choice(np.array([-1, 1], np.int8), (SYMBOLS, DIMENSIONS))
    first, second = np.roll(letters, 2, axis=1), np.roll(letters, 1, axis=1)
    bound = first[:, None, None, :] * second[None, :, None, :] * letters[None, None, :, :]
    return bound.reshape(SYMBOLS**3, DIMENSIONS)


def trigrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(trigram codes, counts) of a whole text; runs of other characters count as one gap."""
    points = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
    symbols = symbol_table()[points]
    if not symbols.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    symbols = np.concatenate([[0], symbols, [0]])
    symbols = symbols[np.r_[True, (symbols[1:] != 0) | (symbols[:-1] != 0)]].astype(np.int64)
    codes = (symbols[:-2] * SYMBOLS + symbols[1:-1]) * SYMBOLS + symbols[2:]
    counts = np.bincount(codes) if len(codes) > 4096 else None
    if counts is None:
        return np.unique(codes, return_counts=True)
    found = np.flatnonzero(counts)
    return found, counts[found]


def _count_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigram counts per language, combined over the whole partition."""
    sums: dict[str, np.ndarray] = {}
    for batch in pieces(batches):
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            codes, counts = trigrams(text)
            if len(codes):
                sums.setdefault(lang, np.zeros(SYMBOLS**3, np.int64))[codes] += counts
    for lang, counts in sums.items():
        codes = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(counts[codes])],
            names=["lang", "code", "n"],
        )


def prototypes(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and their unit prototypes from all rows of (text, lang).

    Counts per language and trigram are summed by Spark; languages times trigrams reach the driver,
    whatever the number of documents. Bundling is linear, so a prototype is counts times trigram
    vectors. The mean of all prototypes is taken off: what all languages share tells none.
    """
    counts = labelled.where("lang IS NOT NULL").mapInArrow(_count_batches, "lang string, code bigint, n bigint")
    sums = stored(counts.groupBy("lang", "code").agg(F.sum("n").alias("n")), "trigrams")
    names = sorted(r["lang"] for r in sums.select("lang").distinct().collect())
    vectors = np.zeros((len(names), DIMENSIONS))
    table = trigram_vectors()
    for i, name in enumerate(names):
        rows = sums.where(F.col("lang") == name).select("code", "n").toPandas()
        weights = rows["n"].to_numpy(np.float64) / rows["n"].sum()
        vectors[i] = weights @ table[rows["code"].to_numpy()].astype(np.float64)
    if len(names) > 1:
        vectors -= vectors.mean(axis=0)
    return names, vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)


def _predict_batches(
    batches: Iterable[pa.RecordBatch], names: list[str], vectors: np.ndarray
) -> Iterator[pa.RecordBatch]:
    table = trigram_vectors()
    turned = np.ascontiguousarray(vectors.T.astype(np.float32))
    for batch in pieces(batches):
        langs, scores = [], []
        for text in batch.column(1).to_pylist():
            codes, counts = trigrams(text)
            if not len(codes) or not names:
                langs.append(UNKNOWN)
                scores.append(0.0)
                continue
            bundle = counts.astype(np.float32) @ table[codes].astype(np.float32)
            cosines = bundle @ turned / max(float(np.linalg.norm(bundle)), 1e-12)
            best = int(cosines.argmax())
            langs.append(names[best])
            scores.append(min(1.0, max(0.0, (1.0 + float(cosines[best])) / 2)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
            names=["doc_id", "lang_pred", "score"],
        )


def identify(docs: DataFrame, names: list[str], vectors: np.ndarray) -> DataFrame:
    """doc_id, lang_pred, score (cosine moved to 0..1): a row per row of ``docs``, from whole texts.

    Defined cases: null texts and texts without a letter are ``und`` with score 0, and so is every
    text when no language was learned; ties go to the first language in order; a null doc_id stays
    null; repeated rows get equal results; other columns are not read. No shuffle.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        partial(_predict_batches, names=names, vectors=vectors), f"doc_id {kind}, lang_pred string, score double"
    )
