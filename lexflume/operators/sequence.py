"""Sequence preparation: vocabulary, encoded rows, batches."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexflume.constants import (
    IGNORED_LABEL,
    MAX_DOCUMENT_LEN,
    MAX_TARGET_LEN,
    MAX_TEXT_LEN,
    PAD_ID,
    SEED,
    UNKNOWN_ID,
)
from lexflume.functions.hashing import seeded_key
from lexflume.functions.items import token_totals
from lexflume.functions.text import tokens
from lexflume.operators.distributed import global_position, sorted_position
from lexflume.operators.keyed import KeyedTable
from lexflume.session import stored


def build_vocab(df: DataFrame, text: str = "text", min_count: int = 1) -> DataFrame:
    """Token ids by descending frequency, then token; ids 0 and 1 are pad and unknown.

    Counts are combined in every task before the shuffle, so frequent tokens cost
    one row per task.
    """
    counts = token_totals(df, text).where(F.col("n") >= min_count)
    # stored, as ranking reads them several times: texts are cut into tokens once
    counts = stored(counts, "token-counts")
    placed = sorted_position(counts, "token", F.struct((-F.col("n")).alias("w"), F.col("token")))
    return placed.select("token", "n", (F.col("position") + UNKNOWN_ID).alias("id"))


def as_vocab(vocab: DataFrame | KeyedTable) -> KeyedTable:
    """A vocabulary ready for look-ups; make it once when many frames are encoded."""
    return vocab if isinstance(vocab, KeyedTable) else KeyedTable(vocab, "token", often=_often(vocab))


def _often(vocab: DataFrame) -> str | None:
    return "n" if "n" in vocab.columns else None


def _first_tokens(text: str, max_len: int) -> Column:
    """The first ``max_len`` tokens; none of a null text. What follows them is not cut."""
    # of the parts one may be empty at the start, and the last one may hold the uncut rest
    return F.coalesce(F.slice(tokens(F.col(text), max_len + 2), 1, max_len), F.array().cast("array<string>"))


def _with_ids(
    df: DataFrame, vocab: DataFrame | KeyedTable, text: str, max_len: int, out: str, keep: Sequence[str]
) -> DataFrame:
    """``keep`` and ``out``, the ids of the text's first ``max_len`` tokens."""
    found = as_vocab(vocab).look_up(df, _first_tokens(text, max_len), "id", UNKNOWN_ID, out, keep)
    return found.withColumn(out, F.col(out).cast("array<int>"))


def _padded(ids: str, max_len: int, pad: int) -> Column:
    return F.concat(ids, F.array_repeat(F.lit(pad), max_len - F.size(ids)))


def _mask(ids: str, max_len: int) -> Column:
    return F.concat(F.array_repeat(F.lit(1), F.size(ids)), F.array_repeat(F.lit(0), max_len - F.size(ids)))


def encode(
    df: DataFrame,
    vocab: DataFrame | KeyedTable,
    max_len: int = MAX_TEXT_LEN,
    key: str = "doc_id",
    text: str = "text",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Token ids cut and padded to the model's input length, with the attention mask.

    One row for every row of ``df``, whatever its key: equal and null keys stay apart. A null text
    has no tokens. With a small vocabulary rows stay where they are.
    """
    coded = _with_ids(df.select(key, *keep, F.col(text).alias("_text")), vocab, "_text", max_len, "_ids", [key, *keep])
    return coded.select(
        key, *keep, _padded("_ids", max_len, PAD_ID).alias("input_ids"), _mask("_ids", max_len).alias("attention_mask")
    )


def encode_target(
    df: DataFrame,
    vocab: DataFrame | KeyedTable,
    max_len: int = MAX_TARGET_LEN,
    key: str = "doc_id",
    text: str = "keywords_str",
) -> DataFrame:
    """Target ids as ``labels``; padded positions hold -100, which a loss leaves out."""
    coded = _with_ids(df.select(key, F.col(text).alias("_text")), vocab, "_text", max_len, "_ids", [key])
    return coded.select(key, _padded("_ids", max_len, IGNORED_LABEL).alias("labels"))


def encode_records(
    df: DataFrame,
    vocab: DataFrame | KeyedTable,
    key: str = "doc_id",
    document: str = "document",
    target: str = "keywords_str",
    max_document: int = MAX_DOCUMENT_LEN,
    max_target: int = MAX_TARGET_LEN,
) -> DataFrame:
    """Records of a sequence-to-sequence model: document ids, mask and target labels in one row.

    The tokens of both are looked up together.
    """
    cut = df.select(
        key, _first_tokens(document, max_document).alias("_d"), _first_tokens(target, max_target).alias("_t")
    ).withColumn("_n", F.size("_d"))
    coded = as_vocab(vocab).look_up(cut, F.concat("_d", "_t"), "id", UNKNOWN_ID, "_all", [key, "_n"])
    ids = F.col("_all").cast("array<int>")
    coded = coded.select(
        key, F.slice(ids, F.lit(1), F.col("_n")).alias("_ids"), F.slice(ids, F.col("_n") + 1, F.lit(max_target)).alias("_labels")
    )
    return coded.select(
        key,
        _padded("_ids", max_document, PAD_ID).alias("input_ids"),
        _mask("_ids", max_document).alias("attention_mask"),
        _padded("_labels", max_target, IGNORED_LABEL).alias("labels"),
    )


def decode_target(
    df: DataFrame, vocab: DataFrame, key: str = "doc_id", labels: str = "labels", keep: Sequence[str] = ()
) -> DataFrame:
    """Labels back to text: ignored positions and pads are dropped as ids; one row for every row of ``df``."""
    real = F.filter(labels, lambda x: ~x.isin(IGNORED_LABEL, PAD_ID)).cast("array<bigint>")
    often = _often(vocab)
    by_id = KeyedTable(vocab.select(F.col("id").cast("bigint").alias("id"), "token", *([often] if often else [])), "id", often=often)
    named = by_id.look_up(df.select(key, *keep, labels), real, "token", "<unk>", "_tokens", [key, *keep])
    return named.select(key, *keep, F.array_join("_tokens", " ").alias("decoded"))


def shuffle_and_batch(df: DataFrame, key: str, size: int, seed: int = SEED, shuffle: bool = True) -> DataFrame:
    """Number rows and batches, shuffled by a seeded key or in key order.

    Every batch has ``size`` rows but the last.
    """
    if shuffle:
        placed = global_position(df, seeded_key(F.col(key), seed), key)
    else:
        placed = sorted_position(df, key, F.struct(F.col(key)))
    return placed.withColumn("batch_id", F.floor((F.col("position") - 1) / size))


def batch_records(
    df: DataFrame, key: str, size: int, columns: Sequence[str], seed: int = SEED, shuffle: bool = True
) -> DataFrame:
    """Batches as a trainer takes them: one row per batch, with its rows' columns stacked in row order.

    ``batch_id``, ``n`` (rows, ``size`` but in the last batch), ``keys`` and, for every column, the array
    of its values. No group holds more than one batch, so memory is bounded by ``size`` rows.
    """
    # stored, as numbering reads the rows several times
    placed = shuffle_and_batch(stored(df.select(key, *columns), "records"), key, size, seed, shuffle)
    row = F.struct("position", F.col(key).alias("_key"), *columns)
    stacked = placed.groupBy("batch_id").agg(F.array_sort(F.collect_list(row)).alias("_rows"))
    return stacked.select(
        "batch_id",
        F.size("_rows").alias("n"),
        F.transform("_rows", lambda r: r["_key"]).alias("keys"),
        *[F.transform("_rows", partial(_field, c)).alias(c) for c in columns],
    )


def _field(name: str, row: Column) -> Column:
    return row[name]


def write_batches(batches: DataFrame, path: str, per_file: int = 1024) -> None:
    """Store batches in files of ``per_file`` batches, in order, each in the folder of its range."""
    ranged = batches.withColumn("range", F.floor(F.col("batch_id") / per_file))
    ordered = ranged.repartition("range").sortWithinPartitions("range", "batch_id")
    ordered.write.mode("overwrite").partitionBy("range").parquet(path)


def read_batches(spark: SparkSession, path: str, first: int = 0, last: int | None = None, per_file: int = 1024) -> DataFrame:
    """Stored batches ``first`` to ``last``; only the folders of their ranges are read."""
    found = spark.read.parquet(path).where((F.col("batch_id") >= first) & (F.col("range") >= first // per_file))
    if last is not None:
        found = found.where((F.col("batch_id") <= last) & (F.col("range") <= last // per_file))
    return found.drop("range")
