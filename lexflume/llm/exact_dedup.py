"""Exact deduplication by counting quotient filters.

Every partition folds the 64-bit fingerprints of its texts into counting quotient filters, one per
slice of the fingerprint space. Filters of a slice merge losslessly: their entries are sorted by
(quotient, remainder), so merging is a merge of sorted runs with counts added. Fingerprints with a
count above one send their texts to verification, where equal means equal bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexflume.llm.relations import attach, columns_of, keep_where
from lexflume.llm.texts import lowered, pieces
from lexflume.session import stored

# A fingerprint is [slice | quotient | remainder]; a filter covers one slice with 2**QUOTIENT_BITS runs.
QUOTIENT_BITS = 8
# Slices follow the rows, so that a merged filter stays at some ROWS_PER_SLICE entries.
ROWS_PER_SLICE = 200_000
LEAST_SLICE_BITS = 8
# Bits of the broadcast route map (16 MiB). Texts whose fingerprint prefix is unmarked cannot repeat.
# With more repeats than bits every text is routed: slower, same result.
ROUTE_BITS = 27
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FILTER_SCHEMA = "slice bigint, occupied binary, runs binary, remainders binary, counts binary"


class QuotientFilter:
    """Counting quotient filter of one slice: occupied quotients, run lengths, sorted remainders, counts."""

    def __init__(self, occupied: np.ndarray, runs: np.ndarray, remainders: np.ndarray, counts: np.ndarray):
        self.occupied, self.runs, self.remainders, self.counts = occupied, runs, remainders, counts

    @classmethod
    def of_entries(cls, entries: np.ndarray, counts: np.ndarray, remainder_bits: int) -> QuotientFilter:
        """Filter of sorted distinct (quotient, remainder) entries with their counts."""
        quotients = (entries >> np.uint64(remainder_bits)).astype(np.int64)
        present, runs = np.unique(quotients, return_counts=True)
        occupied = np.zeros(1 << QUOTIENT_BITS, bool)
        occupied[present] = True
        return cls(occupied, runs, entries & np.uint64((1 << remainder_bits) - 1), counts)

    def entries(self, remainder_bits: int) -> np.ndarray:
        """The sorted (quotient, remainder) entries; nothing was lost."""
        quotients = np.repeat(np.flatnonzero(self.occupied), self.runs).astype(np.uint64)
        return (quotients << np.uint64(remainder_bits)) | self.remainders

    @classmethod
    def merged(cls, filters: list[QuotientFilter], remainder_bits: int) -> QuotientFilter:
        """Merge by sorted remainders; counts of equal entries add up."""
        entries = np.concatenate([f.entries(remainder_bits) for f in filters])
        counts = np.concatenate([f.counts for f in filters])
        order = np.argsort(entries, kind="stable")
        entries, counts = entries[order], counts[order]
        first = np.flatnonzero(np.r_[True, entries[1:] != entries[:-1]])
        return cls.of_entries(entries[first], np.add.reduceat(counts, first), remainder_bits)

    def to_row(self) -> tuple[bytes, bytes, bytes, bytes]:
        return (
            np.packbits(self.occupied).tobytes(),
            self.runs.astype(np.uint32).tobytes(),
            self.remainders.tobytes(),
            self.counts.astype(np.int64).tobytes(),
        )

    @classmethod
    def of_row(cls, occupied: bytes, runs: bytes, remainders: bytes, counts: bytes) -> QuotientFilter:
        return cls(
            np.unpackbits(np.frombuffer(occupied, np.uint8)).astype(bool),
            np.frombuffer(runs, np.uint32).astype(np.int64),
            np.frombuffer(remainders, np.uint64),
            np.frombuffer(counts, np.int64),
        )


def partition_filters(fingerprints: np.ndarray, slice_bits: int) -> Iterator[tuple[int, QuotientFilter]]:
    """The filters of one partition's fingerprints, by slice."""
    below = 64 - slice_bits
    values, counts = np.unique(fingerprints, return_counts=True)
    slices = (values >> np.uint64(below)).astype(np.int64)
    starts = np.flatnonzero(np.r_[True, slices[1:] != slices[:-1]]) if len(values) else []
    mask = np.uint64((1 << below) - 1)
    for begin, end in zip(starts, [*starts[1:], len(values)], strict=True):
        yield (
            int(slices[begin]),
            QuotientFilter.of_entries(values[begin:end] & mask, counts[begin:end], below - QUOTIENT_BITS),
        )


def _digest_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches):
        texts = lowered(batch.column(1))
        prints = np.fromiter((xxhash.xxh64_intdigest(t) for t in texts), np.uint64, len(texts))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(prints.view(np.int64)), pa.array([hashlib.sha256(t).hexdigest() for t in texts])],
            names=["doc_id", "print", "sha"],
        )


def _filter_batches(batches: Iterable[pa.RecordBatch], slice_bits: int) -> Iterator[pa.RecordBatch]:
    prints = [b.column(0).to_numpy(zero_copy_only=False) for b in batches]
    if prints:
        built = list(partition_filters(np.concatenate(prints).view(np.uint64), slice_bits))
        columns = [[s for s, _ in built], *zip(*(f.to_row() for _, f in built), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), *(pa.array(c, pa.binary()) for c in columns[1:])],
            names=["slice", "occupied", "runs", "remainders", "counts"],
        )


def _merge_slice(rows: pa.Table, slice_bits: int) -> pa.Table:
    below = 64 - slice_bits
    merged = QuotientFilter.merged(
        [QuotientFilter.of_row(*r) for r in zip(*(rows.column(i).to_pylist() for i in range(1, 5)), strict=True)],
        below - QUOTIENT_BITS,
    )
    entries = merged.entries(below - QUOTIENT_BITS) | (np.uint64(rows.column(0)[0].as_py()) << np.uint64(below))
    repeated = merged.counts > 1
    return pa.table({"print": entries[repeated].view(np.int64), "n": merged.counts[repeated]})


def _routed_batches(batches: Iterable[pa.RecordBatch], route: object) -> Iterator[pa.RecordBatch]:
    marks = np.frombuffer(route.value, np.uint8)
    for batch in pieces(batches):
        texts = lowered(batch.column(1))
        prints = np.fromiter((xxhash.xxh64_intdigest(t) for t in texts), np.uint64, len(texts))
        at = (prints >> np.uint64(64 - ROUTE_BITS)).astype(np.int64)
        chosen = np.flatnonzero((marks[at >> 3] >> (at & 7).astype(np.uint8)) & 1)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(pa.array(chosen)),
                pa.array(prints.view(np.int64)[chosen]),
                pa.array([texts[i] for i in chosen], pa.binary()),
            ],
            names=["doc_id", "print", "bytes"],
        )


def _route_map(repeated: DataFrame) -> bytes:
    """One bit per fingerprint prefix that repeats; at most 2**(ROUTE_BITS - 15) rows of 4 KiB reach the driver."""
    prefix = F.shiftrightunsigned("print", 64 - ROUTE_BITS)
    # bitmap functions count positions from 1
    rows = repeated.groupBy(F.bitmap_bucket_number(prefix + 1).alias("b")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(prefix + 1)).alias("bits")
    )
    marks = bytearray(1 << (ROUTE_BITS - 3))
    for b, bits in rows.toLocalIterator():
        marks[(b - 1) * len(bits) : b * len(bits)] = bits
    return bytes(marks)


def digests(docs: DataFrame) -> DataFrame:
    """Stored (doc_id, print, sha) of every row's normalised text."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return stored(
        docs.select("doc_id", "text").mapInArrow(_digest_batches, f"doc_id {kind}, print bigint, sha string"), "digests"
    )


def repeated_prints(prints: DataFrame) -> DataFrame:
    """Stored (print, n) of fingerprints that occur more than once, from merged quotient filters."""
    bits = max(LEAST_SLICE_BITS, (prints.count() // ROWS_PER_SLICE).bit_length())
    filters = prints.select("print").mapInArrow(partial(_filter_batches, slice_bits=bits), FILTER_SCHEMA)
    merged = filters.groupBy("slice").applyInArrow(lambda rows: _merge_slice(rows, bits), "print bigint, n bigint")
    return stored(merged, "repeated")


def classes(docs: DataFrame, prints: DataFrame) -> DataFrame:
    """Stored (sha, keep_id, group_size) of texts that occur more than once, verified byte by byte.

    Equal texts are combined within every task before they travel, so a group of any size arrives
    as one row per task.
    """
    repeated = repeated_prints(prints)
    spark = docs.sparkSession
    route = spark.sparkContext.broadcast(_route_map(repeated))
    kind = docs.schema["doc_id"].dataType.simpleString()
    routed = docs.select("doc_id", "text").mapInArrow(
        partial(_routed_batches, route=route), f"doc_id {kind}, print bigint, bytes binary"
    )
    found = (
        routed.groupBy("print", "bytes")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .where("group_size > 1")
        .select(F.sha2("bytes", 256).alias("sha"), "keep_id", "group_size")
    )
    return stored(found, "classes")


def exact_duplicates(docs: DataFrame, prints: DataFrame | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per row of ``docs``.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. The largest doc_id
    of a group stays. Defined cases: a null doc_id counts in its group and never wins against
    another; rows that repeat both the text and the winning doc_id are all marked kept
    (``drop_exact_duplicates`` leaves one of them); an empty table gives an empty result; columns
    besides doc_id and text are not looked at.
    """
    prints = digests(docs) if prints is None else prints
    found = classes(docs, prints).withColumn("_n", F.col("group_size"))
    joined = attach(prints.drop("print"), found, "sha", "_n", "doc_id")
    single = F.col("group_size").isNull()
    keep = F.when(single, F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one row per group of equal texts, all columns kept.

    Only rows whose doc_id occurs in a dropped or repeated row are looked at again, by their text.
    """
    prints = digests(docs)
    marked = stored(exact_duplicates(docs, prints), "marked")
    lost = marked.where("not kept").select("doc_id")
    again = prints.groupBy("doc_id", "sha").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id")
    touched = stored(lost.unionByName(again).distinct(), "touched")
    passed = keep_where(docs, touched, "doc_id", "left_anti")
    whole = keep_where(docs, touched, "doc_id", "left_semi").select(
        F.struct(*columns_of(docs)).alias("row"),
        F.sha2(F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER), 256).alias("sha"),
    )
    winners = marked.where("kept").select(F.col("doc_id").alias("keep"), F.col("text_sha256").alias("key")).distinct()
    stays = whole.join(winners, (F.col("sha") == F.col("key")) & F.col("row.doc_id").eqNullSafe(F.col("keep")), "left_semi")
    # of rows with an equal id and text always the same one stays
    one = stays.groupBy("sha").agg(F.min_by("row", F.sha2(F.to_json("row"), 256)).alias("row")).select("row.*")
    return passed.unionByName(one)
