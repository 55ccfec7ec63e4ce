"""Tokens of texts counted by Arrow batches, and values of an array's items from a table that every task holds."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The helper travels with the job, so executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_KINDS = {"int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "string": pa.string()}

# Bytes of texts that are cut at one time.
TEXT_BYTES = 1 << 22
_IN_TOKEN = np.zeros(256, bool)
_IN_TOKEN[[*b"abcdefghijklmnopqrstuvwxyz0123456789"]] = True


def text_parts(texts: pa.Array) -> Iterator[pa.Array]:
    """A batch of texts in slices of about TEXT_BYTES, one text at least; null is empty."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    parts = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)) // TEXT_BYTES
    ends = [*(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(texts)]
    for start, end in zip([0, *ends[:-1]], ends, strict=True):
        yield texts.slice(start, end - start)


def cut_tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """``tokens_of`` the texts, all bytes of the texts, and where among them each token starts."""
    if not len(texts):
        return pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(0, np.uint8), np.zeros(0, np.int64)
    _, offsets, raw = texts.buffers()
    offsets = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(raw or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    inside = _IN_TOKEN[raw]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    firsts = offsets[:-1][offsets[:-1] < len(raw)]
    starts[firsts] = inside[firsts]
    at = np.flatnonzero(starts)
    letters = raw[inside]
    borders = np.r_[np.cumsum(inside, dtype=np.int32)[at] - 1, len(letters)].astype(np.int32)
    found = pa.StringArray.from_buffers(len(at), pa.py_buffer(borders), pa.py_buffer(letters))
    return found, np.searchsorted(at, offsets[1:]), raw, at


def tokens_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Tokens (runs of a-z0-9) of lower-cased texts one after another, and how many there are up to the end of each text."""
    return cut_tokens(texts)[:2]


def _row_items(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct tokens of all texts; the distinct ones of each text as row * tokens + token, and how often each occurs there."""
    flat, ends = tokens_of(texts)
    coded = flat.dictionary_encode()
    rows = np.repeat(np.arange(len(texts)), np.diff(ends, prepend=0))
    each, n = np.unique(rows * max(len(coded.dictionary), 1) + coded.indices.to_numpy(), return_counts=True)
    return coded.dictionary, each, n


def counts_of(texts: pa.Array) -> pa.Array:
    """Distinct tokens of each lower-cased text with how often each occurs: arrays of (item, n)."""
    names, each, n = _row_items(texts)
    size = max(len(names), 1)
    counted = pa.StructArray.from_arrays([names.take(pa.array(each % size)), pa.array(n, pa.int32())], ["item", "n"])
    starts = np.searchsorted(each, np.arange(len(texts) + 1) * size)
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), counted)


def token_counts(text: Column) -> Column:
    """Distinct tokens of a text with how often each occurs, as an array of (item, n); a null text has none."""

    @F.arrow_udf("array<struct<item: string, n: int>>")
    def counted(texts: pa.Array) -> pa.Array:
        return pa.concat_arrays([counts_of(part) for part in text_parts(texts)])

    # keeps the planner from copying the call into the expressions that use it
    return counted.asNondeterministic()(F.lower(text))


def _total_batches(batches: Iterable[pa.RecordBatch], once: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_parts(batch.column(0)):
            if once:
                names, each, _ = _row_items(part)
                at = each % max(len(names), 1)
            else:
                coded = tokens_of(part)[0].dictionary_encode()
                names, at = coded.dictionary, coded.indices.to_numpy()
            totals = np.bincount(at, minlength=len(names))
            yield pa.RecordBatch.from_arrays([names, pa.array(totals)], names=["token", "n"])


def token_totals(df: DataFrame, text: str, once: bool = False) -> DataFrame:
    """(token, n): how often every token occurs in all texts, or (``once``) in how many rows.

    Tokens are counted within slices of a task's texts before Spark adds their counts up.
    """
    found = df.select(F.lower(F.col(text)).alias("text")).mapInArrow(partial(_total_batches, once=once), "token string, n bigint")
    return found.groupBy("token").agg(F.sum("n").alias("n"))


def values_of(items: pa.Array, known: dict, default: object, kind: pa.DataType) -> pa.Array:
    """Arrays of the items' values; each distinct item of a batch is looked up once, a null array gives an empty one."""
    flat = items.flatten().dictionary_encode()
    found = pa.array([known.get(item, default) for item in flat.dictionary.to_pylist()], kind)
    values = pc.fill_null(found.take(flat.indices), default)
    ends = np.cumsum(pc.fill_null(pc.list_value_length(items), 0).to_numpy(zero_copy_only=False))
    return pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), values)


def common_and_rare(items: pa.Array, known: dict, default: object, kind: pa.DataType) -> pa.Array:
    """(values, rare) of each array: its items' values, null for those the table lacks, and these items in their order."""
    flat = items.flatten()
    coded = flat.dictionary_encode()
    names = coded.dictionary.to_pylist()
    values = [default if (v := known.get(item)) is None else v for item in names]
    lacks = np.array([item not in known for item in names] + [False])
    at = pc.fill_null(coded.indices, len(names)).to_numpy(zero_copy_only=False)
    rare = lacks[at] if len(at) else np.zeros(0, bool)
    found = pa.array([*values, default], kind).take(pa.array(at, pa.int32(), mask=rare))
    ends = np.r_[0, np.cumsum(pc.fill_null(pc.list_value_length(items), 0).to_numpy(zero_copy_only=False))]
    before = np.r_[0, np.cumsum(rare)]
    return pa.StructArray.from_arrays(
        [
            pa.ListArray.from_arrays(pa.array(ends, pa.int32()), found),
            pa.ListArray.from_arrays(pa.array(before[ends], pa.int32()), flat.filter(pa.array(rare))),
        ],
        ["values", "rare"],
    )


def common_values(table: Broadcast, default: object, kind: str, item_kind: str) -> Callable[[Column], Column]:
    """Column function: array of items to (values, rare) by the common part of a larger table."""
    arrow = _KINDS[kind]

    @F.arrow_udf(f"struct<values: array<{kind}>, rare: array<{item_kind}>>")
    def found(items: pa.Array) -> pa.Array:
        return common_and_rare(items, table.value, default, arrow)

    return found.asNondeterministic()


def filled_values(kind: str) -> Callable[[Column, Column], Column]:
    """Column function: arrays with nulls, and for each of them the values that belong there in their order."""

    @F.arrow_udf(f"array<{kind}>")
    def filled(values: pa.Array, fills: pa.Array) -> pa.Array:
        flat = values.flatten()
        whole = pc.replace_with_mask(flat, pc.is_null(flat), fills.flatten())
        ends = np.cumsum(pc.list_value_length(values).to_numpy(zero_copy_only=False))
        return pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), whole)

    return filled


def item_values(table: Broadcast, default: object, kind: str) -> Callable[[Column], Column]:
    """Column function: array of items to the array of their values."""
    arrow = _KINDS[kind]

    @F.arrow_udf(f"array<{kind}>")
    def found(items: pa.Array) -> pa.Array:
        return values_of(items, table.value, default, arrow)

    # keeps the planner from copying the call into the expressions that use it
    return found.asNondeterministic()
