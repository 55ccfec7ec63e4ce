"""Byte-level text helpers for Arrow tasks."""

from __future__ import annotations

import gc
from collections.abc import Callable, Hashable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc

# What this Python worker remembers from task to task: one thing of one operator, as a session's workers serve them all.
_KEPT: dict[Hashable, object] = {}


def kept(key: Hashable, make: Callable[[], object]) -> object:
    """What an earlier task of this Python worker made under the key, or else made now; anything else is let go."""
    if key not in _KEPT:
        release()
        _KEPT[key] = make()
    return _KEPT[key]


def release() -> None:
    """Let go what tasks of other operators have left in this Python worker."""
    if _KEPT:
        _KEPT.clear()
        gc.collect()
    pa.default_memory_pool().release_unused()


def lowered(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of whole texts with A-Z lower-cased; null is empty."""
    return pc.ascii_lower(pc.fill_null(column.cast(pa.string()), "")).cast(pa.binary()).to_pylist()


def words(text: bytes) -> list[bytes]:
    r"""Words ``[^\x20\x09-\x0D]+`` of a lower-cased text; ``bytes.split`` cuts at exactly these six bytes."""
    return text.split()


def pieces(batches: Iterable[pa.RecordBatch], rows: int = 2048, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches bounded by rows and by bytes; one long text is a batch of its own."""
    for batch in batches:
        at = 0
        each = max(1, batch.nbytes // max(1, batch.num_rows))
        step = max(1, min(rows, size // each))
        while at < batch.num_rows:
            yield batch.slice(at, step)
            at += step
