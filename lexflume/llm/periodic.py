"""Periodic runs of words by an enhanced suffix array.

All texts of a piece are one array of words, ranked first by document, so that no suffix meets one
of another document. Suffixes are sorted by doubling; the ranks of every doubling are kept and give
the length of a common prefix (or of a common stretch to the left) in a few steps. Every LCP
interval of depth d is cut in two by one of its LCP values; for the suffixes i of the smaller part
the inverse suffix array tells whether i + d or i - d is in the larger one: then a square of period
d stands there that cannot be rotated to the right. Rotated to the left as far as it goes it is a
run; equal stretches keep their smallest period. Intervals are places in arrays, never tree nodes.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator
from fractions import Fraction
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from lexflume.llm.texts import pieces, words

# A run has at least so many words, and so many whole periods.
LEAST_WORDS = 6
LEAST_PERIODS = 4
# Suffixes looked at in one numpy step.
STEP = 1 << 20
PIECE_BYTES = 2 << 20

Run = tuple[int, int, int]  # start, length, period


def planted_source(doc_id: int, n: int) -> np.ndarray | None:
    """For every tenth document (by crc32 of its id): the original word that stands at each place; else None."""
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    places = np.arange(n)
    return np.where(places < a, places, a + (places - a) % p)


def _sorted_order(key: np.ndarray, bound: int) -> np.ndarray:
    """Stable order of keys below ``bound``; keys and places are sorted as one integer where they fit."""
    bits = max(1, (len(key) - 1).bit_length())
    if bound << bits < 1 << 63:
        return np.sort((key << bits) | np.arange(len(key))) & ((1 << bits) - 1)
    return np.argsort(key, kind="stable")


class SuffixArray:
    """Suffixes of all documents of a piece, those of one document next to each other.

    ``levels[k]`` ranks every place by its first 2**k words (a place past the end has rank -1); equal
    ranks are the same words of the same document.
    """

    def __init__(self, symbols: np.ndarray, doc: np.ndarray) -> None:
        n = self.n = len(symbols)
        width = int(symbols.max(initial=0)) + 1
        key = doc.astype(np.int64) * width + symbols
        self.sa = _sorted_order(key, (int(doc.max(initial=0)) + 1) * width)
        starts = np.r_[True, np.diff(key[self.sa]) != 0][:n]
        rank = np.full(n + 1, -1, np.int32)
        rank[self.sa] = np.flatnonzero(starts)[np.cumsum(starts) - 1]
        last = np.r_[np.flatnonzero(np.diff(doc)) + 1, n]
        end = last[np.searchsorted(last, np.arange(n), side="right")] if n else last[:0]
        self.levels = [rank]
        span = 1
        slots = self._shared(starts)
        while len(slots):
            rank = self.levels[-1].copy()
            at = self.sa[slots]
            ahead = at + span
            second = np.where(ahead < end[at], self.levels[-1][np.minimum(ahead, n)], -1).astype(np.int64) + 1
            key = rank[at].astype(np.int64) * (n + 1) + second
            order = _sorted_order(key, n * (n + 1))
            at, key = at[order], key[order]
            self.sa[slots] = at
            fresh = np.r_[True, np.diff(key) != 0]
            rank[at] = slots[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]
            self.levels.append(rank)
            slots = slots[self._shared(fresh)]
            span *= 2
        self.isa = np.full(n + 1, -1, np.int64)
        self.isa[self.sa] = np.arange(n)

    @staticmethod
    def _shared(starts: np.ndarray) -> np.ndarray:
        """Places of groups with more than one member, given where groups start."""
        return np.flatnonzero(~(starts & np.r_[starts[1:], True]))

    def forward(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Number of equal words from places x and y on."""
        x, y, found = x.copy(), y.copy(), np.zeros(len(x), np.int64)
        for k in reversed(range(len(self.levels))):
            same = (self.levels[k][x] == self.levels[k][y]) << k
            x, y, found = x + same, y + same, found + same
        return found

    def backward(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Number of equal words before places x and y."""
        x, y, found = x.copy(), y.copy(), np.zeros(len(x), np.int64)
        for k in reversed(range(len(self.levels))):
            fits = (x >= 1 << k) & (y >= 1 << k)
            back = np.where(fits, 1 << k, 0)
            same = np.where(fits & (self.levels[k][x - back] == self.levels[k][y - back]), 1 << k, 0)
            x, y, found = x - same, y - same, found + same
        return found


def _parts(lcp: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The interval that each LCP value cuts in two, as first and last-but-one place of the suffix array.

    To the left up to the next value that is not larger, to the right up to the next smaller one: of
    several equal values each cuts what those before it have left.
    """
    depth = lcp[at]
    lows = [np.r_[lcp, -1]]
    # no interval is longer than the longest stretch of positive values
    edges = np.flatnonzero(lcp <= 0)
    longest = int(np.diff(np.r_[edges, len(lcp)]).max(initial=1))
    while 1 << len(lows) <= longest:
        half = 1 << (len(lows) - 1)
        below = lows[-1]
        lows.append(np.minimum(below, np.r_[below[half:], np.full(min(half, len(below)), -1, below.dtype)]))
    left, right = at.copy(), at + 1
    for k in reversed(range(len(lows))):
        back = left - (1 << k)
        left = np.where((back >= 0) & (lows[k][np.maximum(back, 0)] > depth), back, left)
        right = np.where(lows[k][right] >= depth, right + (1 << k), right)
    return left - 1, right


def _squares(suffixes: SuffixArray, lcp: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of the squares that cannot be rotated right, from the LCP values at these places."""
    first, end = _parts(lcp, at)
    depth = lcp[at].astype(np.int64)
    small_left = at - first <= end - at
    begin = np.where(small_left, first, at)
    size = np.where(small_left, at - first, end - at)
    other, other_end = np.where(small_left, at, first), np.where(small_left, end, at)
    starts, periods = [], []
    ends = np.cumsum(size)
    low = 0
    while low < len(at):
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + STEP, side="right")))
        which = np.repeat(np.arange(low, high), size[low:high])
        offset = np.arange(len(which)) - np.repeat(ends[low:high] - size[low:high] - (ends[low - 1] if low else 0), size[low:high])
        i, d = suffixes.sa[begin[which] + offset], depth[which]
        for partner, start in ((i + d, i), (i - d, i - d)):
            inside = (partner >= 0) & (partner < suffixes.n)
            place = suffixes.isa[np.where(inside, partner, suffixes.n)]
            held = inside & (place >= other[which]) & (place < other_end[which])
            starts.append(start[held])
            periods.append(d[held])
        low = high
    return np.concatenate(starts or [np.empty(0, np.int64)]), np.concatenate(periods or [np.empty(0, np.int64)])


def find_runs(symbols: np.ndarray, sizes: np.ndarray) -> list[list[Run]]:
    """Runs of each document, by start, then period; documents of these sizes stand one after the other."""
    found: list[list[Run]] = [[] for _ in sizes]
    doc = np.repeat(np.arange(len(sizes)), sizes)
    if not len(symbols):
        return found
    suffixes = SuffixArray(symbols, doc)
    lcp = np.zeros(suffixes.n + 1, np.int64)
    lcp[0] = lcp[-1] = -1
    before, here = suffixes.sa[:-1], suffixes.sa[1:]
    alike = np.flatnonzero(suffixes.levels[0][before] == suffixes.levels[0][here])
    lcp[alike + 1] = suffixes.forward(before[alike], here[alike])
    # a longer period cannot fit often enough
    fits = lcp[alike + 1] * LEAST_PERIODS <= np.asarray(sizes)[doc[here[alike]]]
    start, period = _squares(suffixes, lcp, alike[fits] + 1)
    end = start + 2 * period
    start = start - suffixes.backward(start, start + period)
    long = end - start >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
    start, end, period = start[long], end[long], period[long]
    order = np.lexsort((period, end, start))
    offsets = np.cumsum(sizes) - sizes
    seen = None
    for s, e, q in zip(start[order].tolist(), end[order].tolist(), period[order].tolist(), strict=True):
        if (s, e) != seen:
            d = int(doc[s])
            found[d].append((s - int(offsets[d]), e - s, q))
            seen = (s, e)
    for runs in found:
        runs.sort(key=lambda r: (r[0], r[2]))
    return found


def most_repeated(runs: list[Run]) -> tuple[int | None, int | None, int | None, int | None]:
    """Start, length, period and floor(1000 * length / period) of the run with the greatest length / period."""
    if not runs:
        return None, None, None, None
    start, length, period = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]))
    return start, length, period, 1000 * length // period


def without_repeats(found: list[bytes], runs: list[Run]) -> list[bytes]:
    """Words but those that a run holds after its first period."""
    if not runs:
        return found
    kept = np.ones(len(found), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return [found[i] for i in np.flatnonzero(kept).tolist()]


def _run_batches(batches: Iterable[pa.RecordBatch], planted: bool) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, size=PIECE_BYTES):
        ids = batch.column(0).to_pylist()
        texts = [words(t) for t in pc.fill_null(batch.column(1).cast(pa.string()), "").cast(pa.binary()).to_pylist()]
        if planted:
            for at, doc_id in enumerate(ids):
                source = None if doc_id is None else planted_source(doc_id, len(texts[at]))
                if source is not None:
                    texts[at] = [texts[at][i] for i in source.tolist()]
        sizes = np.array([len(t) for t in texts], np.int64)
        symbols = pa.array([w for t in texts for w in t], pa.binary()).dictionary_encode().indices
        runs = find_runs(symbols.to_numpy(zero_copy_only=False).astype(np.int64), sizes)
        best = [most_repeated(r) for r in runs]
        kept = [b" ".join(without_repeats(t, r)) for t, r in zip(texts, runs, strict=True)]
        listed = ["".join(f"{s},{n},{q}\n" for s, n, q in r).encode() for r in runs]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([len(r) for r in runs], pa.int64()),
                *[pa.array([b[i] for b in best], pa.int64()) for i in range(4)],
                pa.array([hashlib.sha256(x).hexdigest() for x in listed], pa.string()),
                pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()),
                pa.array([[{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs], RUNS),
                pa.array(kept, pa.binary()).view(pa.string()),
            ],
            names=COLUMNS,
        )


RUNS = pa.list_(pa.struct([(x, pa.int64()) for x in ("start", "length", "period")]))
COLUMNS = [
    *("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"),
    *("runs", "collapsed"),
]


def periodic_runs(docs: DataFrame, planted: bool = False) -> DataFrame:
    """doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256, runs, collapsed.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text as it is written. A run is a stretch of words
    with smallest period q and at least max(6, 4q) words that no neighbouring word extends. ``start``
    to ``exponent_milli`` tell of the run with the greatest length / period (ties: smallest start,
    then period), ``collapsed`` is the text without the words a run holds after its first period.
    ``planted`` first lets a stretch of every tenth document repeat (``planted_source``), for tests.
    Defined cases: a null, empty or wordless text has no run, nulls for the run, and the digests of
    nothing; a null doc_id stays null and gets nothing planted; repeated rows get equal results; an
    empty table gives none; other columns are not read. Rows stay where they are: no shuffle.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
        "runs_sha256 string, collapsed_sha256 string, "
        "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    )
    return docs.select("doc_id", "text").mapInArrow(partial(_run_batches, planted=planted), schema)
