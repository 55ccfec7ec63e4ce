"""Phrases of texts by Arrow batches: found, counted over a corpus, and ranked within their row.

Most phrases of a corpus occur once, so what a task finds is first met by hash alone. Hashes only rule
out: a map of fixed size says which phrases may be known, and phrases themselves are counted and
compared as strings. What travels is packed, a row of bytes per part, with a line feed between phrases.
"""

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

from lexflume.functions.items import cut_tokens, text_parts

# The helper travels with the job, so executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows whose phrases are counted at one time, when they come as tokens.
SLICE = 1024
# Bits of a map of phrases: 128 KiB to 32 MiB. A fuller map only rules out less.
LEAST_BITS, MOST_BITS = 20, 28
# Bits of a hash that tell phrases of one part of the map apart.
LOW_BITS = 32
# Strings that are hashed at one time.
HASHED = 1 << 16
# Bytes of texts whose phrases meet in one part.
PART_BYTES = 1 << 24
# Packed phrases a task holds before it sends them on, in bytes, and rows of a table.
HELD_BYTES, HELD_ROWS = 1 << 22, 1 << 18

_IN_BREAK = np.zeros(256, bool)
_IN_BREAK[[*b'.,;:!?()[]{}"|\r\n']] = True

PACKED = "part int, kind int, phrases string, rows binary, numbers binary"


def _mixed(x: np.ndarray) -> np.ndarray:
    """Bijective finisher of 64-bit hashes (published splitmix64 constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashes_of(strings: pa.StringArray) -> np.ndarray:
    """64-bit hashes of strings by their bytes; none is null or empty."""
    if not len(strings):
        return np.zeros(0, np.uint64)
    if len(strings) > HASHED:
        return np.concatenate([hashes_of(strings.slice(i, HASHED)) for i in range(0, len(strings), HASHED)])
    _, borders, raw = strings.buffers()
    borders = np.frombuffer(borders, np.int32)[strings.offset : strings.offset + len(strings) + 1]
    raw = np.frombuffer(raw, np.uint8)[borders[0] : borders[-1]]
    borders = borders - borders[0]
    sizes = np.diff(borders)
    place = np.arange(len(raw), dtype=np.int32) - np.repeat(borders[:-1], sizes)
    powers = np.multiply.accumulate(np.full(int(sizes.max()), 0x9E3779B97F4A7C15, np.uint64))
    return _mixed(np.add.reduceat(raw * powers[place], borders[:-1]))


def _phrase_hashes(words: np.ndarray, most: int) -> Iterator[tuple[int, np.ndarray]]:
    """(n, hashes) of the runs of n = 1 to ``most`` words, from the words' hashes."""
    total = words
    yield 1, total
    for n in range(2, min(most, len(words)) + 1):
        total = _mixed(total[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[n - 1 :])
        yield n, total


class Words:
    """Tokens of many lower-cased texts: ``row`` each stands in, ``piece`` of a row without a break, stops before it."""

    def __init__(self, texts: pa.Array, stops: pa.Array) -> None:
        self.flat, ends, raw, at = cut_tokens(texts)
        coded = self.flat.dictionary_encode()
        self.names, self.code = coded.dictionary, coded.indices.to_numpy()
        self.row = np.repeat(np.arange(len(texts)), np.diff(ends, prepend=0))
        # both only grow, so tokens with equal sums have equal rows and breaks before them
        self.piece = self.row + np.cumsum(_IN_BREAK[raw], dtype=np.int32)[at]
        stop = pc.is_in(self.names, value_set=stops).to_numpy(zero_copy_only=False)
        self.before = np.r_[0, np.cumsum(stop[self.code], dtype=np.int32)]

    def found(self, fewest: int, most: int, known: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(n, places, hashes) of the phrases of n = ``fewest`` to ``most`` words, by where they start; with a map, of those in it."""
        for n, hashed in _phrase_hashes(hashes_of(self.names)[self.code], most):
            if n < fewest:
                continue
            at = _starts(self.piece, self.before, n)
            hashed = hashed[at]
            if known is not None:
                held = _in_map(known, hashed)
                at, hashed = at[held], hashed[held]
            yield n, at, hashed

    def counted(self, fewest: int, most: int, known: np.ndarray | None = None) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Distinct phrases; those of each row as row * phrases + phrase in order, and how often each occurs there."""
        return _counted(self.flat, self.row, [(n, at) for n, at, _ in self.found(fewest, most, known)])


def _starts(piece: np.ndarray, before: np.ndarray, n: int) -> np.ndarray:
    """Where ``n`` neighbouring tokens of one piece start without a stop among them."""
    last = len(piece) - n + 1
    return np.flatnonzero((before[n:] == before[:last]) & (piece[n - 1 :] == piece[:last])) if last > 0 else np.zeros(0, np.int64)


def _counted(flat: pa.Array, row: np.ndarray, places: list[tuple[int, np.ndarray]]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    found = [pc.binary_join_element_wise(*[flat.take(pa.array(at + i)) for i in range(n)], " ") for n, at in places]
    coded = pa.concat_arrays([*found, pa.array([], pa.string())]).dictionary_encode()
    rows = np.concatenate([np.zeros(0, np.int64), *[row[at] for _, at in places]])
    each, n = np.unique(rows * max(len(coded.dictionary), 1) + coded.indices.to_numpy(), return_counts=True)
    return coded.dictionary, each, n


def phrases_of(tokens: pa.Array, stops: pa.Array, fewest: int, most: int) -> pa.Array:
    """Runs of ``fewest`` to ``most`` neighbouring tokens without a stop: per row (item, n) of each distinct one."""
    sizes = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(tokens)), sizes)
    before = np.r_[0, np.cumsum(stops.flatten().to_numpy(zero_copy_only=False) != 0)]
    names, each, n = _counted(tokens.flatten(), row, [(n, _starts(row, before, n)) for n in range(fewest, most + 1)])
    size = max(len(names), 1)
    counted = pa.StructArray.from_arrays([names.take(pa.array(each % size)), pa.array(n, pa.int32())], ["item", "n"])
    starts = np.searchsorted(each, np.arange(len(tokens) + 1) * size)
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), counted)


# --- packed rows -------------------------------------------------------------------------------------


def _cells(values: np.ndarray, borders: np.ndarray) -> pa.Array:
    """The bytes of the values between neighbouring borders."""
    at = pa.py_buffer((borders * values.itemsize).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(borders) - 1, [None, at, pa.py_buffer(np.ascontiguousarray(values))])


def _joined(strings: pa.Array, borders: np.ndarray) -> pa.Array:
    """The strings between neighbouring borders as one string, a line feed between them."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(borders, pa.int32()), strings), "\n")


def _split(joined: pa.Array) -> pa.Array:
    """What ``_joined`` has put together, all strings one after another."""
    parts = pc.split_pattern(joined.combine_chunks() if isinstance(joined, pa.ChunkedArray) else joined, "\n")
    return parts.flatten().cast(pa.string())


def _numbers(cells: pa.Array, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(cells.to_pylist()), kind)


def _borders(part: np.ndarray) -> np.ndarray:
    """Where runs of equal numbers start, and the end."""
    return np.r_[0, np.flatnonzero(np.diff(part)) + 1, len(part)] if len(part) else np.zeros(1, np.int64)


def _packed(part: np.ndarray, kind: int, names: pa.Array, rows: np.ndarray, numbers: np.ndarray) -> pa.RecordBatch:
    """One packed row per part."""
    order = np.argsort(part, kind="stable")
    borders = _borders(part[order])
    first = part[order][borders[:-1]]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(first, pa.int32()),
            pa.array(np.full(len(first), kind), pa.int32()),
            _joined(names.take(pa.array(order)), borders),
            _cells(rows[order], borders),
            _cells(numbers[order], borders),
        ],
        names=["part", "kind", "phrases", "rows", "numbers"],
    )


def _part_of(names: pa.Array, parts: int) -> np.ndarray:
    return (hashes_of(names) % np.uint64(parts)).astype(np.int32)


def _by_part(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Runs of rows of one part within a batch."""
    for batch in batches:
        part = batch.column(0).to_numpy(zero_copy_only=False)
        borders = _borders(part).tolist()
        for a, b in zip(borders[:-1], borders[1:], strict=True):
            yield int(part[a]), batch.slice(a, b - a)


def _whole_parts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """All rows of a part; they come one part after another."""
    at, held = None, []
    for part, rows in _by_part(batches):
        if held and part != at:
            yield at, pa.Table.from_batches(held)
            held = []
        at = part
        held.append(rows)
    if held:
        yield at, pa.Table.from_batches(held)


def _met(packed: DataFrame) -> DataFrame:
    """Packed rows by part, those of a lower kind first."""
    return packed.repartition("part").sortWithinPartitions("part", "kind")


# --- map of phrases that may be known ----------------------------------------------------------------


def map_bits(phrases: int) -> int:
    """Bits of a map for about so many phrases."""
    return min(max((16 * phrases).bit_length(), LEAST_BITS), MOST_BITS)


def _in_map(known: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """Which hashes the map holds; their first bits are the place."""
    at = hashed >> np.uint64(64 - (len(known) * 8).bit_length() + 1)
    return (known[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 != 0


def _sent_hashes(batches: Iterable[pa.RecordBatch], stops: Broadcast, fewest: int, most: int, least: int, part_bits: int):
    """(part, keys, counts): hashes of the phrases of a slice of texts, by their first bits, and how often each occurs there."""
    for batch in batches:
        for texts in text_parts(batch.column(0)):
            hashed = [h >> np.uint64(64 - LOW_BITS - part_bits) for _, _, h in Words(texts, stops.value).found(fewest, most)]
            keys, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *hashed]), return_counts=True)
            part = (keys >> np.uint64(LOW_BITS)).astype(np.int32)
            borders = _borders(part)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part[borders[:-1]], pa.int32()),
                    _cells(keys.astype("<u4"), borders),
                    _cells(np.minimum(n, least).astype("<u4"), borders),
                ],
                names=["part", "keys", "counts"],
            )


def _pieces_of_map(batches: Iterable[pa.RecordBatch], least: int, piece_bits: int):
    """(part, bits) of the map: hashes that were met ``least`` times."""
    for part, rows in _whole_parts(batches):
        keys, n = _numbers(rows.column(1), "<u4"), _numbers(rows.column(2), "<u4")
        order = np.argsort(keys)
        borders = _borders(keys[order])
        often = np.add.reduceat(n[order].astype(np.int64), borders[:-1]) >= least
        bits = np.zeros(1 << piece_bits, bool)
        bits[keys[order][borders[:-1][often]] >> np.uint32(LOW_BITS - piece_bits)] = True
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())], names=["part", "bits"]
        )


def _map_of(sent: DataFrame, least: int, bits: int, part_bits: int) -> np.ndarray:
    """The map's bytes on the driver: a piece per part, whatever the number of phrases."""
    met = sent.repartition("part").sortWithinPartitions("part")
    pieces = met.mapInArrow(partial(_pieces_of_map, least=least, piece_bits=bits - part_bits), "part int, bits binary").toArrow()
    known = np.zeros((1 << part_bits, 1 << (bits - part_bits - 3)), np.uint8)
    for part, piece in zip(pieces["part"].to_pylist(), pieces["bits"].to_pylist(), strict=True):
        known[part] = np.frombuffer(piece, np.uint8)
    return known.reshape(-1)


def _part_bits(size: int, share: int) -> int:
    return min(max((size // share).bit_length(), 4), LEAST_BITS - 6)


def repeated_phrases(texts: DataFrame, stops: Broadcast, fewest: int, most: int, least: int, size: int) -> np.ndarray:
    """Map of the phrases of lower-cased texts (of ``size`` bytes in all) that occur ``least`` times, and of some others."""
    bits, part_bits = map_bits(size >> 7), _part_bits(size, PART_BYTES)
    make = partial(_sent_hashes, stops=stops, fewest=fewest, most=most, least=least, part_bits=part_bits)
    return _map_of(texts.mapInArrow(make, "part int, keys binary, counts binary"), least, bits, part_bits)


def _sent_known(batches: Iterable[pa.RecordBatch], most: int, part_bits: int):
    for batch in batches:
        for names in text_parts(batch.column(0)):
            flat, ends, _, _ = cut_tokens(names)
            first = np.r_[0, ends[:-1]].astype(np.int64)
            size = ends - first
            keys = [np.zeros(0, np.uint64)]
            for n, hashed in _phrase_hashes(hashes_of(flat), most):
                keys.append(hashed[first[size == n]] >> np.uint64(64 - LOW_BITS - part_bits))
            keys = np.unique(np.concatenate(keys))
            part = (keys >> np.uint64(LOW_BITS)).astype(np.int32)
            borders = _borders(part)
            ones = np.ones(len(keys), "<u4")
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[borders[:-1]], pa.int32()), _cells(keys.astype("<u4"), borders), _cells(ones, borders)],
                names=["part", "keys", "counts"],
            )


def known_phrases(phrases: DataFrame, most: int, size: int) -> np.ndarray:
    """Map of the phrases in a column of ``size`` rows, and of some others."""
    bits, part_bits = map_bits(size), _part_bits(size, HELD_ROWS)
    sent = phrases.mapInArrow(partial(_sent_known, most=most, part_bits=part_bits), "part int, keys binary, counts binary")
    return _map_of(sent, 1, bits, part_bits)


# --- counts ------------------------------------------------------------------------------------------


def _sent_counts(batches: Iterable[pa.RecordBatch], stops: Broadcast, known: Broadcast, fewest: int, most: int, parts: int):
    for batch in batches:
        for texts in text_parts(batch.column(0)):
            names, each, n = Words(texts, stops.value).counted(fewest, most, known.value)
            at = each % max(len(names), 1)
            f = np.bincount(at, weights=n, minlength=len(names)).astype("<i8")
            yield _packed(_part_of(names, parts), 0, names, np.bincount(at, minlength=len(names)).astype("<i8"), f)


def _within(names: pa.Array, fewest: int, most: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct phrases of fewer words inside the phrases, and by pairs: which phrase, and which of them it holds."""
    flat, ends, _, _ = cut_tokens(names)
    sizes = np.diff(ends, prepend=0)
    row = np.repeat(np.arange(len(names)), sizes)
    none = np.zeros(len(flat) + 1, np.int8)
    places = []
    for n in range(fewest, most):
        at = _starts(row, none, n)
        places.append((n, at[sizes[row[at]] > n]))
    inner, each, _ = _counted(flat, row, places)
    return inner, *np.divmod(each, max(len(inner), 1))


def _totals(names: pa.Array, *columns: np.ndarray) -> tuple[pa.Array, list[np.ndarray]]:
    """Distinct names, and the sums of their numbers."""
    coded = names.dictionary_encode()
    sums = [np.zeros(len(coded.dictionary), np.int64) for _ in columns]
    for total, column in zip(sums, columns, strict=True):
        np.add.at(total, coded.indices.to_numpy(), column)
    return coded.dictionary, sums


def _total_counts(batches: Iterable[pa.RecordBatch], fewest: int, most: int, least: int, parts: int):
    """Phrases with f >= ``least`` (kind 1: doc_freq, f), and what they add to the phrases inside them (kind 0: around_n, around)."""
    inside: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []

    def packed() -> pa.RecordBatch:
        names, (around, n) = _totals(pa.concat_arrays([i[0] for i in inside]), *[np.concatenate([i[c] for i in inside]) for c in (1, 2)])
        return _packed(_part_of(names, parts), 0, names, n, around)

    for part, rows in _whole_parts(batches):
        names, (f, docs) = _totals(_split(rows.column(2)), _numbers(rows.column(4), "<i8"), _numbers(rows.column(3), "<i8"))
        often = np.flatnonzero(f >= least)
        names, f, docs = names.take(pa.array(often)), f[often], docs[often]
        yield _packed(np.full(len(names), part, np.int32), 1, names, docs, f)
        inner, longer, code = _within(names, fewest, most)
        around = np.zeros(len(inner), np.int64)
        np.add.at(around, code, f[longer])
        inside.append((inner, around, np.bincount(code, minlength=len(inner)).astype("<i8")))
        if sum(len(i[0]) for i in inside) >= HELD_ROWS:
            yield packed()
            inside.clear()
    if inside:
        yield packed()


def _with_around(batches: Iterable[pa.RecordBatch]):
    """Phrases with what the longer ones around them add up to; a part's sums come first."""
    for _, rows in _whole_parts(batches):
        kind = rows.column(1).to_numpy()
        sums, own = rows.slice(0, int((kind == 0).sum())), rows.slice(int((kind == 0).sum()))
        inner, (around, n) = _totals(_split(sums.column(2)), _numbers(sums.column(4), "<i8"), _numbers(sums.column(3), "<i8"))
        names = _split(own.column(2))
        where = pc.fill_null(pc.index_in(names, value_set=inner), len(inner)).to_numpy()
        columns = [_numbers(own.column(4), "<i8"), _numbers(own.column(3), "<i8"), np.r_[around, 0][where], np.r_[n, 0][where]]
        words = pc.add(pc.count_substring(names, " "), pa.scalar(1, pa.int32()))
        yield pa.RecordBatch.from_arrays(
            [names, words, *map(pa.array, columns)], names=["phrase", "words", "f", "doc_freq", "around", "around_n"]
        )


COUNTED = "phrase string, words int, f bigint, doc_freq bigint, around bigint, around_n bigint"


def counted_phrases(texts: DataFrame, stops: Broadcast, known: Broadcast, fewest: int, most: int, least: int, size: int) -> DataFrame:
    """(phrase, words, f, doc_freq, around, around_n) of the phrases that lower-cased texts hold ``least`` times.

    These are in the map; the texts have ``size`` bytes in all. ``around`` is how often the ``around_n``
    longer ones of them that contain the phrase occur in sum.
    """
    parts = 1 << _part_bits(size, PART_BYTES)
    sent = texts.mapInArrow(partial(_sent_counts, stops=stops, known=known, fewest=fewest, most=most, parts=parts), PACKED)
    counted = _met(sent).mapInArrow(partial(_total_counts, fewest=fewest, most=most, least=least, parts=parts), PACKED)
    return _met(counted).mapInArrow(_with_around, COUNTED)


# --- rank within the row -----------------------------------------------------------------------------


def _best(row: np.ndarray, code: np.ndarray, names: pa.Array, score: np.ndarray, k: int) -> np.ndarray:
    """Places of each row's ``k`` best phrases in the order of row, falling score and phrase."""
    rank = np.empty(len(names), np.int64)
    rank[pc.array_sort_indices(names).to_numpy()] = np.arange(len(names))
    order = np.lexsort((rank[code], -score, row))
    borders = _borders(row[order])
    place = np.arange(len(order)) - np.repeat(borders[:-1], np.diff(borders))
    return order[place < k]


def _scores(n: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """n * weight, rounded to 6 digits; weights have no more."""
    return np.rint(n * weight * 1e6) / 1e6


def _ranked(row: np.ndarray, rows: int, terms: pa.Array, score: np.ndarray) -> pa.Array:
    """Arrays of (term, score) of the rows 0 to ``rows``, from entries in their order."""
    ends = np.searchsorted(row, np.arange(rows + 1))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([terms, pa.array(score)], ["term", "score"]))


def by_hash(names: pa.Array, weight: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray, int]:
    """Phrases in the order of their hashes: hashes, phrases, weights, and how many have one hash at most."""
    hashed = hashes_of(names)
    order = np.argsort(hashed)
    return hashed[order], names.take(pa.array(order)), weight[order], int(np.diff(_borders(hashed[order])).max(initial=0))


def weights_of(names: pa.Array, held: tuple[np.ndarray, pa.Array, np.ndarray, int]) -> tuple[np.ndarray, np.ndarray]:
    """Weights of phrases by those ``held``, and which of them these are; phrases are compared as strings."""
    hashed, phrases, weights, alike = held
    weight, found = np.zeros(len(names)), np.zeros(len(names), bool)
    first = np.searchsorted(hashed, hashes_of(names))
    for i in range(alike):
        at = np.minimum(first + i, len(hashed) - 1)
        same = pc.equal(phrases.take(pa.array(at)), names).to_numpy(zero_copy_only=False)
        weight[same], found[same] = weights[at[same]], True
    return weight, found


def _ranked_slice(
    texts: pa.Array, stops: pa.Array, known: np.ndarray, held: tuple, whole: bool, fewest: int, most: int, k: int
) -> pa.Array:
    names, each, n = Words(texts, stops).counted(fewest, most, known)
    row, code = np.divmod(each, max(len(names), 1))
    weight, has = weights_of(names, held)
    score = _scores(n, weight[code])
    mine = np.flatnonzero(score > 0)
    best = mine[_best(row[mine], code[mine], names, score[mine], k)]
    ranked = _ranked(row[best], len(texts), names.take(pa.array(code[best])), score[best])
    rare = np.flatnonzero(~has[code]) if not whole else np.zeros(0, np.int64)
    borders = np.searchsorted(row[rare], np.arange(len(texts) + 1))
    phrases = pc.if_else(pa.array(np.diff(borders) > 0), _joined(names.take(pa.array(code[rare])), borders), pa.scalar(None, pa.string()))
    return pa.StructArray.from_arrays([ranked, phrases, _cells(n[rare].astype("<i4"), borders)], ["best", "phrases", "n"])


def ranked_phrases(
    stops: Broadcast, known: Broadcast, held: Broadcast, whole: bool, fewest: int, most: int, k: int
) -> Callable[[Column], Column]:
    """Column function: a text to (best, phrases, n): its ``k`` best of the held phrases, and the others in the map.

    There are no others when those held are the ``whole`` table.
    """

    @F.arrow_udf("struct<best: array<struct<term: string, score: double>>, phrases: string, n: binary>")
    def found(texts: pa.Array) -> pa.Array:
        parts = text_parts(texts)
        return pa.concat_arrays([_ranked_slice(t, stops.value, known.value, held.value, whole, fewest, most, k) for t in parts])

    # keeps the planner from copying the call into the expressions that use it
    made = found.asNondeterministic()
    return lambda text: made(F.lower(text))


def _sent_rows(batches: Iterable[pa.RecordBatch], parts: int):
    """Packed phrases of rows (_row, phrases, n), kind 1."""

    def packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        n = _numbers(rows.column(2), "<i4")
        names = _split(rows.column(1))
        sizes = pc.binary_length(rows.column(2)).to_numpy() // 4
        return _packed(_part_of(names, parts), 1, names, np.repeat(rows.column(0).to_numpy(), sizes).astype("<i8"), n)

    yield from _held_batches(batches, packed)


def _sent_table(batches: Iterable[pa.RecordBatch], parts: int):
    """Packed phrases of a table (phrase, weight), kind 0."""

    def packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        names = pa.concat_arrays(rows.column(0).cast(pa.string()).chunks)
        return _packed(_part_of(names, parts), 0, names, np.zeros(len(names), "<i8"), rows.column(1).to_numpy().astype("<f8"))

    yield from _held_batches(batches, packed)


def _held_batches(batches: Iterable[pa.RecordBatch], packed: Callable[[list[pa.RecordBatch]], pa.RecordBatch]):
    """Batches put together up to a number of rows and bytes; one row may have more."""
    held, rows, size = [], 0, 0
    for batch in batches:
        step = max(1, min(batch.num_rows, HELD_BYTES * batch.num_rows // max(1, batch.nbytes)))
        for part in (batch.slice(i, step) for i in range(0, batch.num_rows, step)):
            held.append(part)
            rows, size = rows + part.num_rows, size + part.nbytes
            if rows >= HELD_ROWS or size >= HELD_BYTES:
                yield packed(held)
                held, rows, size = [], 0, 0
    if held:
        yield packed(held)


def _scored_rows(batches: Iterable[pa.RecordBatch], parts: int):
    """Phrases that the table holds, with their score, packed by their row; a part's table comes first."""
    at, names, weights, value_set = None, [], [], None
    for part, rows in _by_part(batches):
        if part != at:
            at, names, weights, value_set = part, [pa.array([], pa.string())], [np.zeros(0)], None
        kind = rows.column(1).to_numpy()
        table, sent = rows.slice(0, int((kind == 0).sum())), rows.slice(int((kind == 0).sum()))
        if table.num_rows:
            names.append(_split(table.column(2)))
            weights.append(_numbers(table.column(4), "<f8"))
        if not sent.num_rows:
            continue
        if value_set is None:
            value_set, weight = pa.concat_arrays(names), np.concatenate(weights)
        found = _split(sent.column(2))
        where = pc.index_in(found, value_set=value_set)
        hit = np.flatnonzero(pc.is_valid(where).to_numpy(zero_copy_only=False))
        score = _scores(_numbers(sent.column(4), "<i4")[hit], weight[where.take(pa.array(hit)).to_numpy()])
        row = _numbers(sent.column(3), "<i8")[hit]
        yield _packed((_mixed(row.astype(np.uint64)) % np.uint64(parts)).astype(np.int32), 0, found.take(pa.array(hit)), row, score)


def _best_rows(batches: Iterable[pa.RecordBatch], k: int):
    """(_row, ranked): the ``k`` best phrases of each row of a part."""
    for _, rows in _whole_parts(batches):
        row, score = _numbers(rows.column(3), "<i8"), _numbers(rows.column(4), "<f8")
        coded = _split(rows.column(2)).dictionary_encode()
        best = _best(row, coded.indices.to_numpy(), coded.dictionary, score, k)
        each, at = np.unique(row[best], return_inverse=True)
        ranked = _ranked(at, len(each), coded.dictionary.take(coded.indices.take(pa.array(best))), score[best])
        yield pa.RecordBatch.from_arrays([pa.array(each), ranked], names=["_row", "ranked"])


def best_of_table(rows: DataFrame, table: DataFrame, k: int, parts: int, row_parts: int) -> DataFrame:
    """(_row, ranked): each row's ``k`` best phrases, of rows (_row, phrases, n) and a table (phrase, weight)."""
    sent = rows.mapInArrow(partial(_sent_rows, parts=parts), PACKED)
    held = table.mapInArrow(partial(_sent_table, parts=parts), PACKED)
    scored = _met(held.unionByName(sent)).mapInArrow(partial(_scored_rows, parts=row_parts), PACKED)
    return _met(scored).mapInArrow(partial(_best_rows, k=k), "_row bigint, ranked array<struct<term: string, score: double>>")
