"""Phrase collocations by mergeable Misra-Gries summaries.

First pass: every task hashes the phrases of its texts and sends, per hash partition, counters of 32
remaining bits. A partition merges what all tasks sent into one Misra-Gries summary whose capacity
exceeds the partition's phrases divided by the threshold, so that every phrase as frequent as the
threshold survives. Second pass: phrases that survived are counted exactly, as words. Hashes that
collide only let more survive. What survived goes to all tasks as a bit map of fixed size, and so do
the words that are frequent enough to be part of such a phrase.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexflume.llm.relations import attach
from lexflume.llm.texts import pieces
from lexflume.session import stored

UNKNOWN = "und"
# Bytes that end a piece become line feeds, a tab becomes a blank.
CUTS = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n" * 9 + b" ")
# Bits of the maps of frequent words and of surviving phrases (2 MiB and 8 MiB); fuller maps only rule out less.
WORD_BITS, PHRASE_BITS = 24, 26
# Counters a summary may need; more phrases make more partitions.
COUNTERS = 1 << 18
LEAST_PARTITIONS = 256
# Phrases a task hashes, and words or phrases it counts, before it sends them on.
HELD_PHRASES, HELD_WORDS, HELD_COUNTS = 1 << 22, 1 << 18, 1 << 18
# Counters in one row of a summary.
ROW = 1024
PIECE_BYTES = 2 << 20


def _mixed(x: np.ndarray) -> np.ndarray:
    """Bijective finisher of 64-bit hashes (published splitmix64 constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of many texts of one language: codes, and the piece each stands in."""

    def __init__(self, texts: list[bytes]) -> None:
        data = b"\n".join(texts).translate(CUTS).replace(b"\n", b" \n ")
        found = pa.array(data.split(b" "), pa.binary()).dictionary_encode()
        self.names: list[bytes] = found.dictionary.to_pylist()
        codes = found.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        kind = np.array([1 if w == b"" else 2 if w == b"\n" else 0 for w in self.names], np.int8)[codes]
        self.piece = np.cumsum(kind == 2)[kind == 0]
        self.codes = codes[kind == 0]

    def hashes(self, lang: str) -> np.ndarray:
        """64-bit hash of every distinct word in its language."""
        seed = xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass")) & 0x7FFFFFFF
        return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in self.names), np.uint64, len(self.names))

    def phrases(self, longest: int, hashed: np.ndarray, useful: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(m, places, hashes) of the phrases of m = 2 to ``longest`` words whose words all are useful."""
        word = hashed[self.codes]
        fits, total = useful[self.codes], word
        for m in range(2, longest + 1):
            n = len(self.codes) - m + 1
            if n < 1:
                return
            total = _mixed(total[:n] * np.uint64(0x9E3779B97F4A7C15) + word[m - 1 :])
            fits = fits[:n] & fits[1 : n + 1]  # the first m - 1 words and the last m - 1
            at = np.flatnonzero(fits & (self.piece[:n] == self.piece[m - 1 :]))
            yield m, at, total[at]


def _by_lang(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, Words]]:
    """Words of the texts of each language, piece by piece."""
    for batch in pieces(batches, rows=1 << 14, size=PIECE_BYTES):
        texts = pc.ascii_lower(pc.fill_null(batch.column(0).cast(pa.string()), "")).cast(pa.binary()).to_pylist()
        found: dict[str, list[bytes]] = {}
        for text, lang in zip(texts, batch.column(1).to_pylist(), strict=True):
            found.setdefault(UNKNOWN if lang is None else lang, []).append(text)
        for lang, those in found.items():
            yield lang, Words(those)


def _word_rows(held: dict[str, dict[bytes, int]], hashed: dict[str, dict[bytes, int]]) -> Iterator[pa.RecordBatch]:
    for lang, counts in held.items():
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * len(counts), pa.string()),
                pa.array(list(counts), pa.binary()).view(pa.string()),
                pa.array(list(counts.values()), pa.int64()),
                pa.array([hashed[lang][w] for w in counts], pa.int64()),
            ],
            names=["lang", "phrase", "f", "bit"],
        )


def _word_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, phrase, f, bit): words with counts and their place in the map, combined over many pieces."""
    held: dict[str, dict[bytes, int]] = {}
    bits: dict[str, dict[bytes, int]] = {}
    size = 0
    for lang, found in _by_lang(batches):
        counts, places = held.setdefault(lang, {}), bits.setdefault(lang, {})
        size -= len(counts)
        where = (found.hashes(lang) >> np.uint64(64 - WORD_BITS)).tolist()
        for word, n, bit in zip(found.names, np.bincount(found.codes, minlength=len(found.names)).tolist(), where, strict=True):
            if n:
                counts[word] = counts.get(word, 0) + n
                places[word] = bit
        size += len(counts)
        if size > HELD_WORDS:
            yield from _word_rows(held, bits)
            held, bits, size = {}, {}, 0
    yield from _word_rows(held, bits)


def _map_bits(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 != 0


def bit_map(places: DataFrame, column: str, bits: int) -> np.ndarray:
    """Bytes of a map of ``2**bits`` bits that are set at the given places; Spark sets 64 bits at once.

    At most ``2**(bits - 6)`` numbers reach the driver, whatever the number of places.
    """
    word, one = F.expr(f"{column} DIV 64").alias("w"), F.expr(f"shiftleft(1L, CAST({column} % 64 AS INT))")
    rows = places.groupBy(word).agg(F.bit_or(one).alias("b")).toArrow()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[rows["w"].to_numpy()] = rows["b"].to_numpy()
    return out.view(np.uint8)


def _summary_rows(found: list[np.ndarray], partitions: int) -> Iterator[pa.RecordBatch]:
    """Counters of the hashes, sorted by partition; the first rows of a partition hold its mass alone."""
    keys = np.sort(np.concatenate(found))
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    keys, counts = keys[first], np.diff(np.r_[first, len(keys)]).astype(np.uint32)
    part, low = _partition(keys, partitions)
    order = np.argsort(part, kind="stable")
    part, low, counts = part[order], low[order].astype("<u4"), counts[order].astype("<u4")
    borders = np.r_[np.flatnonzero(np.r_[True, part[1:] != part[:-1]]), len(part)].tolist()
    rows: list[tuple[int, int, bytes | None, bytes | None]] = []
    for a, b in zip(borders[:-1], borders[1:], strict=True):
        rows.append((int(part[a]), int(counts[a:b].sum(dtype=np.int64)), None, None))
        rows += [(int(part[a]), 0, low[i : min(i + ROW, b)].tobytes(), counts[i : min(i + ROW, b)].tobytes()) for i in range(a, b, ROW)]
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([r[0] for r in rows], pa.int64()),
            pa.array([r[1] for r in rows], pa.int64()),
            pa.array([r[2] for r in rows], pa.binary()),
            pa.array([r[3] for r in rows], pa.binary()),
        ],
        names=["part", "mass", "keys", "counts"],
    )


def _partition(keys: np.ndarray, partitions: int) -> tuple[np.ndarray, np.ndarray]:
    """Partition of a hash, and 32 of its remaining bits."""
    parts = np.uint64(partitions)
    return keys % parts, (keys // parts) & np.uint64(0xFFFFFFFF)


def _survivor_bit(part: np.ndarray, low: np.ndarray) -> np.ndarray:
    return _mixed(part.astype(np.uint64) << np.uint64(32) | low.astype(np.uint64)) >> np.uint64(64 - PHRASE_BITS)


def _summary_batches(
    batches: Iterable[pa.RecordBatch], longest: int, word_map: np.ndarray, partitions: int
) -> Iterator[pa.RecordBatch]:
    held: list[np.ndarray] = []
    size = 0
    for lang, found in _by_lang(batches):
        hashed = found.hashes(lang)
        useful = _map_bits(word_map, hashed >> np.uint64(64 - WORD_BITS))
        for _, _, keys in found.phrases(longest, hashed, useful):
            if len(keys):
                held.append(keys)
                size += len(keys)
        if size > HELD_PHRASES:
            yield from _summary_rows(held, partitions)
            held, size = [], 0
    if held:
        yield from _summary_rows(held, partitions)


class MisraGries:
    """Summary of counted 32-bit keys: a key's count is too low by at most ``missed``."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.missed = capacity, 0
        self.keys, self.counts = np.empty(0, np.uint32), np.empty(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Merge in another summary's counters."""
        self.waiting.append((keys, counts.astype(np.int64)))
        self.size += len(keys)
        if self.size > max(self.capacity, 1 << 16):
            self.merge()

    def merge(self) -> None:
        keys = np.concatenate([self.keys, *[k for k, _ in self.waiting]])
        counts = np.concatenate([self.counts, *[c for _, c in self.waiting]])
        self.waiting, self.size = [], 0
        if not len(keys):
            return
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        keys, counts = keys[first], np.add.reduceat(counts, first)
        if len(keys) > self.capacity:
            # takes capacity + 1 times this much mass away
            cut = int(np.partition(counts, len(counts) - self.capacity - 1)[len(counts) - self.capacity - 1])
            self.missed += cut
            keys, counts = keys[counts > cut], counts[counts > cut] - cut
        self.keys, self.counts = keys, counts

    def survivors(self, least: int) -> np.ndarray:
        """Keys that may have been counted ``least`` times."""
        self.merge()
        return self.keys[self.counts + self.missed >= least]


def _merge_batches(batches: Iterable[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Places in the map of the survivors of each partition; rows come by partition, its mass first."""
    part, mass, summary = None, 0, None

    def done() -> Iterator[pa.RecordBatch]:
        if summary is not None:
            keys = summary.survivors(least)
            bits = _survivor_bit(np.full(len(keys), part, np.uint64), keys)
            yield pa.RecordBatch.from_arrays([pa.array(bits.astype(np.int64))], names=["bit"])

    for batch in batches:
        for p, m, keys, counts in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
            if p != part:
                yield from done()
                part, mass, summary = p, 0, None
            if keys is None:
                mass += m
                continue
            if summary is None:
                summary = MisraGries(mass // least + 1)
            summary.add(np.frombuffer(keys, "<u4"), np.frombuffer(counts, "<u4"))
    yield from done()


def _counted_rows(held: dict[str, dict[bytes, int]], partitions: int) -> Iterator[pa.RecordBatch]:
    """Exact counts by hash partition: ROW phrases of one language and partition at most in a row, a line feed between them."""
    rows: list[tuple[int, str, bytes, bytes]] = []
    for lang, counts in held.items():
        names = list(counts)
        part = np.fromiter((xxhash.xxh64_intdigest(x) % partitions for x in names), np.int64, len(names))
        order = np.argsort(part, kind="stable")
        borders = np.r_[0, np.flatnonzero(np.diff(part[order])) + 1, len(order)].tolist()
        n = np.fromiter(counts.values(), "<i8", len(counts))
        for a, b in zip(borders[:-1], borders[1:], strict=True):
            for i in range(a, b, ROW):
                those = order[i : min(i + ROW, b)]
                rows.append((int(part[those[0]]), lang, b"\n".join(names[k] for k in those.tolist()), n[those].tobytes()))
    yield pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int64(), pa.string(), pa.binary(), pa.binary()))],
        names=["part", "lang", "phrases", "counts"],
    )


def _exact_batches(
    batches: Iterable[pa.RecordBatch], longest: int, word_map: np.ndarray, phrase_map: np.ndarray, partitions: int
) -> Iterator[pa.RecordBatch]:
    """Exact counts, within a piece, of the phrases whose hashes survived; combined over many pieces."""
    held: dict[str, dict[bytes, int]] = {}
    size = 0
    for lang, found in _by_lang(batches):
        hashed = found.hashes(lang)
        useful = _map_bits(word_map, hashed >> np.uint64(64 - WORD_BITS))
        counts = held.setdefault(lang, {})
        size -= len(counts)
        for m, at, keys in found.phrases(longest, hashed, useful):
            at = at[_map_bits(phrase_map, _survivor_bit(*_partition(keys, partitions)))]
            if not len(at):
                continue
            label = found.codes[at]
            for k in range(1, m):  # equal labels are equal words, whatever the hash
                _, label = np.unique(label * len(found.names) + found.codes[at + k], return_inverse=True)
            _, first, n = np.unique(label, return_index=True, return_counts=True)
            rows = np.stack([found.codes[at[first] + k] for k in range(m)], axis=1).tolist()
            for row, c in zip(rows, n.tolist(), strict=True):
                phrase = b" ".join([found.names[x] for x in row])
                counts[phrase] = counts.get(phrase, 0) + c
        size += len(counts)
        if size > HELD_COUNTS:
            yield from _counted_rows(held, partitions)
            held, size = {}, 0
    if size:
        yield from _counted_rows(held, partitions)


def _total_batches(batches: Iterable[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """(lang, phrase, f) with f >= least; rows come by partition and language."""
    at, totals = None, {}

    def done() -> Iterator[pa.RecordBatch]:
        kept = {p: n for p, n in totals.items() if n >= least}
        if kept:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([at[1]] * len(kept), pa.string()),
                    pa.array(list(kept), pa.binary()).view(pa.string()),
                    pa.array(list(kept.values()), pa.int64()),
                ],
                names=["lang", "phrase", "f"],
            )

    for batch in batches:
        for part, lang, phrases, counts in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
            if (part, lang) != at:
                yield from done()
                at, totals = (part, lang), {}
            for phrase, n in zip(phrases.split(b"\n"), np.frombuffer(counts, "<i8").tolist(), strict=True):
                totals[phrase] = totals.get(phrase, 0) + n
    yield from done()


def phrase_counts(docs: DataFrame, least: int = 100, longest: int = 5) -> tuple[DataFrame, DataFrame]:
    """(lang, n) of all words, and stored (lang, phrase, f) of every phrase of 1 to ``longest`` words with f >= least."""
    texts = docs.select("text", "lang")
    words = texts.mapInArrow(_word_batches, "lang string, phrase string, f bigint, bit bigint")
    words = stored(words.groupBy("lang", "phrase").agg(F.sum("f").alias("f"), F.first("bit").alias("bit")), "words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = words.where(F.col("f") >= least)
    word_map = bit_map(frequent, "bit", WORD_BITS)

    # each word starts at most longest - 1 phrases
    mass = (words.agg(F.sum("f")).first()[0] or 0) * (longest - 1)
    partitions = max(LEAST_PARTITIONS, -(-mass // (least * COUNTERS)))
    sent = texts.mapInArrow(
        partial(_summary_batches, longest=longest, word_map=word_map, partitions=partitions),
        "part bigint, mass bigint, keys binary, counts binary",
    )
    met = sent.repartition("part").sortWithinPartitions("part", F.col("keys").isNotNull())
    survived = met.mapInArrow(partial(_merge_batches, least=least), "bit bigint")
    phrase_map = bit_map(survived, "bit", PHRASE_BITS)

    exact = texts.mapInArrow(
        partial(_exact_batches, longest=longest, word_map=word_map, phrase_map=phrase_map, partitions=partitions),
        "part bigint, lang string, phrases binary, counts binary",
    )
    met = exact.repartition("part").sortWithinPartitions("part", "lang")
    phrases = met.mapInArrow(partial(_total_batches, least=least), "lang string, phrase string, f bigint")
    return totals, stored(frequent.select("lang", "phrase", "f").unionByName(phrases), "phrases")


def _key(phrase: Column) -> Column:
    """One string for phrase and language; a phrase holds no tab."""
    return F.concat(phrase, F.lit("\t"), F.col("lang"))


def collocations(docs: DataFrame, least: int = 100, longest: int = 5, top: int = 2000, share: int = 100) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` collocations of every language.

    Texts with A-Z lower-cased are cut at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those at blanks and
    tabs into words; n counts a language's words. Candidates are phrases of 2 to ``longest`` words
    that occur a >= ``least`` times, overlaps included. Cut after any of its first words, a phrase
    scores floor(1000 * a * n / (l * r)) from the counts l and r of both parts; its lowest score
    counts, of equal ones that of the earliest cut. Left out are candidates within a phrase that has
    one word or more besides and at least ``share`` percent of their occurrences. Order: score and a
    descending, phrase by its UTF-8 bytes. Defined cases: null texts are empty, a null ``lang`` is
    ``und`` and one with it; repeated rows count as often as they stand there; an empty table, or one
    without a frequent phrase, gives no rows; other columns and doc_id are not read.
    """
    totals, counts = phrase_counts(docs, least, longest)
    counted = counts.select("lang", "phrase", "f", F.split("phrase", " ").alias("_w")).withColumn("_m", F.size("_w"))
    candidates = counted.where("_m > 1")

    def joined(start: Column, n: Column) -> Column:
        return F.array_join(F.slice("_w", start, n), " ")

    m = F.col("_m")
    cuts = candidates.select(
        "lang", "phrase", "f", "_w", F.explode(F.sequence(F.lit(1), m - 1)).alias("k"), "_m"
    ).select(
        "lang", "phrase", "f", "k",
        F.posexplode(F.array(_key(joined(F.lit(1), F.col("k"))), _key(joined(F.col("k") + 1, m - F.col("k"))))).alias("side", "part"),
    )
    cuts = stored(cuts, "cuts")
    uses = cuts.groupBy("part").agg(F.count(F.lit(1)).alias("_n"))
    values = counts.select(_key(F.col("phrase")).alias("part"), F.col("f").alias("part_f"))
    valued = stored(uses.join(values, "part"), "parts")
    found = attach(cuts, valued, "part", "_n", "phrase", "inner")
    halves = found.groupBy("lang", "phrase", "f", "k").agg(
        F.max(F.when(F.col("side") == 0, F.col("part_f"))).alias("l"),
        F.max(F.when(F.col("side") == 1, F.col("part_f"))).alias("r"),
    )

    def wide(c: str) -> Column:
        return F.col(c).cast("decimal(18,0)")

    score = F.expr("(CAST(1000 AS DECIMAL(4,0)) * _a * _n) DIV (_l * _r)")
    halves = halves.join(F.broadcast(totals), "lang").withColumns({"_a": wide("f"), "_n": wide("n"), "_l": wide("l"), "_r": wide("r")})
    scored = halves.select("lang", "phrase", "f", "n", "k", "l", "r", score.alias("score"))
    lowest = scored.groupBy("lang", "phrase", "f", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("_s"))

    # a phrase within a longer one is also within one that has a single word more and occurs no less often
    shorter = candidates.where("_m > 2").select(
        "lang", "f", F.explode(F.array(joined(F.lit(1), m - 1), joined(F.lit(2), m - 1))).alias("phrase")
    )
    around = shorter.groupBy("lang", "phrase").agg(F.max("f").alias("_around"))
    alone = lowest.join(around, ["lang", "phrase"], "left").where(
        F.col("_around").isNull() | (F.col("_around") * 100 < F.col("f") * share)
    )
    order = Window.partitionBy("lang").orderBy(F.col("_s.score").desc(), F.col("f").desc(), "phrase")
    ranked = alone.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= top)
    return ranked.select(
        "lang", "rank", "phrase", F.col("f").alias("a"), F.col("_s.l").alias("l"), F.col("_s.r").alias("r"), "n", F.col("_s.score").alias("score")
    )
