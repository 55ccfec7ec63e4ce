"""Byte-level BPE by traversal of the trie of distinct words.

A word's encoding is fixed by its last token and the encoding of what stands before it: a token that
ends at a position is the last one exactly if it and the last token of the prefix before it are never
merged across their border. So the distinct words of a batch are walked in byte order, which is the
depth-first order of their trie: the last token of each prefix is found once, and all words that begin
with it share it. Encodings are read back along last tokens.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from lexflume.llm.texts import kept, pieces

# Distinct words of a generation; a Python worker remembers the encodings of two, and a word that is met again moves on.
CACHED_WORDS = 100_000
# Pairs of neighbouring tokens of which a Python worker remembers whether they stay apart.
CACHED_PAIRS = 400_000
# Fixed value: the split pattern of byte-level BPE (the ByteLevel pre-tokenizer's published pattern).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The same pattern for texts of ASCII alone, which the plain engine cuts in half the time.
_SPACE = "\\t-\\r "
SPLIT_ASCII = rf"'(?:s|t|re|ve|m|ll|d)| ?[A-Za-z]+| ?[0-9]+| ?[^{_SPACE}A-Za-z0-9]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
# Rows and bytes of texts whose words a task holds at one time.
PIECE = (256, 1 << 20)


def byte_letters() -> dict[str, int]:
    """The letters that vocabulary files write for bytes: printable ones stand for themselves, the rest follow from 256."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Bpe:
    """Encoder and decoder of one vocabulary file (tokenizers' JSON layout, byte level)."""

    def __init__(self, content: str):
        spec = json.loads(content)
        letters = byte_letters()
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        self.specials = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        vocabulary = {k: i for k, i in spec["model"]["vocab"].items() if k not in self.special}
        raw = {k: bytes(letters[c] for c in k) for k in vocabulary}
        self.token = {raw[k]: i for k, i in vocabulary.items()}
        self.bytes = {i: b for b, i in self.token.items()} | {i: s.encode() for s, i in self.special.items()}
        self.table = pa.array([self.bytes.get(i) for i in range(max(self.bytes, default=-1) + 1)], pa.large_binary())
        self.rank, self.parts, self.born = {}, {}, {}
        for r, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            x, y, z = vocabulary[a], vocabulary[b], vocabulary[a + b]
            self.rank[x << 32 | y] = r
            if z not in self.born:
                self.parts[z], self.born[z] = (x, y), r
        self.next, self.fall, self.ends = self._automaton()
        self.split, self.split_ascii = regex.compile(SPLIT), re.compile(SPLIT_ASCII)
        self.size = {i: len(b) for b, i in self.token.items()}
        self.agreed: dict[int, bool] = {}
        self.known: dict[str | int, bytes] = {}
        self.older: dict[str | int, bytes] = {}

    def _automaton(self) -> tuple[dict[int, int], list[int], list[tuple[tuple[int, int], ...]]]:
        """Suffix automaton of all tokens: transitions (state << 8 | byte), fall-back states, and the
        (length, id) of tokens that end in a state, longest first."""
        step, fall, ends, order = {}, [0], [()], []
        for word, i in self.token.items():
            state = 0
            for b in word:
                key = state << 8 | b
                if key not in step:
                    step[key] = len(ends)
                    order.append((state, b))
                    ends.append(())
                    fall.append(0)
                state = step[key]
            ends[state] = ((len(word), i),)
        depth = {0: 0}
        for state, b in order:
            depth[step[state << 8 | b]] = depth[state] + 1
        for state, b in sorted(order, key=lambda e: depth[e[0]]):
            target, back = step[state << 8 | b], state
            while back:
                back = fall[back]
                if (key := back << 8 | b) in step:
                    fall[target] = step[key]
                    break
            ends[target] += ends[fall[target]]
        return step, fall, ends

    def _move(self, state: int, b: int) -> int:
        """Next state of the automaton; found transitions are remembered."""
        back = state
        while back and (back << 8 | b) not in self.next:
            back = self.fall[back]
        found = self.next[state << 8 | b] = self.next.get(back << 8 | b, 0)
        return found

    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """Tokens that stand at one edge of a token while it forms, each with the merge rank that ends it."""
        found, until = [], float("inf")
        while True:
            found.append((token, until))
            if token not in self.parts:
                return found
            token, until = self.parts[token][side], self.born[token]

    def agree(self, left: int, right: int) -> bool:
        """Whether two neighbouring tokens stay apart: no merge across their border comes first.

        Merges are done by rank, leftmost first: a border merge of rank r needs its left part not to
        be taken up by r itself, and its right part not before r.
        """
        held = self.agreed.get(left << 32 | right)
        if held is None:
            held = not any(
                (r := self.rank.get(x << 32 | y)) is not None and r < x_until and r <= y_until
                for x, x_until in self._edge(left, 1)
                for y, y_until in self._edge(right, 0)
            )
            self.agreed[left << 32 | right] = held
        return held

    def encode_words(self, found: Iterable[bytes]) -> dict[bytes, bytes]:
        """Encodings (ids as little-endian unsigned 32-bit integers) of distinct words."""
        out = {}
        last, states = [-1], [0]  # of the prefixes of the word before, by length
        step, ends, agreed, size = self.next, self.ends, self.agreed, self.size
        packed = [struct.Struct(f"<{n}I").pack for n in range(17)]
        before = b""
        for word in sorted(found):
            depth = 0
            for x, y in zip(before, word, strict=False):
                if x != y:
                    break
                depth += 1
            del last[depth + 1 :], states[depth + 1 :]
            state, before = states[-1], word
            for b in word[depth:]:
                depth += 1
                key = state << 8 | b
                state = step[key] if key in step else self._move(state, b)
                for n, t in ends[state]:
                    if n == depth:
                        break
                    key = last[-n] << 32 | t
                    if agreed[key] if key in agreed else self.agree(last[-n], t):
                        break
                else:
                    raise ValueError("the vocabulary lacks a single byte")
                last.append(t)
                states.append(state)
            ids, at = [], depth
            while at:
                t = last[at]
                ids.append(t)
                at -= size[t]
            ids.reverse()
            out[word] = packed[len(ids)](*ids) if len(ids) < len(packed) else struct.pack(f"<{len(ids)}I", *ids)
        return out

    def words(self, text: str) -> list[str]:
        """The pieces that are encoded on their own."""
        return (self.split_ascii if text.isascii() else self.split).findall(text)

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        collecting = gc.isenabled()
        gc.disable()  # words and trie nodes are millions of small live objects that no collection can free
        try:
            return self._encode_batch(texts)
        finally:
            if collecting:
                gc.enable()

    def _encode_batch(self, texts: list[str]) -> list[bytes]:
        cut = []
        for text in texts:
            if self.specials and self.specials.search(text):
                row, at = [], 0
                for m in self.specials.finditer(text):
                    row += self.words(text[at : m.start()])
                    row.append(self.special[m.group()])
                    at = m.end()
                cut.append(row + self.words(text[at:]))
            else:
                cut.append(self.words(text))
        if len(self.known) > CACHED_WORDS:
            self.known, self.older = {}, self.known
        if len(self.agreed) > CACHED_PAIRS:
            self.agreed.clear()
        fresh = []
        for w in set().union(*cut).difference(self.known):
            ids = self.older.get(w)
            if ids is None:
                fresh.append(w)
            else:
                self.known[w] = ids
        by_bytes = {w.encode("utf-8"): w for w in fresh if isinstance(w, str)}
        for raw, ids in self.encode_words(by_bytes).items():
            self.known[by_bytes[raw]] = ids
        for special in (w for w in fresh if not isinstance(w, str)):
            self.known[special] = struct.pack("<I", special)
        return [b"".join(map(self.known.__getitem__, row)) for row in cut]

    def decode_batch(self, rows: list[bytes]) -> list[str]:
        """Texts of the ids of each row, as ``decode`` gives them; the tokens of all rows are looked up at once."""
        ids = np.frombuffer(b"".join(rows), "<u4")
        taken = self.table.take(pa.array(ids))
        if taken.null_count:
            raise KeyError("an id that the vocabulary lacks")
        _, offsets, data = taken.buffers()
        ends = np.frombuffer(offsets, np.int64, len(ids) + 1, taken.offset * 8) if len(ids) else np.zeros(1, np.int64)
        cuts = ends[np.cumsum([0] + [len(r) // 4 for r in rows])].tolist()
        whole = memoryview(data) if data is not None else memoryview(b"")
        return [str(whole[a:b], "utf-8", "replace") for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def decode(self, ids: bytes) -> str:
        """Text of ids, special tokens included; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.bytes.__getitem__, memoryview(ids).cast("I"))).decode("utf-8", "replace")


def _loaded(content: str) -> Bpe:
    """One encoder per Python worker and vocabulary, so that words are remembered from task to task."""
    return kept(("bpe", hashlib.sha256(content.encode()).hexdigest()), lambda: Bpe(content))


def round_trip(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: whole texts encoded, and their ids decoded again.

    ``vocabulary`` is the path of a tokenizers JSON file, read once on the driver and broadcast (its
    size does not depend on the data). Row-local: no shuffle. Defined cases: null and empty texts
    have no tokens; a word of any length is one path in the trie; control strings of the vocabulary
    within a text are their special token, as in the tokenizers library; repeated rows and null
    doc_ids give a row each; other columns are not read.
    """
    with open(vocabulary, encoding="utf-8") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())
    kind = docs.schema["doc_id"].dataType.simpleString()

    def go(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(content.value)
        for batch in pieces(batches, *PIECE):
            ids = bpe.encode_batch([t or "" for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(i) // 4 for i in ids], pa.int64()),
                    pa.array([hashlib.sha256(i).hexdigest() for i in ids]),
                    pa.array([hashlib.sha256(t.encode("utf-8")).hexdigest() for t in bpe.decode_batch(ids)]),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(go, schema)


def encode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id and ids (array of int) of every row."""
    with open(vocabulary, encoding="utf-8") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())
    kind = docs.schema["doc_id"].dataType.simpleString()

    def go(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(content.value)
        for batch in pieces(batches):
            ids = bpe.encode_batch([t or "" for t in batch.column(1).to_pylist()])
            lists = pa.array([list(memoryview(i).cast("I")) for i in ids], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(go, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id and text of every row of ``encode``; null ids give a null text."""
    with open(vocabulary, encoding="utf-8") as f:
        content = encoded.sparkSession.sparkContext.broadcast(f.read())
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def go(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(content.value)
        for batch in pieces(batches):
            lists = batch.column(1).to_pylist()
            texts = [None if i is None else bpe.decode(struct.pack(f"<{len(i)}I", *i)) for i in lists]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(go, f"doc_id {kind}, text string")
