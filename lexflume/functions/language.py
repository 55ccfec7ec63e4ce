"""The two text measures that built-in functions cannot express, as Arrow UDFs.

Both are row-local: Spark partitions the rows, each task runs a small helper
over Arrow batches, nothing is shuffled.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The helpers travel with the job, so executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STEM_CACHE = 1 << 16


def lcs_length(a, b) -> int:
    """Length of the longest common subsequence, whole sequences of any length.

    Bit-parallel form (Crochemore et al. 2001; Hyyro 2004): one bit per item of
    the shorter side, held in one integer without an upper width.
    """
    if len(a) > len(b):
        a, b = b, a
    where = {}
    for i, item in enumerate(a):
        where[item] = where.get(item, 0) | (1 << i)
    full = (1 << len(a)) - 1
    free = full
    for item in b:
        hits = free & where.get(item, 0)
        if hits:
            free = ((free + hits) | (free - hits)) & full
    return len(a) - free.bit_count()


# Items of a batch that are Python objects at one time.
SLICE_ITEMS = 1 << 16


def _slices(items: pa.Array) -> Iterator[tuple[int, int]]:
    """Where a batch of arrays is cut: rows of about SLICE_ITEMS items each, one row at least."""
    sizes = pc.fill_null(pc.list_value_length(items), 0).to_numpy(zero_copy_only=False)
    parts = np.cumsum(sizes) // SLICE_ITEMS
    ends = [*(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(items)]
    return zip([0, *ends[:-1]], ends, strict=True)


def _coded(a: pa.Array, b: pa.Array) -> Iterator[tuple[int, int, list[tuple[np.ndarray, np.ndarray]]]]:
    """Slices of two columns of arrays: rows, number of distinct items, and of both sides each item's row and code."""
    for start, end in _slices(a):
        sides = [z.slice(start, end - start) for z in (a, b)]
        flat = [z.flatten() for z in sides]
        coded = pa.concat_arrays(flat).dictionary_encode(null_encoding="encode")
        codes = np.split(coded.indices.to_numpy().astype(np.int64), [len(flat[0])])
        sizes = [pc.fill_null(pc.list_value_length(z), 0).to_numpy(zero_copy_only=False) for z in sides]
        rows = [np.repeat(np.arange(len(n)), n) for n in sizes]
        yield end - start, max(len(coded.dictionary), 1), list(zip(rows, codes, strict=True))


def _among(keys: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of keys in a sorted array, and whether they are there."""
    at = np.minimum(np.searchsorted(known, keys), max(len(known) - 1, 0))
    return at, known[at] == keys if len(known) else np.zeros(len(keys), bool)


def lcs_lengths(a: pa.Array, b: pa.Array) -> pa.Array:
    """``lcs_length`` row by row; items are compared as numbers, a null array counts as empty.

    Items that the other side's array lacks are in no common subsequence and are left out ahead.
    """
    out: list[int] = []
    for size, width, sides in _coded(a, b):
        keys = [rows * width + codes for rows, codes in sides]
        kept = [x[_among(x, np.unique(y))[1]] for x, y in (keys, keys[::-1])]
        ends = [np.searchsorted(x // width, np.arange(size + 1)) for x in kept]
        for i in range(size):
            x, y = (k[e[i] : e[i + 1]].tolist() for k, e in zip(kept, ends, strict=True))
            out.append(lcs_length(x, y) if x else 0)
    return pa.array(out, pa.int32())


def shared_gram_counts(a: pa.Array, b: pa.Array, n: int) -> pa.Array:
    """Runs of n neighbouring items that two arrays share row by row, repeated runs counted as often as both have them."""
    out = [np.zeros(0, np.int64)]
    for size, width, (first, second) in _coded(a, b):
        cut = len(first[0])
        # both sides after one another, rows of the second numbered on: equal runs get equal numbers
        rows, codes = np.r_[first[0], second[0] + size], np.r_[first[1], second[1]]
        at = np.arange(max(len(codes) - n + 1, 0))
        at = at[rows[at] == rows[at + n - 1]]
        grams = codes[at]
        for i in range(1, n):
            if i > 1:
                grams = np.unique(grams, return_inverse=True)[1]
            grams = grams * width + codes[at + i]
        span = int(grams.max(initial=0)) + 1
        if size * span >= 1 << 62:
            grams = np.unique(grams, return_inverse=True)[1]
            span = len(grams) + 1
        keys = rows[at] * span + grams
        left = at < cut
        known, n_known = np.unique(keys[~left] - size * span, return_counts=True)
        places, there = _among(keys[left], known)
        shared = np.minimum(np.bincount(places[there], minlength=len(known)), n_known)
        out.append(np.bincount(known // span, shared, size).astype(np.int64))
    return pa.array(np.concatenate(out), pa.int32())


def shared_grams(n: int):
    """Column function: how many runs of n neighbouring items two arrays share; a null array counts as empty."""

    @F.arrow_udf(T.IntegerType())
    def shared(a: pa.Array, b: pa.Array) -> pa.Array:
        return shared_gram_counts(a, b, n)

    return shared


@F.arrow_udf(T.IntegerType())
def lcs(a: pa.Array, b: pa.Array) -> pa.Array:
    """Longest common subsequence of two arrays; a null array counts as empty."""
    return lcs_lengths(a, b)


# Suffix rules of the Porter stemmer (1980) with its later published
# departures (bli, logi, fulli, short words). Each step is suffix -> replacement.
_STEP_2 = {
    "ational": "ate",
    "tional": "tion",
    "enci": "ence",
    "anci": "ance",
    "izer": "ize",
    "bli": "ble",
    "alli": "al",
    "entli": "ent",
    "eli": "e",
    "ousli": "ous",
    "ization": "ize",
    "ation": "ate",
    "ator": "ate",
    "alism": "al",
    "iveness": "ive",
    "fulness": "ful",
    "ousness": "ous",
    "aliti": "al",
    "iviti": "ive",
    "biliti": "ble",
    "fulli": "ful",
    "logi": "log",
}
_STEP_3 = {
    "icate": "ic",
    "ative": "",
    "alize": "al",
    "iciti": "ic",
    "ical": "ic",
    "ful": "",
    "ness": "",
}
_STEP_4 = (
    "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize"
).split()
# Words the rules would get wrong.
_IRREGULAR = {
    "sky": "sky",
    "skies": "sky",
    "dying": "die",
    "lying": "lie",
    "tying": "tie",
    "news": "news",
    "inning": "inning",
    "innings": "inning",
    "outing": "outing",
    "outings": "outing",
    "canning": "canning",
    "cannings": "canning",
    "howe": "howe",
    "proceed": "proceed",
    "exceed": "exceed",
    "succeed": "succeed",
}


def _shape(word: str) -> str:
    """Vowels as ``v``, consonants as ``c``; ``y`` is a vowel after a consonant."""
    marks = []
    for ch in word:
        after_consonant = bool(marks) and marks[-1] == "c"
        marks.append("v" if ch in "aeiou" or (ch == "y" and after_consonant) else "c")
    return "".join(marks)


def _measure(word: str) -> int:
    """Number of vowel runs followed by a consonant run."""
    return _shape(word).count("vc")


def _short_ending(word: str) -> bool:
    """Consonant-vowel-consonant at the end, or a two-letter vowel-consonant word."""
    shape = _shape(word)
    return shape == "vc" or (shape.endswith("cvc") and word[-1] not in "wxy")


def _longest_suffix(word: str, suffixes) -> str | None:
    fitting = [s for s in suffixes if word.endswith(s)]
    return max(fitting, key=len) if fitting else None


def _plural(word: str) -> str:
    if word.endswith("sses"):
        return word[:-2]
    if word.endswith("ies"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("s") and not word.endswith("ss"):
        return word[:-1]
    return word


def _past_and_gerund(word: str) -> str:
    if word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    ending = _longest_suffix(word, ("ed", "ing"))
    stem = word[: -len(ending)] if ending else ""
    if "v" not in _shape(stem):
        return word
    if stem.endswith(("at", "bl", "iz")):
        return stem + "e"
    if len(stem) > 1 and stem[-1] == stem[-2] and _shape(stem)[-1] == "c":
        return stem if stem[-1] in "lsz" else stem[:-1]
    return stem + "e" if _measure(stem) == 1 and _short_ending(stem) else stem


def _final_y(word: str) -> str:
    stem = word[:-1]
    if word.endswith("y") and len(stem) > 1 and _shape(stem)[-1] == "c":
        return stem + "i"
    return word


def _replace_suffix(word: str, rules: dict[str, str]) -> str:
    suffix = _longest_suffix(word, rules)
    if suffix is None:
        return word
    stem = word[: -len(suffix)]
    # "logi" is judged with its l kept on the stem side.
    judged = word[:-3] if suffix == "logi" else stem
    if _measure(judged) == 0:
        return word
    replaced = stem + rules[suffix]
    return _replace_suffix(replaced, rules) if suffix == "alli" else replaced


def _drop_suffix(word: str) -> str:
    suffix = _longest_suffix(word, _STEP_4)
    if suffix is None:
        return word
    stem = word[: -len(suffix)]
    if _measure(stem) < 2 or (suffix == "ion" and not stem.endswith(("s", "t"))):
        return word
    return stem


def _tidy_end(word: str) -> str:
    if word.endswith("e"):
        stem = word[:-1]
        m = _measure(stem)
        if m > 1 or (m == 1 and not _short_ending(stem)):
            word = stem
    if word.endswith("ll") and _measure(word[:-1]) > 1:
        word = word[:-1]
    return word


def stem(word: str) -> str:
    """Porter stem of one lower-case token; tokens up to three characters stay."""
    if len(word) <= 3:
        return word
    if word in _IRREGULAR:
        return _IRREGULAR[word]
    word = _final_y(_past_and_gerund(_plural(word)))
    word = _replace_suffix(_replace_suffix(word, _STEP_2), _STEP_3)
    return _tidy_end(_drop_suffix(word))


@F.pandas_udf(T.StringType())
def stem_word(words: pd.Series) -> pd.Series:
    """Stem per token, for a column of distinct tokens."""
    return words.map(stem, na_action="ignore")


def stems_of(arrays: pa.Array, stemmer: Callable[[str], str]) -> pa.Array:
    """Arrays of the items' stems: each distinct item of a batch is stemmed once, a null array stays null."""
    coded = arrays.flatten().dictionary_encode()
    stems = pa.array([stemmer(t) for t in coded.dictionary.to_pylist()], pa.string()).take(coded.indices)
    sizes = pc.list_value_length(arrays)
    ends = np.r_[0, np.cumsum(pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False))]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), stems, mask=pc.is_null(sizes))


@F.arrow_udf(T.ArrayType(T.StringType()))
def stem_tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Stem every token of an array; each task keeps a bounded cache of stems."""
    cached = lru_cache(maxsize=STEM_CACHE)(stem)
    for arrays in batches:
        yield stems_of(arrays, cached)
