"""Text columns: words, tokens, keyword strings, previews."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexflume.constants import PREVIEW_CHARS
from lexflume.functions.literals import parse_list, write_list

# Everything Python's str.split() and str.strip() take as white space.
_SPACE = r"\s\x1c-\x1f"
_WORD = rf"(?U)[^{_SPACE}]+"
_EDGES = rf"(?U)^[{_SPACE}]+|[{_SPACE}]+$"


def word_count(col: Column) -> Column:
    """Number of words between white space; null for a null text."""
    return F.when(col.isNotNull(), F.regexp_count(col.cast("string"), F.lit(_WORD)))


def tokens(col: Column, parts: int = -1) -> Column:
    """Lower-case alphanumeric words in order of appearance; with ``parts``, the last of so many is the uncut rest."""
    return F.array_remove(F.split(F.lower(col), "[^a-z0-9]+", parts), "")


def strip(col: Column) -> Column:
    """Cut all white space from both ends (``trim`` takes blanks only)."""
    return F.regexp_replace(col, _EDGES, "")


def preview(col: Column, always: bool = False) -> Column:
    """First 200 characters and ``...``; short texts stay as they are unless ``always``."""
    short = F.concat(F.substring(col, 1, PREVIEW_CHARS), F.lit("..."))
    return short if always else F.when(F.length(col) > PREVIEW_CHARS, short).otherwise(col)


def join_keywords(col: Column) -> Column:
    """Keyword array to one string; null items are left out, no keywords give ``''``."""
    return F.coalesce(F.array_join(col, "; "), F.lit(""))


def split_keywords(col: Column, k: Column | int | None = None) -> Column:
    """Keyword string to array: split on ``;``, strip, drop blanks, first ``k``."""
    parts = F.filter(F.transform(F.split(col, ";"), strip), lambda x: x != "")
    if k is None:
        return parts
    return F.slice(parts, F.lit(1), k if isinstance(k, Column) else F.lit(k))


def parse_keyword_list(col: Column) -> Column:
    """List literal such as ``['a', "b", None]`` to array; whatever Python could not read as one gives ``[]``."""
    return F.coalesce(parse_list(col), F.array().cast("array<string>"))


def keyword_list_literal(col: Column) -> Column:
    """Array to a list literal that ``parse_keyword_list`` reads back (for CSV exchange)."""
    return write_list(col)


def ngrams(col: Column, n: int) -> Column:
    """Runs of ``n`` neighbouring tokens, each as one blank-separated string."""
    if n == 1:
        return col
    starts = F.when(F.size(col) >= n, F.sequence(F.lit(1), F.size(col) - (n - 1)))
    grams = F.transform(starts, lambda i: F.array_join(F.slice(col, i, F.lit(n)), " "))
    return F.coalesce(grams, F.array().cast("array<string>"))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Use a costly array several times in an expression, but compute it once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def item_counts(items: Column) -> Column:
    """Distinct items of an array with how often each occurs: array of (item, n).

    Row-local counterpart of group-and-count: one native sort, then linear steps.
    """

    def runs(ordered: Column) -> Column:
        n = F.size(ordered)
        places = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
        starts = F.filter(places, lambda i: ~F.get(ordered, i - 1).eqNullSafe(F.get(ordered, i)))
        return _let(
            starts,
            lambda firsts: F.transform(
                firsts,
                lambda at, i: F.struct(
                    F.get(ordered, at).alias("item"),
                    (F.coalesce(F.get(firsts, i + 1), n) - at).alias("n"),
                ),
            ),
        )

    return _let(F.sort_array(items), runs)


def shared_items(a: Column, b: Column) -> Column:
    """Size of the intersection of two arrays, repeated items counted as often as both have them."""

    def numbered(items: Column) -> Column:
        """Second, third, ... occurrences become items of their own."""
        return F.flatten(
            F.transform(
                item_counts(items),
                lambda c: F.transform(
                    F.sequence(F.lit(1), c["n"]), lambda k: F.concat(c["item"], F.lit("\x01"), k.cast("string"))
                ),
            )
        )

    return F.size(F.array_intersect(numbered(a), numbered(b)))
