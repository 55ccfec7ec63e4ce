"""Python list literals as column functions: read and written without leaving the row.

A literal is cut into its tokens; the tokens must make up all of it, in the order of a list. Each string
token is then cut into escapes and what stands between them, and those pieces are decoded one by one.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Escapes that would hide where a string ends, and the two marks themselves, as MARK and a letter.
MARK, BETWEEN = "\x01", "\x02"
_MASKED = {MARK: "X", BETWEEN: "Y", "\\\\": "B", "\\'": "S", '\\"': "D", "\\\n": "N", "\\\r": "R"}
_MEANT = {"X": MARK, "Y": BETWEEN, "B": "\\", "S": "'", "D": '"', "N": "", "R": ""}
# An empty string before a third quote would start a longer kind of string, which is not read.
_STRING = r"""[uU]?(?:'[^'\n\r]++'|''(?!')|"[^"\n\r]++"|""(?!"))"""
_NUMBER = r"[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?"
_TOKEN = rf"{_STRING}|None|True|False|{_NUMBER}|[\[\],]|\s+"
_PIECE = (
    r"\\u[dD][89abAB][0-9a-fA-F]{2}\\u[dD][c-fC-F][0-9a-fA-F]{2}|\\x[0-9a-fA-F]{2}|\\u[0-9a-fA-F]{4}|\\U[0-9a-fA-F]{8}"
    rf"|\\[0-7]{{1,3}}|\\[\s\S]|{MARK}[A-Z]|[^\\{MARK}]+"
)
# One-letter escapes of Python strings.
_LETTERS = {"n": "\n", "t": "\t", "r": "\r", "a": "\a", "b": "\b", "f": "\f", "v": "\v"}


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    return F.element_at(F.transform(F.array(value), use), 1)


def _utf8(point: Column) -> Column:
    """The character of a code point; null for surrogates and for numbers that are none."""

    def bits(shift: int, keep: int, mark: int) -> Column:
        return F.shiftright(point, shift).bitwiseAND(F.lit(keep)).bitwiseOR(F.lit(mark))

    def joined(*parts: Column) -> Column:
        return F.decode(F.unhex(F.concat(*[F.lpad(F.hex(p), 2, "0") for p in parts])), "UTF-8")

    return (
        F.when(point < 0x80, joined(point))
        .when(point < 0x800, joined(bits(6, 0x1F, 0xC0), bits(0, 0x3F, 0x80)))
        .when((point >= 0xD800) & (point < 0xE000), F.lit(None))
        .when(point < 0x10000, joined(bits(12, 0x0F, 0xE0), bits(6, 0x3F, 0x80), bits(0, 0x3F, 0x80)))
        .when(point < 0x110000, joined(bits(18, 0x07, 0xF0), bits(12, 0x3F, 0x80), bits(6, 0x3F, 0x80), bits(0, 0x3F, 0x80)))
    )


def _number(digits: Column, base: int) -> Column:
    return F.conv(digits, base, 10).cast("bigint")


def _decoded(piece: Column) -> Column:
    """Text of one piece of a string token; null where Python cannot read it."""
    kind = F.substring(piece, 2, 1)
    hexadecimal = F.substring(piece, 3, 8)
    pair = F.lit(0x10000) + (_number(F.substring(piece, 3, 4), 16) - 0xD800) * 1024 + _number(F.substring(piece, 9, 4), 16) - 0xDC00
    letters, meant = [F.create_map(*[F.lit(x) for item in m.items() for x in item]) for m in (_LETTERS, _MEANT)]
    return (
        F.when(F.startswith(piece, F.lit(MARK)), F.element_at(meant, kind))
        .when(~F.startswith(piece, F.lit("\\")), piece)
        .when(F.length(piece) == 12, _utf8(pair))
        .when(kind.isin("x", "u", "U") & (F.length(piece) > 2), _utf8(_number(hexadecimal, 16)))
        .when(kind.rlike("^[0-7]$"), _utf8(_number(F.substring(piece, 2, 3), 8)))
        .when(kind.isin("x", "u", "U", "N"), F.lit(None))
        .otherwise(F.coalesce(F.element_at(letters, kind), piece))
    )


def _joined_or_null(parts: Column) -> Column:
    """Strings put together; null where one is null."""
    return F.when(~F.exists(parts, lambda p: p.isNull()), F.array_join(parts, ""))


def _text(token: Column) -> Column:
    """Text of a string token."""
    inner = F.regexp_replace(token, r"^[uU]?['\"]|['\"]$", "")
    return _joined_or_null(F.transform(F.regexp_extract_all(inner, F.lit(_PIECE), F.lit(0)), _decoded))


def _item(tokens: Column) -> Column:
    """(none, text) of the tokens between two commas; a null text where they are no item."""
    first, strings = F.get(tokens, F.lit(0)), F.forall(tokens, lambda t: t.rlike(r"^[uU]?['\"]"))
    atom = (F.size(tokens) == 1) & ~first.isin("", ",", "[", "]")
    # neighbouring strings are one item
    text = F.when(strings, _joined_or_null(F.transform(tokens, _text))).when(atom, first)
    return F.struct((first == "None").alias("none"), text.alias("text"))


def parse_list(col: Column) -> Column:
    """List literal such as ``['a', "b", None, 3]`` to an array of strings; null where it cannot be read.

    Strings with every escape but named characters, neighbouring strings, ``None`` (a null item), and
    ``True``, ``False`` and numbers as they are written; a trailing comma is fine. A pair of surrogate
    escapes is the character it stands for, a lone one cannot be read. Lists within lists, tuples and
    other expressions cannot be read either.
    """
    none = F.lit(None).cast("array<string>")
    masked = reduce(lambda c, m: F.replace(c, F.lit(m[0]), F.lit(MARK + m[1])), _MASKED.items(), col)

    def tokens_of(found: Column) -> Column:
        same = (F.array_join(found, "") == masked) & ~F.contains(col, F.lit("\x00"))
        return F.when(same, F.filter(found, lambda t: ~t.rlike(r"^\s+$")))

    def inside(tokens: Column) -> Column:
        n = F.size(tokens)
        whole = (n >= 2) & (F.get(tokens, F.lit(0)) == "[") & (F.element_at(tokens, -1) == "]")
        trailing = (n > 3) & (F.get(tokens, n - 2) == ",")
        return F.when(whole, F.slice(tokens, 2, F.greatest(F.lit(0), n - F.when(trailing, 3).otherwise(2))))

    def read(inner: Column) -> Column:
        parts = F.split(F.array_join(inner, BETWEEN), f"{BETWEEN},{BETWEEN}")
        found = F.transform(parts, lambda p: _item(F.split(p, BETWEEN)))
        items = _let(
            found,
            lambda r: F.when(
                ~F.exists(r, lambda x: x["text"].isNull()), F.transform(r, lambda x: F.when(~x["none"], x["text"]))
            ),
        )
        return F.when(F.size(inner) == 0, F.array().cast("array<string>")).when(inner.isNotNull(), items)

    tokens = _let(F.regexp_extract_all(masked, F.lit(_TOKEN), F.lit(0)), tokens_of)
    return F.coalesce(_let(_let(tokens, inside), read), none)


def write_list(col: Column) -> Column:
    """Array of strings to a list literal that ``parse_list`` and Python read back; a null item is ``None``."""
    coded = {"\\": "\\\\", "'": "\\'", "\n": "\\n", "\r": "\\r", "\x00": "\\x00"}

    def quoted(item: Column) -> Column:
        inside = reduce(lambda c, pair: F.replace(c, F.lit(pair[0]), F.lit(pair[1])), coded.items(), item)
        return F.coalesce(F.concat(F.lit("'"), inside, F.lit("'")), F.lit("None"))

    listed = F.array_join(F.transform(F.coalesce(col, F.array().cast("array<string>")), quoted), ", ")
    return F.concat(F.lit("["), listed, F.lit("]"))
