import ast
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexflume.functions import language, scores, text


def one(frame, value, fn, kind="string"):
    return frame([(value,)], f"c {kind}", 1).select(fn(F.col("c")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "value",
    ["", "  ", "a", " a  b\tc\n", "a b", "a\x1cb\x1fc", "a b　c", "a\u0085b", "a​b", "é ü x"],
)
def test_word_count_is_pythons(frame, value):
    assert one(frame, value, text.word_count) == len(value.split())


def test_null_text_has_no_length(frame):
    assert one(frame, None, text.word_count) is None
    assert one(frame, None, text.tokens) is None


@pytest.mark.parametrize("value", [" a ", "\x1c a ", "\n\n", "", "a b", "　x"])
def test_strip_is_pythons(frame, value):
    assert one(frame, value, text.strip) == value.strip()


def test_tokens(frame):
    assert one(frame, "It's 2 o'Clock, ÉTÉ!", text.tokens) == ["it", "s", "2", "o", "clock", "t"]
    assert one(frame, "...!", text.tokens) == []


@pytest.mark.parametrize("n, cut", [(199, False), (200, False), (201, True)])
def test_preview(frame, n, cut):
    value = "é" * n
    assert one(frame, value, text.preview) == (value[:200] + "..." if cut else value)
    assert one(frame, value, lambda c: text.preview(c, always=True)) == value[:200] + "..."


def test_split_keywords(frame):
    value = " a ;; \tb ; ;c d;e"
    assert one(frame, value, text.split_keywords) == ["a", "b", "c d", "e"]
    assert one(frame, value, lambda c: text.split_keywords(c, 2)) == ["a", "b"]
    assert one(frame, "", text.split_keywords) == []


@pytest.mark.parametrize(
    "value, expected",
    [
        ("['a', 'b']", ["a", "b"]),
        ('["it\'s", "x y"]', ["it's", "x y"]),
        ("[]", []),
        ("", []),
        (None, []),
        ("bad", []),
        ("['a', ", []),
        ("['a'] x", []),
        ("nan", []),
    ],
)
def test_parse_keyword_list(frame, value, expected):
    assert one(frame, value, text.parse_keyword_list) == expected


def test_list_literal_round_trip(frame):
    items = ["a 'quoted' one", 'say "so"', "back\\slash", "new\nline", "é"]
    back = one(frame, items, lambda c: text.parse_keyword_list(text.keyword_list_literal(c)), "array<string>")
    assert back == items
    assert one(frame, None, lambda c: text.parse_keyword_list(text.keyword_list_literal(c)), "array<string>") == []


def test_join_keywords(frame):
    assert one(frame, ["a", None, "b"], text.join_keywords, "array<string>") == "a; b"
    assert one(frame, [], text.join_keywords, "array<string>") == ""
    assert one(frame, None, text.join_keywords, "array<string>") == ""


@pytest.mark.parametrize("n, expected", [(1, ["a", "b", "c"]), (2, ["a b", "b c"]), (3, ["a b c"]), (4, [])])
def test_ngrams(frame, n, expected):
    assert one(frame, ["a", "b", "c"], lambda c: text.ngrams(c, n), "array<string>") == expected


def test_item_counts_and_shared_items(frame):
    rng = random.Random(1)
    rows = []
    for i in range(60):
        a = [rng.choice("abcdefg") for _ in range(rng.randint(0, 30))]
        b = [rng.choice("abcdefg") for _ in range(rng.randint(0, 30))]
        rows.append((i, a, b))
    df = frame(rows, "id int, a array<string>, b array<string>")
    found = {
        r["id"]: r
        for r in df.select("id", text.item_counts(F.col("a")).alias("c"), text.shared_items(F.col("a"), F.col("b")).alias("s")).collect()
    }
    for i, a, b in rows:
        assert {c["item"]: c["n"] for c in found[i]["c"]} == Counter(a)
        assert found[i]["s"] == sum((Counter(a) & Counter(b)).values())


def test_softmax(frame):
    for z in ([1.0, 2.0, 3.0], [1000.0, 1000.0, -1000.0], [0.0, 0.0, 0.0]):
        p = one(frame, z, scores.softmax, "array<double>")
        assert abs(sum(p) - 1) < 1e-12 and all(x >= 0 for x in p)
    assert one(frame, [5.0, float("-inf"), 5.0], scores.softmax, "array<double>") == [0.5, 0.0, 0.5]


def test_argmax_takes_the_first_of_equals(frame):
    assert one(frame, [1.0, 3.0, 3.0], scores.argmax, "array<double>") == 1


def test_class_name(frame):
    df = frame([(0,), (1,), (2,), (3,), (None,)], "c int", 1)
    assert [r[0] for r in df.select(scores.class_name(F.col("c"))).collect()].count(None) == 2


# Examples printed in the stemmer's paper, and words of its later departures.
STEMS = {
    "caresses": "caress", "ponies": "poni", "ties": "tie", "cats": "cat", "feed": "feed", "agreed": "agre",
    "plastered": "plaster", "bled": "bled", "motoring": "motor", "sing": "sing", "conflated": "conflat",
    "troubled": "troubl", "sized": "size", "hopping": "hop", "falling": "fall", "hissing": "hiss", "fizzed": "fizz",
    "failing": "fail", "filing": "file", "happy": "happi", "sky": "sky", "relational": "relat", "conditional": "condit",
    "rational": "ration", "digitizer": "digit", "radicalli": "radic", "differentli": "differ", "vietnamization": "vietnam",
    "predication": "predic", "operator": "oper", "feudalism": "feudal", "decisiveness": "decis", "hopefulness": "hope",
    "formaliti": "formal", "sensitiviti": "sensit", "sensibiliti": "sensibl", "triplicate": "triplic", "formative": "form",
    "electrical": "electr", "goodness": "good", "revival": "reviv", "allowance": "allow", "airliner": "airlin",
    "adjustable": "adjust", "irritant": "irrit", "replacement": "replac", "adoption": "adopt", "effective": "effect",
    "probate": "probat", "rate": "rate", "cease": "ceas", "controll": "control", "roll": "roll", "used": "use",
    "died": "die", "was": "was", "news": "news", "skies": "sky",
}


def test_stem(frame):
    assert {w: language.stem(w) for w in STEMS} == STEMS
    words = list(STEMS)
    assert one(frame, words, language.stem_tokens, "array<string>") == list(STEMS.values())
    assert one(frame, "happiness", language.stem_word) == "happi"


def lcs_by_table(a, b):
    before = [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for j, y in enumerate(b):
            row.append(before[j] + 1 if x == y else max(before[j + 1], row[j]))
        before = row
    return before[-1]


def test_lcs_equals_dynamic_programming(frame):
    rng = random.Random(2)
    rows = [(0, [], ["a"]), (1, None, ["a"]), (2, ["a"], ["a"])]
    for i in range(3, 60):
        rows.append((i, [rng.choice("abcd") for _ in range(rng.randint(0, 200))], [rng.choice("abcd") for _ in range(rng.randint(0, 200))]))
    df = frame(rows, "id int, a array<string>, b array<string>")
    found = {r["id"]: r["l"] for r in df.select("id", language.lcs("a", "b").alias("l")).collect()}
    assert found == {i: lcs_by_table(a or [], b or []) for i, a, b in rows}


def test_keyword_list_escapes(frame):
    literals = [r"['a\xa0b', 'c']", r"['\x41\x42']", r"['\\\\x41']", r"['\\x41']", r"['\U000000e9']", "['a', 'b',]", "['a,']"]
    expected = [ast.literal_eval(s) for s in literals]
    df = frame(list(enumerate(literals)), "id int, s string")
    found = df.select("id", text.parse_keyword_list(F.col("s")).alias("k")).orderBy("id").collect()
    assert [r["k"] for r in found] == expected


def _literal(rng, items):
    """A list literal of these items as some program may write it."""

    def string(x):
        quote = rng.choice("'\"")
        out = ""
        for c in x:
            ways = [c] if c not in "\\\n\r\x00" + quote else []
            n = ord(c)
            ways += [f"\\U{n:08x}"] + [f"\\u{n:04X}"] * (n < 0x10000) + [f"\\x{n:02x}"] * (n < 256) + [f"\\{n:03o}"] * (n < 256)
            ways += ["\\" + c] * (c in "\\'\"") + ["\\n"] * (c == "\n") + [c] * 6 * (c not in "\\\n\r\x00" + quote)
            out += rng.choice(ways)
        return rng.choice(["", "", "u"]) + quote + out + quote

    def item(x):
        if isinstance(x, str):
            return string(x) if rng.random() < 0.9 or len(x) < 2 else string(x[:1]) + rng.choice(["", " "]) + string(x[1:])
        return repr(x)

    space = lambda: rng.choice(["", "", " ", "\n "])
    body = ",".join(space() + item(x) + space() for x in items)
    return "[" + body + ("," if items and rng.random() < 0.2 else "") + "]"


def _as_python_reads(literal):
    try:
        found = ast.literal_eval(literal)
    except (ValueError, SyntaxError):
        return []
    if not isinstance(found, list) or any(isinstance(x, (list, tuple, dict, set, bytes)) for x in found):
        return []
    return [None if x is None else str(x) for x in found]


def test_lists_are_read_as_python_reads_them(frame):
    rng = random.Random(21)
    letters = ["a", "b", " ", "'", '"', "\\", "\n", "\t", ",", "[", "]", "é", "漢", "😀", "\x07", "n", "7"]
    literals = []
    for _ in range(500):
        items = [rng.choice([None, True, 7, -3, 12, *["".join(rng.choices(letters, k=rng.randrange(6))) for _ in range(6)]]) for _ in range(rng.randrange(5))]
        made = _literal(rng, items)
        assert ast.literal_eval(made) == items
        literals.append(made)
        at = rng.randrange(len(made))
        literals.append(made[:at] + rng.choice(["", ",", "'", "]", "\\", "x"]) + made[at + rng.randrange(2) :])
    literals += [r"['\\q']", "['a' 'b', \"c\"]", "[None, None,]", "[,]", "['a',,]", "[[1], 'a']", "('a', 'b')", "nothing", "", "[", "['\\x4']", "['\\N{DASH}']", "[" + "'a'," * 20_000 + "]", "['" + "\\\\n" * 50_000 + "']", "[" + "'b'" * 20_000 + "]"]
    literals = [x for x in literals if "\x00" not in x]
    df = frame(list(enumerate(literals)), "id int, s string", 4)
    found = {r["id"]: r["k"] for r in df.select("id", text.parse_keyword_list(F.col("s")).alias("k")).collect()}
    import warnings

    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        wrong = [(s, found[i], _as_python_reads(s)) for i, s in enumerate(literals) if found[i] != _as_python_reads(s)]
    assert wrong == []


def test_surrogate_escapes(frame):
    assert one(frame, r"['\ud83d\ude00']", text.parse_keyword_list) == ["😀"]
    assert one(frame, r"['\ud83d']", text.parse_keyword_list) == []
    assert one(frame, r"['\U00110000']", text.parse_keyword_list) == []


def test_written_lists_are_read_by_python(frame):
    items = ["a 'b'", 'c "d"', "\\", "\n\r\t", "é😀", None, ""]
    written = one(frame, items, text.keyword_list_literal, "array<string>")
    assert ast.literal_eval(written) == items
    assert one(frame, written, text.parse_keyword_list) == items
