"""Chat formatting: one canonical turn layout from differently shaped conversations, and a reversible template.

The nested field paths of a table are hashed to a fingerprint, which selects a declarative mapping
to canonical turns. The template writes ``[TURN]role[TEXT]text[/TURN]`` per turn. Inside roles and
texts ``\\``, ``<`` and ``[`` are escaped, so no control string, ours or another template's, can
stand in a formatted text but where the template puts it. All of it is native column work.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

OPEN, TEXT, CLOSE = "[TURN]", "[TEXT]", "[/TURN]"
# Escapes of the template, in the order in which they are put in.
ESCAPES = (("\\", "\\s"), ("<", "\\l"), ("[", "\\b"))
# Roles of other layouts and what they are called here.
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def field_paths(schema: T.StructType, of: tuple[str, ...] = ()) -> list[str]:
    """Nested field paths of a schema, sorted; array elements are marked ``[]``. ``of`` limits the top level."""

    def walk(kind: T.DataType, at: str) -> list[str]:
        if isinstance(kind, T.StructType):
            return [p for f in kind.fields for p in walk(f.dataType, f"{at}.{f.name}" if at else f.name)]
        if isinstance(kind, T.ArrayType):
            return walk(kind.elementType, at + "[]")
        return [at]

    return sorted(p for p in walk(schema, "") if not of or p.split(".")[0].split("[")[0] in of)


def fingerprint(paths: list[str]) -> int:
    """Hash of sorted field paths (CRC-32 of their lines)."""
    return zlib.crc32("\n".join(paths).encode())


def _escape(c: Column) -> Column:
    c = F.coalesce(c, F.lit(""))
    for plain, coded in ESCAPES:
        c = F.replace(c, F.lit(plain), F.lit(coded))
    return c


def _unescape(c: Column) -> Column:
    for plain, coded in reversed(ESCAPES):
        c = F.replace(c, F.lit(coded), F.lit(plain))
    return c


def _known_role(role: Column) -> Column:
    out = role
    for theirs, ours in ROLES.items():
        out = F.when(role == theirs, F.lit(ours)).otherwise(out)
    return out


def _turns(items: str, role: str, text: str) -> Callable[[DataFrame], DataFrame]:
    def to_rows(df: DataFrame) -> DataFrame:
        return df.select("conv_id", F.posexplode(F.col(items)).alias("turn", "_t")).select(
            "conv_id", F.col("turn").cast("bigint").alias("turn"),
            _known_role(F.col("_t")[role]).alias("role"), F.col("_t")[text].alias("text"),
        )

    return to_rows


def _exchange(prompt: list[str], answer: str) -> Callable[[DataFrame], DataFrame]:
    def to_rows(df: DataFrame) -> DataFrame:
        asked = F.concat_ws("\n\n", *[F.when(F.col(p) != "", F.col(p)) for p in prompt])
        both = F.array(
            F.struct(F.lit("user").alias("role"), asked.alias("text")),
            F.struct(F.lit("assistant").alias("role"), F.col(answer).alias("text")),
        )
        return _turns("_both", "role", "text")(df.select("conv_id", both.alias("_both")))

    return to_rows


# Layouts by their field paths: columns a layout is known by, and its mapping to rows by turn.
LAYOUTS: list[tuple[list[str], Callable[[DataFrame], DataFrame]]] = [
    (["conv_id", "role", "text", "turn"], lambda df: df.select("conv_id", F.col("turn").cast("bigint").alias("turn"), "role", "text")),
    (["conv_id", "messages[].content", "messages[].role"], _turns("messages", "role", "content")),
    (["conv_id", "conversations[].from", "conversations[].value"], _turns("conversations", "from", "value")),
    (["completion", "conv_id", "prompt"], _exchange(["prompt"], "completion")),
    (["conv_id", "prompt", "response"], _exchange(["prompt"], "response")),
    (["conv_id", "input", "instruction", "output"], _exchange(["instruction", "input"], "output")),
    (["conv_id", "instruction", "output"], _exchange(["instruction"], "output")),
]
MAPPINGS = {fingerprint(paths): (paths, mapping) for paths, mapping in LAYOUTS}


def canonical_turns(df: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) of any known layout.

    The fingerprint of the whole schema is looked up first; a table with extra columns is known by
    the layout whose paths are all among its own (the one with most paths). Another layout fails.
    Defined cases: a conversation whose list of messages is null or empty has no turns and gives no
    row; a null prompt is left out of the question; a null answer or text stays null here and is empty
    in the output; an empty table gives none; other columns are not read.
    """
    paths = field_paths(df.schema)
    found = MAPPINGS.get(fingerprint(paths))
    if found is None:
        inside = [(p, m) for p, m in LAYOUTS if set(p) <= set(paths)]
        if not inside:
            raise ValueError(f"no layout for the fields {paths}")
        found = max(inside, key=lambda x: len(x[0]))
    return found[1](df)


def formatted(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns, formatted, loss_spans (start, length of each assistant text in ``formatted``).

    One row per conversation, which is one text by definition: its turns are brought together in one
    shuffle, other conversations never with them. Defined cases: turns go by (turn, role, text),
    nulls first, so ties and repeated rows are ordered alike in every run and all kept; a null text
    or role is empty; rows with a null conv_id are one conversation; an empty table gives none.
    """
    role, text = _escape(F.col("role")), _escape(F.col("text"))
    cut = turns.select("conv_id", "turn", "role", "text", role.alias("_role"), text.alias("_text"))
    head = F.concat(F.lit(OPEN), F.col("_role"), F.lit(TEXT))
    sized = cut.withColumn("_head", F.length(head)).withColumn("_size", F.length("_text"))
    order = [F.col(c).asc_nulls_first() for c in ("turn", "role", "text")]
    by_turn = Window.partitionBy("conv_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.select(
        "conv_id",
        F.row_number().over(Window.partitionBy("conv_id").orderBy(*order)).alias("_at"),
        F.concat(head, "_text", F.lit(CLOSE)).alias("_piece"),
        (F.coalesce(F.sum(F.col("_head") + F.col("_size") + len(CLOSE)).over(by_turn), F.lit(0)) + F.col("_head")).alias("_start"),
        "_size",
        F.coalesce(F.col("role") == "assistant", F.lit(False)).alias("_loss"),
    )
    gathered = placed.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("_at", "_piece", "_start", "_size", "_loss"))).alias("_turns")
    )
    spans = F.transform(
        F.filter("_turns", lambda t: t["_loss"]),
        lambda t: F.struct(t["_start"].alias("start"), t["_size"].cast("bigint").alias("length")),
    )
    return gathered.select(
        "conv_id",
        F.size("_turns").cast("bigint").alias("n_turns"),
        F.concat_ws("", F.transform("_turns", lambda t: t["_piece"])).alias("formatted"),
        spans.alias("loss_spans"),
    )


def read_turns(whole: Column) -> Column:
    """Array of (role, text), read back from a formatted conversation."""
    pieces = F.slice(F.split(whole, r"\[TURN\]"), 2, 1 << 30)

    def read(piece: Column) -> Column:
        parts = F.split(F.replace(piece, F.lit(CLOSE), F.lit("")), r"\[TEXT\]")
        return F.struct(_unescape(F.get(parts, F.lit(0))).alias("role"), _unescape(F.get(parts, F.lit(1))).alias("text"))

    return F.transform(pieces, read)


def read_loss(whole: Column, spans: Column) -> Column:
    """All text under the loss mask, in order and unescaped."""
    cut = F.transform(spans, lambda s: _unescape(F.substring(whole, (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return F.concat_ws("", cut)
