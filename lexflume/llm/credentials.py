"""Secret scans by corpus-wide ownership of candidate values.

Candidates and their places come from each text alone. Their hashes are counted by distinct
repositories and owners over the whole corpus: a value that many owners hold is a copied example,
one that few hold and that looks random is a live credential of theirs. Base kinds are reported
whatever their owners; further kinds only where they look live. Native columns throughout.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexflume.llm.relations import attach
from lexflume.session import stored

# Base kinds in their order, pattern, group of the value, fewest characters of the value.
BASE = [
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
]
# Further kinds: published shapes of issued tokens, and long words of digits and letters in both cases.
FURTHER = [
    (
        "issued",
        r"gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{35}"
        r"|eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}",
        0,
        16,
    ),
    ("mixed", r"[A-Za-z0-9+/_-]{24,}", 0, 24),
]
KINDS = [*BASE, *FURTHER]
# From this many distinct owners on a value is a copied example.
EXAMPLE_OWNERS = 3
# A live credential has at least this many distinct characters.
LIVE_CHARS = 8
# Marks that no pattern can match; texts that hold them get another such character in their place.
MARK, END, OTHER = "\x01", "\x02", "\x03"
BLOCK = 64

CANDIDATES = "array<struct<start:bigint,kind:int,end:bigint,hash:string,looks:boolean>>"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Use a costly value several times in an expression, but compute it once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _total(items: Column) -> Column:
    return F.aggregate(items, F.lit(0).cast("bigint"), lambda s, x: s + x)


def running_totals(steps: Column) -> Column:
    """Sum of an array's items up to each, in blocks, so that long arrays stay cheap."""

    def of(items: Column) -> Column:
        n = F.size(items)
        starts = F.when(n > 0, F.sequence(F.lit(1), n, F.lit(BLOCK))).otherwise(F.array().cast("array<int>"))

        def whole(blocks: Column) -> Column:
            def within(totals: Column) -> Column:
                return F.transform(
                    blocks,
                    lambda block, b: let(
                        _total(F.slice(totals, 1, b)),
                        lambda before: F.transform(block, lambda _, i: before + _total(F.slice(block, 1, i + 1))),
                    ),
                )

            return F.flatten(let(F.transform(blocks, _total), within))

        return let(F.transform(starts, lambda at: F.slice(items, at, F.lit(BLOCK))), whole)

    return let(steps, of)


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """Leftmost non-overlapping matches: array of (start, end, value), in code points from 0, end exclusive."""
    marked = F.regexp_replace(text, pattern, f"{MARK}$0{END}${group}{END}")
    # each part but the first is: the match, END, its value, END, what follows up to the next match
    parts = F.transform(F.split(marked, MARK), lambda p: F.split(p, END))

    def placed(found: Column) -> Column:
        sizes = F.transform(
            F.slice(found, 2, F.greatest(F.lit(0), F.size(found) - 1)),
            lambda p, i: F.struct(
                (F.length(F.element_at(F.get(found, i), -1)) + F.length(F.get(p, 0))).cast("bigint").alias("step"),
                F.length(F.get(p, 0)).cast("bigint").alias("size"),
                F.get(p, 1).alias("value"),
            ),
        )
        return let(
            sizes,
            lambda s: F.zip_with(
                s,
                running_totals(F.transform(s, lambda x: x["step"])),
                lambda x, end: F.struct((end - x["size"]).alias("start"), end.alias("end"), x["value"].alias("value")),
            ),
        )

    return let(parts, placed)


def _looks_random(value: Column) -> Column:
    return F.size(F.array_remove(F.array_distinct(F.split(value, "")), "")) >= LIVE_CHARS


def _of_kind(text: Column, number: int) -> Column:
    name, pattern, group, least = KINDS[number]

    def wanted(m: Column) -> Column:
        long = F.length(m["value"]) >= least
        if name != "mixed":
            return long
        return long & m["value"].rlike("[0-9]") & m["value"].rlike("[a-z]") & m["value"].rlike("[A-Z]")

    return F.transform(
        F.filter(matches(text, pattern, group), wanted),
        lambda m: F.struct(
            m["start"].alias("start"),
            F.lit(number).alias("kind"),
            m["end"].alias("end"),
            F.sha2(m["value"], 256).alias("hash"),
            _looks_random(m["value"]).alias("looks"),
        ),
    )


def candidates(text: Column) -> Column:
    """All candidates of a text, by start, then kind: array of CANDIDATES."""
    safe = F.translate(F.coalesce(text, F.lit("")), MARK + END, OTHER + OTHER)
    return F.array_sort(F.concat(*[_of_kind(safe, number) for number in range(len(KINDS))]))


def _listed(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    names = F.array(*[F.lit(k[0]) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def _is_kind(kind: int, span: Column) -> Column:
    return span["kind"] == kind


def _count(spans: Column) -> Column:
    return F.size(spans).cast("bigint")


def ownership(rows: DataFrame) -> DataFrame:
    """hash, repositories, owners, uses of every candidate value, from (owner, repository, found).

    Every step is combined in the tasks first, so a value held by a third of all rows is no hot key.
    """
    held = rows.select("owner", "repository", F.explode(F.array_distinct(F.transform("found", lambda c: c["hash"]))).alias("hash"))
    by_repository = held.groupBy("hash", "owner", "repository").agg(F.count(F.lit(1)).alias("uses"))
    by_owner = by_repository.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repositories"), F.sum("uses").alias("uses"))
    return by_owner.groupBy("hash").agg(
        F.sum("repositories").alias("repositories"), F.count(F.lit(1)).alias("owners"), F.sum("uses").alias("uses")
    )


def scan(docs: DataFrame, repository: str = "source", example_owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example, live_spans: a row per row of ``docs``.

    Base spans are the leftmost non-overlapping matches of each kind in the whole text whose value
    is long enough; ``base_sha256`` digests ``kind:start:end`` of them. A value is an example where
    ``example_owners`` or more distinct owners hold it (the owner is what stands before the first
    ``/`` of the ``repository`` column), else live where it has LIVE_CHARS distinct characters. ``spans``
    holds the base spans and the live ones of the further kinds; ``n_live``, ``n_example`` and
    ``live_spans`` tell of all kinds. Defined cases: a null or empty text has no span, empty strings
    and the digest of nothing; a null repository is one owner of its own; copies of a text have the
    same spans; a null doc_id stays null; repeated rows get equal results; an empty table gives
    none; other columns are not read.
    """
    text = F.col("text")
    owner = F.substring_index(F.col(repository), "/", 1)
    rows = stored(
        docs.select(
            "doc_id", F.col(repository).cast("string").alias("repository"), owner.alias("owner"),
            candidates(text).alias("found"), F.sha2(F.coalesce(text, F.lit("")), 256).alias("text_key"),
        ),
        "candidates",
    )
    holding = rows.where(F.size("found") > 0)

    # copies of a text are judged once
    texts = stored(
        holding.groupBy("text_key").agg(F.first("found").alias("found"), F.count(F.lit(1)).alias("_copies")), "texts"
    )
    facts = texts.select("text_key", F.explode("found").alias("c")).select("text_key", "c", F.col("c.hash").alias("hash"))
    uses = facts.groupBy("hash").agg(F.count(F.lit(1)).alias("_n"))
    known = stored(ownership(holding).join(uses, "hash").select("hash", "owners", "_n"), "owners")
    example = F.col("owners") >= example_owners
    judged = attach(facts, known, "hash", "_n", "text_key", "inner").select(
        "text_key",
        F.struct(
            F.col("c.start"), F.col("c.kind"), F.col("c.end"), example.alias("example"), (~example & F.col("c.looks")).alias("live")
        ).alias("s"),
    )
    spans = judged.groupBy("text_key").agg(F.array_sort(F.collect_list("s")).alias("judged"))
    spans = stored(spans.join(texts.select("text_key", "_copies"), "text_key"), "judged")

    schema = "array<struct<start:bigint,kind:int,end:bigint,example:boolean,live:boolean>>"
    whole = attach(holding.select("doc_id", "text_key"), spans, "text_key", "_copies", "doc_id", "inner").select("doc_id", "judged")
    none = rows.where(F.size("found") == 0).select("doc_id", F.array().cast(schema).alias("judged"))
    base = F.filter("judged", lambda s: s["kind"] < len(BASE))
    live = F.filter("judged", lambda s: s["live"])
    listed = F.filter("judged", lambda s: (s["kind"] < len(BASE)) | s["live"])
    return whole.unionByName(none).select(
        "doc_id",
        *[_count(F.filter("judged", partial(_is_kind, k))).alias(f"n_{name}") for k, (name, *_) in enumerate(BASE)],
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(listed).alias("spans"),
        _count(live).alias("n_live"),
        _count(F.filter("judged", lambda s: s["example"])).alias("n_example"),
        _listed(live).alias("live_spans"),
    )
