"""Queries: vocabulary, encoding, batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexflume.constants import MAX_DOCUMENT_LEN, MAX_TARGET_LEN, MAX_TEXT_LEN
from lexflume.operators import prepare, sequence
from lexflume.plans.fixtures import Views, sql_key, sql_tokens
from lexflume.plans.registry import registered
from lexflume.session import scratch_path, stored


@registered("SELECT token, n, id FROM vocab", views=("vocab",))
def build_vocab(v: Views) -> DataFrame:
    return sequence.build_vocab(v.table("documents"))


def _vocab(v: Views) -> DataFrame:
    """The vocabulary as it is used: built once, stored, read by the encoders."""
    return stored(sequence.build_vocab(v.table("documents")), "vocab")


def _ids_sql(texts: str, max_len: int, key: str = "doc_id", name: str = "coded") -> str:
    """Ids of the kept tokens as one array per row, whatever its key; rows without tokens are kept."""
    return (
        f"{name}_cut AS (SELECT {key}, row_number() OVER () AS rid, {sql_tokens('text')}[1:{max_len}] AS toks FROM ({texts})), "
        f"{name}_pos AS (SELECT rid, unnest(toks) AS token, generate_subscripts(toks, 1) AS p FROM {name}_cut), "
        f"{name}_known AS (SELECT rid, array_agg(coalesce(id, 1) ORDER BY p) AS ids FROM {name}_pos LEFT JOIN vocab USING (token) "
        f"GROUP BY rid), {name} AS (SELECT {key}, coalesce(ids, CAST([] AS BIGINT[])) AS ids FROM {name}_cut LEFT JOIN {name}_known USING (rid))"
    )


def _repeat(item: str, n: str) -> str:
    return f"list_transform(range({n}), lambda i: {item})"


@registered(
    "SELECT * FROM (WITH "
    + _ids_sql("SELECT doc_id, text FROM documents", MAX_TEXT_LEN)
    + f" SELECT doc_id, array_to_string(ids || {_repeat('0', f'{MAX_TEXT_LEN} - len(ids)')}, ' ') AS input_ids, "
    + f"array_to_string({_repeat('1', 'len(ids)')} || {_repeat('0', f'{MAX_TEXT_LEN} - len(ids)')}, ' ') "
    + "AS attention_mask FROM coded)",
    views=("vocab",),
)
def encode(v: Views) -> DataFrame:
    coded = sequence.encode(v.table("documents"), _vocab(v), MAX_TEXT_LEN)
    return coded.select(
        "doc_id",
        F.array_join("input_ids", " ").alias("input_ids"),
        F.array_join("attention_mask", " ").alias("attention_mask"),
    )


@registered(
    "SELECT * FROM (WITH "
    + _ids_sql("SELECT doc_id, array_to_string(keyphrases, '; ') AS text FROM keys", MAX_TARGET_LEN)
    + f" SELECT doc_id, array_to_string(ids || {_repeat('-100', f'{MAX_TARGET_LEN} - len(ids)')}, ' ') AS labels "
    + "FROM coded)",
    views=("vocab", "keys"),
)
def encode_target(v: Views) -> DataFrame:
    targets = prepare.pick_keyphrases(v.keys())
    coded = sequence.encode_target(targets, _vocab(v), MAX_TARGET_LEN)
    return coded.select("doc_id", F.array_join("labels", " ").alias("labels"))


def _inputs_sql(max_len: int, ids: str = "ids") -> str:
    return (
        f"array_to_string({ids} || {_repeat('0', f'{max_len} - len({ids})')}, ' ') AS input_ids, "
        f"array_to_string({_repeat('1', f'len({ids})')} || {_repeat('0', f'{max_len} - len({ids})')}, ' ') AS attention_mask"
    )


# Turns of a conversation have equal keys, system turns none.
_TURN_KEY = "CASE WHEN role <> 'system' THEN conv_id END AS conv_id"


@registered(
    "SELECT * FROM (WITH "
    + _ids_sql(f"SELECT {_TURN_KEY}, text FROM conversations", 32, "conv_id")
    + f" SELECT conv_id, {_inputs_sql(32)} FROM coded)",
    views=("vocab",),
)
def encode_turns(v: Views) -> DataFrame:
    """Rows with repeated and null keys, unknown tokens among them."""
    turns = v.table("conversations").select(F.expr(_TURN_KEY), "text")
    coded = sequence.encode(turns, _vocab(v), 32, key="conv_id")
    return coded.select(
        "conv_id",
        F.array_join("input_ids", " ").alias("input_ids"),
        F.array_join("attention_mask", " ").alias("attention_mask"),
    )


@registered(
    "SELECT * FROM (WITH "
    + _ids_sql("SELECT doc_id, document AS text FROM keys", MAX_DOCUMENT_LEN, name="source")
    + ", "
    + _ids_sql("SELECT doc_id, array_to_string(keyphrases, '; ') AS text FROM keys", MAX_TARGET_LEN, name="target")
    + f" SELECT doc_id, {_inputs_sql(MAX_DOCUMENT_LEN, 'source.ids')}, "
    + f"array_to_string(target.ids || {_repeat('-100', f'{MAX_TARGET_LEN} - len(target.ids)')}, ' ') AS labels "
    + "FROM source JOIN target USING (doc_id))",
    views=("vocab", "keys"),
)
def encode_records(v: Views) -> DataFrame:
    """Document and target of one model input as one record."""
    coded = sequence.encode_records(prepare.pick_keyphrases(v.keys()), _vocab(v))
    joined = [F.array_join(c, " ").alias(c) for c in ("input_ids", "attention_mask", "labels")]
    return coded.select("doc_id", *joined)


@registered(
    f"SELECT conv_id, turn, array_to_string({sql_tokens('text')}[1:{MAX_TARGET_LEN}], ' ') AS decoded FROM conversations"
)
def decode_target(v: Views) -> DataFrame:
    """Target labels back to text: the round trip over a vocabulary that knows every token."""
    turns = v.table("conversations")
    vocab = stored(sequence.build_vocab(turns), "vocab")
    labels = sequence.encode_target(turns.withColumn("key", F.struct("conv_id", "turn")), vocab, key="key", text="text")
    back = sequence.decode_target(labels, vocab, key="key")
    return back.select("key.conv_id", "key.turn", "decoded")


@registered(
    "SELECT doc_id, p AS position, (p - 1) // 16 AS batch_id FROM (SELECT doc_id, "
    f"row_number() OVER (ORDER BY {sql_key('doc_id')}, doc_id) AS p FROM documents)"
)
def shuffle_and_batch(v: Views) -> DataFrame:
    return sequence.shuffle_and_batch(v.table("documents").select("doc_id"), "doc_id", 16)


@registered(
    "SELECT doc_id, p AS position, (p - 1) // 32 AS batch_id FROM "
    "(SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS p FROM documents)"
)
def batch_in_order(v: Views) -> DataFrame:
    return sequence.shuffle_and_batch(v.table("documents").select("doc_id"), "doc_id", 32, shuffle=False)


@registered(
    "SELECT * FROM (WITH "
    + _ids_sql("SELECT doc_id, text FROM documents", MAX_TEXT_LEN)
    + f", placed AS (SELECT doc_id, row_number() OVER (ORDER BY {sql_key('doc_id')}, doc_id) - 1 AS p FROM documents), "
    + f"inputs AS (SELECT doc_id, {_inputs_sql(MAX_TEXT_LEN)} FROM coded) "
    + "SELECT p // 16 AS batch_id, CAST(count(*) AS INTEGER) AS n, string_agg(doc_id, ' ' ORDER BY p) AS keys, "
    + "string_agg(input_ids, '|' ORDER BY p) AS input_ids, string_agg(attention_mask, '|' ORDER BY p) AS attention_mask "
    + "FROM placed JOIN inputs USING (doc_id) GROUP BY 1)",
    views=("vocab",),
)
def batch_records(v: Views) -> DataFrame:
    """Shuffled, padded batches of 16 documents, stored by ranges of batches and read again."""
    coded = sequence.encode(v.table("documents"), _vocab(v), MAX_TEXT_LEN)
    path = scratch_path(v.spark, "batches")
    sequence.write_batches(sequence.batch_records(coded, "doc_id", 16, ["input_ids", "attention_mask"]), path, per_file=64)
    found = sequence.read_batches(v.spark, path, per_file=64)
    rows = [F.array_join(F.transform(c, lambda r: F.array_join(r, " ")), "|").alias(c) for c in ("input_ids", "attention_mask")]
    return found.select("batch_id", "n", F.array_join("keys", " ").alias("keys"), *rows)
