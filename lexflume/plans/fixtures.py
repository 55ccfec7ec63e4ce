"""Stand-ins for the library's inputs, derived from the given tables.

Every view exists twice: as DataFrame code and as SQL. All run over whole tables
and whole texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexflume.constants import SEED
from lexflume.functions.text import tokens
from lexflume.operators.prepare import assign_split, label_names
from lexflume.sources.tables import read_table

# SQL pieces. Words are cut at everything Python counts as white space.
_SPACES = (
    r"\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)


def sql_words(col: str) -> str:
    return f"CAST(len(regexp_extract_all({col}, '[^{_SPACES}]+')) AS BIGINT)"


def sql_strip(col: str) -> str:
    return f"regexp_replace({col}, '^[{_SPACES}]+|[{_SPACES}]+$', '', 'g')"


def sql_tokens(col: str) -> str:
    return f"list_filter(string_split_regex(lower({col}), '[^a-z0-9]+'), lambda t: t <> '')"


def sql_key(col: str) -> str:
    return f"md5('{SEED}:' || CAST({col} AS VARCHAR))"


def sql_split(col: str) -> str:
    bucket = f"CAST('0x' || substring({sql_key(col)}, 1, 8) AS BIGINT) % 100"
    return f"CASE WHEN {bucket} < 80 THEN 'train' WHEN {bucket} < 90 THEN 'val' ELSE 'test' END"


_CLASS = "CASE {0} WHEN 0 THEN 'negative' WHEN 1 THEN 'neutral' WHEN 2 THEN 'positive' END"


def sql_class(col: str) -> str:
    return _CLASS.format(col)


def _softmax(first: int) -> str:
    z = [f"CAST(embedding[{i}] AS DOUBLE)" for i in range(first, first + 3)]
    return (
        f"SELECT vec_id, label % 3 AS label, {z[0]} AS z0, {z[1]} AS z1, {z[2]} AS z2, "
        f"greatest({', '.join(z)}) AS top FROM embeddings"
    )


def _scored(source: str) -> str:
    total = "(exp(z0 - top) + exp(z1 - top) + exp(z2 - top))"
    p = ", ".join(f"exp(z{i} - top) / {total} AS p{i}" for i in range(3))
    return (
        f"SELECT vec_id, label, z0, z1, z2, {p}, "
        f"CASE WHEN z0 = top THEN 0 WHEN z1 = top THEN 1 ELSE 2 END AS pred FROM {source}"
    )


def _per_class(conf: str) -> str:
    return f"""
    SELECT c.id AS class_id, tp, support, predicted,
           CASE WHEN predicted = 0 THEN 0.0 ELSE tp / predicted END AS precision,
           CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS recall,
           CASE WHEN support + predicted = 0 THEN 0.0 ELSE 2.0 * tp / (support + predicted) END AS f1
    FROM (SELECT unnest([0, 1, 2]) AS id) c,
         LATERAL (SELECT CAST(coalesce(sum(n) FILTER (WHERE label = c.id AND pred = c.id), 0) AS DOUBLE) AS tp,
                         CAST(coalesce(sum(n) FILTER (WHERE label = c.id), 0) AS DOUBLE) AS support,
                         CAST(coalesce(sum(n) FILTER (WHERE pred = c.id), 0) AS DOUBLE) AS predicted
                  FROM {conf}) s"""


def _metrics(per_class: str, run: str) -> str:
    return f"""
    SELECT '{run}' AS run_id, sum(tp) / sum(support) AS accuracy,
           avg(f1) FILTER (WHERE support + predicted > 0) AS f1_macro,
           avg(precision) FILTER (WHERE support + predicted > 0) AS precision,
           avg(recall) FILTER (WHERE support + predicted > 0) AS recall,
           sum(f1 * support) / sum(support) AS f1_weighted,
           max(f1) FILTER (WHERE class_id = 2) AS f1_positive,
           max(f1) FILTER (WHERE class_id = 1) AS f1_neutral,
           max(f1) FILTER (WHERE class_id = 0) AS f1_negative
    FROM {per_class}"""


_LABEL = "CASE WHEN toxic = 1 THEN 0 WHEN quality = 1 THEN 2 ELSE 1 END"
_PAIRED = (
    "SELECT a.conv_id, a.turn, a.role, a.text AS reference, b.text AS prediction "
    "FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1"
)

# name -> (views it reads, SQL)
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "sent": (
        (),
        f"SELECT doc_id, text, {_LABEL} AS label, {sql_class('(' + _LABEL + ')')} AS label_name, "
        f"{sql_split('doc_id')} AS split FROM documents JOIN labels USING (doc_id)",
    ),
    "rawlab": ((), "SELECT vec_id AS id, label AS raw_label FROM embeddings"),
    "splits": ((), f"SELECT *, {sql_split('doc_id')} AS split FROM documents"),
    "logits": ((), _softmax(1)),
    "tuned_logits": ((), _softmax(4)),
    "scored": (("logits",), _scored("logits")),
    "tuned_scored": (("tuned_logits",), _scored("tuned_logits")),
    "conf": (("scored",), "SELECT label, pred, count(*) AS n FROM scored GROUP BY label, pred"),
    "tuned_conf": (("tuned_scored",), "SELECT label, pred, count(*) AS n FROM tuned_scored GROUP BY label, pred"),
    "per_class_": (("conf",), _per_class("conf")),
    "tuned_per_class": (("tuned_conf",), _per_class("tuned_conf")),
    "runs": (
        ("per_class_", "tuned_per_class"),
        _metrics("per_class_", "baseline") + " UNION ALL " + _metrics("tuned_per_class", "tuned"),
    ),
    "pairs": ((), _PAIRED),
    "refs": (
        ("pairs",),
        "SELECT conv_id, turn, prediction, CASE WHEN role = 'system' THEN '' WHEN turn >= 5 THEN ' -100 -100 ' "
        "WHEN role = 'user' THEN reference || ' -100' ELSE reference END AS reference FROM pairs",
    ),
    "cleaned": (
        ("refs",),
        "SELECT * FROM (SELECT conv_id, turn, prediction, "
        + sql_strip("replace(reference, '-100', '')")
        + " AS reference FROM refs) WHERE reference <> ''",
    ),
    "gen": (
        (),
        "SELECT conv_id, turn, text, replace(replace(text, '.', ';'), chr(10), ' ') AS generated FROM conversations",
    ),
    "keywords_of": (
        ("gen",),
        "SELECT conv_id, turn, text, list_filter(list_transform(string_split(generated, ';'), lambda x: "
        + sql_strip("x")
        + "), lambda x: x <> '')[1:10] AS keywords FROM gen",
    ),
    "keys": (
        (),
        "SELECT doc_id, text AS document, CASE WHEN contains(text, '. ') THEN string_split(text, '. ') "
        f"ELSE CAST([] AS VARCHAR[]) END AS keyphrases, {sql_split('doc_id')} AS split FROM documents",
    ),
    "literal": (
        (),
        f"SELECT conv_id, turn, {sql_tokens('text')} AS toks, role <> 'system' AS well_formed FROM conversations",
    ),
    "batches": (
        (),
        "SELECT event_id // 16 AS batch, sum(value) / 1000 AS batch_seconds, count(*) AS batch_n "
        "FROM events GROUP BY event_id // 16",
    ),
    "latencies": (
        ("batches",),
        "SELECT avg(batch_seconds / batch_n) * 1000 AS mean_latency_ms, "
        "quantile_cont(batch_seconds / batch_n, 0.95) * 1000 AS p95_latency_ms FROM batches",
    ),
    "history": (
        (),
        "SELECT user_id AS run_id, CAST(day(ts) AS INTEGER) AS epoch, "
        "CASE WHEN event_type IN ('click', 'view') THEN 'train' ELSE 'val' END AS phase, value AS loss FROM events",
    ),
    "epochs": (
        ("history",),
        "SELECT run_id, epoch, avg(loss) FILTER (WHERE phase = 'train') AS train_loss, "
        "avg(loss) FILTER (WHERE phase = 'val') AS val_loss FROM history GROUP BY run_id, epoch",
    ),
    "req": (
        (),
        "SELECT conv_id || '-' || turn AS request_id, text, "
        "CASE WHEN role <> 'system' THEN CAST(turn * 4 AS INTEGER) END AS max_keywords FROM conversations",
    ),
    "vocab": (
        (),
        "SELECT token, n, row_number() OVER (ORDER BY n DESC, token) + 1 AS id FROM (SELECT token, count(*) AS n "
        f"FROM (SELECT unnest({sql_tokens('text')}) AS token FROM documents) GROUP BY token)",
    ),
}


def with_views(names: tuple[str, ...], body: str) -> str:
    """The query with the views it reads, and those they read, in front."""
    ordered: list[str] = []

    def need(name: str) -> None:
        for inner in VIEWS[name][0]:
            need(inner)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        need(name)
    if not ordered:
        return body
    return "WITH " + ", ".join(f"{n} AS ({VIEWS[n][1]})" for n in ordered) + " " + body


class Views:
    """The same views as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        """A given table."""
        return read_table(self.spark, self.folder, name)

    def sent(self) -> DataFrame:
        label = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 1, 2).otherwise(1)
        rows = self.table("documents").join(self.table("labels"), "doc_id")
        named = label_names(rows.select("doc_id", "text", label.alias("label")))
        return assign_split(named, "doc_id")

    def rawlab(self) -> DataFrame:
        return self.table("embeddings").select(F.col("vec_id").alias("id"), F.col("label").alias("raw_label"))

    def splits(self) -> DataFrame:
        return assign_split(self.table("documents"), "doc_id")

    def logits(self, first: int = 1) -> DataFrame:
        z = F.slice("embedding", first, 3).cast("array<double>")
        return self.table("embeddings").select("vec_id", (F.col("label") % 3).alias("label"), z.alias("logits"))

    def pairs(self) -> DataFrame:
        turns = self.table("conversations")
        following = turns.select(
            "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("prediction")
        )
        first = turns.select("conv_id", "turn", "role", F.col("text").alias("reference"))
        return first.join(following, ["conv_id", "turn"])

    def refs(self) -> DataFrame:
        ref = (
            F.when(F.col("role") == "system", "")
            .when(F.col("turn") >= 5, " -100 -100 ")
            .when(F.col("role") == "user", F.concat("reference", F.lit(" -100")))
            .otherwise(F.col("reference"))
        )
        return self.pairs().withColumn("reference", ref).drop("role")

    def gen(self) -> DataFrame:
        made = F.translate(F.replace(F.col("text"), F.lit("."), F.lit(";")), "\n", " ")
        return self.table("conversations").select("conv_id", "turn", "text", made.alias("generated"))

    def keys(self) -> DataFrame:
        parts = F.when(F.contains("text", F.lit(". ")), F.split("text", r"\. ")).otherwise(
            F.array().cast("array<string>")
        )
        documents = self.table("documents").select("doc_id", F.col("text").alias("document"), parts.alias("keyphrases"))
        return assign_split(documents, "doc_id")

    def literal(self) -> DataFrame:
        listed = F.concat(F.lit("['"), F.array_join(tokens(F.col("text")), "', '"), F.lit("'"))
        text = F.when(F.col("role") == "system", listed).otherwise(F.concat(listed, F.lit("]")))
        return self.table("conversations").select("conv_id", "turn", text.alias("literal"))

    def batches(self) -> DataFrame:
        batch = F.floor(F.col("event_id") / 16).alias("batch")
        return (
            self.table("events")
            .groupBy(batch)
            .agg((F.sum("value") / 1000).alias("batch_seconds"), F.count(F.lit(1)).alias("batch_n"))
        )

    def history(self) -> DataFrame:
        phase = F.when(F.col("event_type").isin("click", "view"), "train").otherwise("val")
        return self.table("events").select(
            F.col("user_id").alias("run_id"),
            F.dayofmonth("ts").alias("epoch"),
            phase.alias("phase"),
            F.col("value").alias("loss"),
        )

    def req(self) -> DataFrame:
        asked = F.when(F.col("role") != "system", (F.col("turn") * 4).cast("int"))
        return self.table("conversations").select(
            F.concat_ws("-", "conv_id", "turn").alias("request_id"), "text", asked.alias("max_keywords")
        )
