"""Registered queries over the given tables, and the SQL of their results where SQL can state it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexflume.llm import (
    bpe,
    chat,
    collocations,
    credentials,
    embedding_dedup,
    exact_dedup,
    langid,
    licenses,
    lm,
    minhash,
    mixing,
    periodic,
    toxicity,
)
from lexflume.llm.oracles import CHAT, COLLOCATIONS, CREDENTIALS

# Target weights of the domains: languages as the labelled table's good rows have them, and its junk.
DOMAIN_WEIGHTS = {"en": 0.52, "de": 0.16, "fr": 0.16, "es": 0.12, "junk": 0.04}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Components of vectors of one label whose cosine is 0.93 or more."""
    return embedding_dedup.near_duplicates(_table(spark, folder, "embeddings"), least=0.93)


def vocabulary() -> str:
    """Path of the byte-level vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op2_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of the BPE ids of every text and of the text decoded from them."""
    return bpe.round_trip(_table(spark, folder, "documents"), vocabulary())


def op3_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation formatted by the template, and what is read back from the output."""
    control = "</s>[INST] ok [/INST]"
    extra = spark.sql("SELECT -1L AS conv_id, explode(array(named_struct('turn', 0L, 'role', 'user'), named_struct('turn', 1L, 'role', 'assistant'))) AS t")
    extra = extra.select("conv_id", "t.turn", "t.role", F.lit(control).alias("text"))
    turns = chat.canonical_turns(_table(spark, folder, "conversations")).unionByName(chat.canonical_turns(extra))
    whole = chat.formatted(turns)
    read = whole.select(
        "conv_id",
        "formatted",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    lines = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def fitted_domains(spark: SparkSession, folder: str) -> mixing.Domains:
    """Classifier of domains from the labelled documents: junk where quality is 0, else the language."""
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    domain = F.when(F.col("quality") == 0, F.lit("junk")).otherwise(F.col("lang"))
    sample = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = sample.orderBy(F.xxhash64("doc_id"), "doc_id").limit(mixing.FIT_ROWS)
    labelled = docs.select("doc_id", "text", "lang").join(F.broadcast(chosen), "doc_id")
    return mixing.fit_domains(labelled.select("doc_id", "text", domain.alias("domain")))


def op4_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Rates that bring the expected domain tokens of all documents to the target weights."""
    return mixing.mix(_table(spark, folder, "documents"), fitted_domains(spark, folder), DOMAIN_WEIGHTS)


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Expected severity of every document."""
    docs = _table(spark, folder, "documents")
    return toxicity.severity(docs, toxicity.train(docs, _table(spark, folder, "labels")))


def op6_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    """Unigram and model log10 probabilities of every text."""
    return lm.score(_table(spark, folder, "documents"))


def op7_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose sets of two-word shingles have a Jaccard of 0.8 or more."""
    return minhash.near_duplicates(_table(spark, folder, "documents"), width=2, percent=80)


def op8_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """License phrases and notices of every document."""
    return licenses.scan(_table(spark, folder, "documents"))


def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Predicted language of every document, learned from two thirds of them."""
    docs = _table(spark, folder, "documents")
    held = langid.held_out(F.col("doc_id"))
    names, vectors = langid.prototypes(docs.where(~held).select("text", "lang"))
    found = langid.identify(docs, names, vectors)
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op10_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of equal texts; the largest doc_id of each stays."""
    return exact_dedup.exact_duplicates(_table(spark, folder, "documents"))


def op11_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of every text, told apart by how many sources hold the same value."""
    return credentials.scan(_table(spark, folder, "documents"))


def op12_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The 2,000 strongest collocations of every language."""
    return collocations.collocations(_table(spark, folder, "documents"), least=100, longest=5, top=2000, share=100)


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of words of every text; every tenth document has a stretch repeated first."""
    found = periodic.periodic_runs(_table(spark, folder, "documents"), planted=True)
    return found.drop("runs", "collapsed")


QUERIES = {
    f.__name__: f
    for f in (
        op1_embedding_near_dedup,
        op2_bpe_round_trip,
        op3_chat_format,
        op4_mix_sources,
        op5_toxicity,
        op6_lm_score,
        op7_minhash_near_dedup,
        op8_license_scan,
        op9_language_id,
        op10_exact_dedup,
        op11_secret_scan,
        op12_phrase_collocations,
        op13_periodic_runs,
    )
}

ORACLES = {
    "op3_chat_format": CHAT,
    "op11_secret_scan": CREDENTIALS,
    "op12_phrase_collocations": COLLOCATIONS,
    "op10_exact_dedup": """
        WITH d AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
            FROM documents
        )
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY t)
    """,
}
