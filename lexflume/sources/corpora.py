"""Corpus files: split CSVs, partitioned datasets, the manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexflume.constants import SPLITS
from lexflume.operators.prepare import union_splits

SENTIMENT_SCHEMA = T.StructType(
    [
        T.StructField("text", T.StringType()),
        T.StructField("label", T.IntegerType()),
        T.StructField("label_name", T.StringType()),
    ]
)
KEYWORD_SCHEMA = T.StructType(
    [
        T.StructField("document", T.StringType()),
        T.StructField("keywords_str", T.StringType()),
        T.StructField("keywords_list", T.StringType()),
    ]
)
SCHEMAS = {"sentiment": SENTIMENT_SCHEMA, "keywords": KEYWORD_SCHEMA}

# Quotes are doubled and every field is quoted, so texts keep quotes, backslashes and newlines.
# A row that does not fit its file's header ends the read; so does a file whose header differs from the first one's.
_CSV = {"header": "true", "escape": '"', "encoding": "UTF-8"}
_CSV_IN = {**_CSV, "mode": "FAILFAST", "enforceSchema": "false"}
_CSV_OUT = {**_CSV, "quoteAll": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _read_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool) -> DataFrame:
    """Columns of ``schema`` by the names in the header; one the files lack is null, a value of another type fails."""
    # A multi-line CSV file is read by one task: many part files keep the read parallel.
    found = spark.read.options(multiLine=str(multi_line).lower(), **_CSV_IN).csv(path)
    given = set(found.columns)
    return found.select(
        *[(F.col(f"`{f.name}`") if f.name in given else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def _fill_keywords(df: DataFrame) -> DataFrame:
    """An empty field comes back as null; as a training target it means no keywords."""
    if "keywords_str" not in df.columns:
        return df
    return df.withColumn("keywords_str", F.coalesce("keywords_str", F.lit("")))


def read_split_csv(
    spark: SparkSession,
    path: str,
    task: str,
    schema: T.StructType | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """``<path>/<task>_{train,val,test}.csv`` as one frame with a ``split`` column.

    Each name may be one file or a folder of part files. Columns are taken by the
    names in the header, in any order, and cast to the stated types.
    """
    schema = schema or SCHEMAS[task]
    frames = {s: _read_csv(spark, f"{path}/{task}_{s}.csv", schema, multi_line) for s in SPLITS}
    return _fill_keywords(union_splits(frames))


def write_split_csv(df: DataFrame, path: str, task: str, max_rows_per_file: int = 100_000) -> None:
    """One CSV folder per split, in the layout ``read_split_csv`` takes (for exchange).

    All splits are written in one pass over the rows, to files bounded in rows, since a file with
    newlines in its fields is read by one task; the folders then get their names. A split without
    rows gets an empty folder with a header, rows of other splits are refused.
    """
    spark = df.sparkSession
    staged = f"{path}/_{task}"
    known = F.when(F.col("split").isin(*SPLITS), F.col("split")).otherwise(
        F.raise_error(F.concat(F.lit("not a split: "), F.coalesce("split", F.lit("null"))))
    )
    writer = df.withColumn("split", known).write.mode("overwrite").partitionBy("split")
    writer.options(**_CSV_OUT, maxRecordsPerFile=str(max_rows_per_file)).csv(staged)
    files = spark._jvm.org.apache.hadoop.fs.Path(staged).getFileSystem(spark._jsc.hadoopConfiguration())
    at = spark._jvm.org.apache.hadoop.fs.Path
    for split in SPLITS:
        target = at(f"{path}/{task}_{split}.csv")
        files.delete(target, True)
        if not files.rename(at(f"{staged}/split={split}"), target):
            empty = df.limit(0).drop("split")
            empty.write.mode("overwrite").options(**_CSV_OUT).csv(f"{path}/{task}_{split}.csv")
    files.delete(at(staged), True)


def write_dataset(
    df: DataFrame, path: str, fmt: str = "parquet", max_rows_per_file: int = 5_000_000, text: str | None = None
) -> dict[str, int]:
    """Store a frame by ``split`` folders, as Parquet or, for exchange, CSV, and tell what was written.

    The write adds no shuffle; files are bounded in rows, so readers stay parallel. Rows per split
    (``other`` for names that are none) and rows without ``text`` are counted by the writing job
    itself, nothing is read again.
    """
    written = Observation()
    split = F.col("split")
    counted = [F.count_if(split == s).alias(s) for s in SPLITS]
    missing = F.col(text).isNull() if text else F.lit(False)
    df = df.observe(
        written,
        *counted,
        F.count_if(split.isNull() | ~split.isin(*SPLITS)).alias("other"),
        F.count_if(missing).alias("missing"),
    )
    writer = df.write.mode("overwrite").partitionBy("split").option("maxRecordsPerFile", max_rows_per_file)
    if fmt == "csv":
        writer.options(**_CSV_OUT).csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"format must be parquet or csv, not {fmt}")
    return dict(written.get)


def read_dataset(spark: SparkSession, path: str, fmt: str, schema: T.StructType) -> DataFrame:
    """What ``write_dataset`` stored; a filter on ``split`` reads only its folders."""
    with_split = T.StructType([*schema.fields, T.StructField("split", T.StringType())])
    if fmt == "csv":
        return _fill_keywords(_read_csv(spark, path, with_split, multi_line=True))
    return spark.read.schema(with_split).parquet(path)


def write_samples(sample: DataFrame, path: str) -> None:
    """Export a sample report (a few dozen rows) as one CSV file."""
    sample.coalesce(1).write.mode("overwrite").options(**_CSV_OUT).csv(path)


MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("project", T.StringType()),
        T.StructField("date_downloaded", T.StringType()),
        T.StructField("random_seed", T.IntegerType()),
        T.StructField("dataset", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("license", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("task", T.StringType()),
        T.StructField("format", T.StringType()),
        T.StructField("classes", T.ArrayType(T.StringType())),
        T.StructField("mapping", T.StringType()),
        T.StructField("rows", T.MapType(T.StringType(), T.LongType())),
    ]
)


def manifest(df: DataFrame, meta: dict[str, object]) -> DataFrame:
    """One record for a dataset: what is known about it, and its rows per split."""
    unknown = set(meta) - set(MANIFEST_SCHEMA.names)
    if unknown:
        raise ValueError(f"not part of a manifest: {sorted(unknown)}")
    counts = df.groupBy("split").agg(F.count(F.lit(1)).alias("n"))
    rows = F.map_from_entries(F.array_sort(F.collect_list(F.struct("split", "n"))))
    stated = [
        F.lit(meta.get(f.name)).cast(f.dataType).alias(f.name) for f in MANIFEST_SCHEMA.fields if f.name != "rows"
    ]
    return counts.agg(rows.alias("rows")).select(*stated, "rows")


def write_manifest(df: DataFrame, meta: dict[str, object], path: str) -> None:
    """Store the manifest record as JSON beside the dataset."""
    manifest(df, meta).write.mode("overwrite").json(path)


CORPUS_SCHEMA = T.StructType(
    [
        T.StructField("project", T.StringType()),
        T.StructField("date_downloaded", T.StringType()),
        T.StructField("random_seed", T.IntegerType()),
        T.StructField(
            "datasets",
            T.MapType(
                T.StringType(),
                T.StructType(
                    [f for f in MANIFEST_SCHEMA.fields if f.name not in ("project", "date_downloaded", "random_seed", "dataset")]
                    + [T.StructField("missing", T.LongType())]
                ),
            ),
        ),
    ]
)


def write_corpus_manifest(
    spark: SparkSession, datasets: dict[str, tuple[dict[str, object], dict[str, int]]], meta: dict[str, object], path: str
) -> None:
    """One record for all datasets of a corpus, by name: what is known of each, and the counts its write gave."""
    fields = [f.name for f in CORPUS_SCHEMA["datasets"].dataType.valueType.fields]
    held = {}
    for name, (known, counts) in datasets.items():
        unknown = set(known) - set(fields) | set(meta) - set(CORPUS_SCHEMA.names)
        if unknown:
            raise ValueError(f"not part of a manifest: {sorted(unknown)}")
        rows = {split: n for split, n in counts.items() if split in SPLITS or split == "other" and n}
        held[name] = tuple({**known, "rows": rows, "missing": counts["missing"]}.get(f) for f in fields)
    record = [meta.get(f) for f in CORPUS_SCHEMA.names[:-1]] + [held]
    spark.createDataFrame([tuple(record)], CORPUS_SCHEMA).write.mode("overwrite").json(path)


def read_corpus_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The stored record of a corpus."""
    return spark.read.schema(CORPUS_SCHEMA).option("mode", "FAILFAST").json(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The stored manifest records."""
    return spark.read.schema(MANIFEST_SCHEMA).option("mode", "FAILFAST").json(path)
