"""Session helpers: local test sessions and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the local benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("lexflume")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def hand_small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Let this session hand Python workers at most so many rows at a time; a smaller setting stays.

    Whole texts travel in batches, which an executor holds for each of its tasks twice: in the JVM
    and in the Python worker. Results do not depend on where batches are cut.
    """
    held = int(spark.conf.get(BATCH_CONF))
    if held <= 0 or held > rows:
        spark.conf.set(BATCH_CONF, str(rows))


@lru_cache(maxsize=None)
def _local_dir(application: str) -> str:
    return tempfile.mkdtemp(prefix="lexflume-")


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by the session.

    Only a local session that names none (tests) gets a temporary folder.
    """
    named = spark.conf.get(CHECKPOINT_CONF, None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors can reach")
    return _local_dir(spark.conf.get("spark.app.id", ""))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    For results that later jobs use many times (vocabularies, IDF tables): the
    lineage ends at the files, and the planner sees their real size.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
