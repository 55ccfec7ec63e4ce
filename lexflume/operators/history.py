"""Training history: losses per epoch, best epoch, checkpoints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

By = Sequence[str]


def epoch_losses(df: DataFrame, by: By = ()) -> DataFrame:
    """Mean training and validation loss per epoch; every batch weighs the same.

    Batches that also carry ``step`` and ``learning_rate`` give the rate the epoch ended with.
    """
    kept = [F.avg(F.when(F.col("phase") == p, F.col("loss"))).alias(f"{p}_loss") for p in ("train", "val")]
    if {"step", "learning_rate"} <= set(df.columns):
        kept.append(F.max_by("learning_rate", "step").alias("learning_rate"))
    return df.groupBy(*by, "epoch").agg(*kept)


def _finite(history: DataFrame) -> DataFrame:
    """Epochs that could be best: no null, NaN or infinite validation loss."""
    return history.where(F.col("val_loss") < float("inf"))


def best_epoch(history: DataFrame, by: By = ("run_id",)) -> DataFrame:
    """Epoch of the lowest validation loss per run, the first one on a tie.

    A run whose losses are all NaN has none.
    """
    return (
        _finite(history)
        .groupBy(*by)
        .agg(
            F.min_by("epoch", F.struct("val_loss", "epoch")).alias("best_epoch"),
            F.min("val_loss").alias("best_val_loss"),
        )
    )


def checkpoints(history: DataFrame, by: By = ("run_id",)) -> DataFrame:
    """All epochs that were the best so far when they ended (one row per epoch comes in)."""
    earlier = Window.partitionBy(*by).orderBy("epoch").rowsBetween(Window.unboundedPreceding, -1)
    before = F.min("val_loss").over(earlier)
    tracked = _finite(history).withColumn("_before", before)
    return tracked.where(F.col("_before").isNull() | (F.col("val_loss") < F.col("_before"))).select(
        *by, "epoch", "val_loss"
    )
