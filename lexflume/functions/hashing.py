"""Seeded, repeatable pseudo-random keys (same rows on any partitioning)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seeded_key(key: Column, seed: int) -> Column:
    """Hex key that orders rows at random, but always the same way."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def percent_bucket(key: Column, seed: int) -> Column:
    """Bucket 0..99 of a row."""
    return F.conv(F.substring(seeded_key(key, seed), 1, 8), 16, 10).cast("bigint") % 100
