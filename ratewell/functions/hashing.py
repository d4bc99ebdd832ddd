"""Seeded row hashes. They depend on the row id alone, so a split made from them survives
repartitioning, retries and lost executors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratewell.schemas import SPLIT_SEED


def split_hash(row_id: str = "id", seed: int = SPLIT_SEED) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(row_id).cast("string")))


def hex_prefix(hex_text: Column, digits: int) -> Column:
    """The number written in the first hex digits."""
    return F.conv(F.substring(hex_text, 1, digits), 16, 10).cast("bigint")


def split_bucket(row_id: str = "id", seed: int = SPLIT_SEED, buckets: int = 100) -> Column:
    return hex_prefix(split_hash(row_id, seed), 8) % buckets
