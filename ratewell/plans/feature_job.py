"""The feature job: lookup tables and the prior from training rows, then encoded rows.

Every table is written once and read back, so the stages after it neither recompute its shuffle
nor depend on executors that held its blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from ratewell.operators.encode import apply_all_stats, distinct_lookup, loo_all_keys
from ratewell.operators.stats import lookup_of, read_totals, written_totals
from ratewell.schemas import KEY_PREFIXES
from ratewell.sources.tables import write_table


STATS_TABLE = "stats.parquet"
TEXT_COLUMNS = ("title", "comment")


def build_lookup_tables(train: DataFrame, folder: str) -> tuple[dict[str, DataFrame], Column]:
    """Write the totals (sum, count, mean, rows) of every key and of all rows, one folder per key,
    by a single pass over the training rows; return them and the prior."""
    return written_totals(train, f"{folder}/{STATS_TABLE}", tuple(KEY_PREFIXES))


def load_lookup_tables(spark: SparkSession, folder: str) -> tuple[dict[str, DataFrame], Column]:
    return read_totals(spark, f"{folder}/{STATS_TABLE}", tuple(KEY_PREFIXES))


def lookups(totals: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """``(key, avg, cnt)`` per key, for rows outside the training set."""
    return {key: lookup_of(totals[key], key, prefix) for key, prefix in KEY_PREFIXES.items()}


def run_feature_job(train: DataFrame, test: DataFrame, folder: str) -> dict[str, DataFrame]:
    """Lookup tables, encoded train and test rows and the test lookups, all written to ``folder``.

    Only ids, keys and numbers take part: no text crosses a shuffle. Whoever needs the texts joins
    them to the written features by id.
    """
    train, test = (rows.select(*[c for c in rows.columns if c not in TEXT_COLUMNS]) for rows in (train, test))
    totals, prior = build_lookup_tables(train, folder)
    encoded = {
        "train": loo_all_keys(train, prior=prior, totals=totals),
        "test": apply_all_stats(test, lookups(totals), prior),
    }
    result = {name: write_table(rows, folder, f"{name}_features.parquet") for name, rows in encoded.items()}
    for key, prefix in KEY_PREFIXES.items():
        used = distinct_lookup(result["test"], key, prefix)
        result[f"test_{prefix}_stats"] = write_table(used, folder, f"test_{prefix}_stats.parquet")
    return result
