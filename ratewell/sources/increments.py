"""Key totals that grow with new reviews: each load adds its own partial totals.

A store is a folder with one table per load. A load reads its own rows only, never the history, and
replaces itself when it is run again. Sums and counts add up, so a correction is a load as well: the
old row with sign -1 and the new one with sign 1. Reading adds the loads up by key; ``compact`` bounds
what it has to add.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewell.operators.stats import ALL_ROWS, by_all_keys
from ratewell.session import shuffles_released

ADDITIVE = ["rating_sum", "rating_count", "row_count"]
COMPACTED = "compacted"


def create_store(spark: SparkSession, folder: str) -> None:
    """An empty store, which as yet holds no load that was compacted."""
    _write_covered(spark.createDataFrame([], "loaded string"), folder)


def _write_covered(loads: DataFrame, folder: str) -> None:
    with shuffles_released(loads.sparkSession):
        loads.write.mode("overwrite").parquet(f"{folder}/covered")


def _covered(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("loaded string").parquet(f"{folder}/covered")


def _loads(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/loads")


def add_load(
    rows: DataFrame,
    folder: str,
    load: str,
    keys: tuple[str, ...],
    target: str = "rating",
    sign: str | None = None,
) -> None:
    """Write the totals of ``rows`` as the load of that name, in place of an earlier one.

    ``sign`` names a column of 1 for rows that come and -1 for rows that go; without it all come. Null
    keys have totals of their own, a row with a null target is a row without a rating, and a load
    without rows changes nothing. Integer targets stay exact. A name that ``compact`` has merged is
    refused, as its rows would count twice.
    """
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", load) or load == COMPACTED:
        raise ValueError(f"not a name for a load: {load}")
    if not _covered(rows.sparkSession, folder).where(F.col("loaded") == load).isEmpty():
        raise ValueError(f"{load} was compacted already")
    weight = (F.lit(1) if sign is None else F.col(sign)).cast("bigint")
    aggregates = [
        F.sum(F.col(target) * weight).alias("rating_sum"),
        F.coalesce(F.sum(F.when(F.col(target).isNotNull(), weight)), F.lit(0)).alias("rating_count"),
        F.sum(weight).alias("row_count"),
    ]
    totals = by_all_keys(rows, keys, aggregates, ADDITIVE).withColumn("loaded", F.lit(load))
    _write_load(totals, folder, load)


def _write_load(totals: DataFrame, folder: str, load: str) -> None:
    with shuffles_released(totals.sparkSession):
        totals.write.mode("overwrite").partitionBy("key_name").parquet(f"{folder}/loads/load={load}")


def _added(loads: DataFrame) -> DataFrame:
    return loads.groupBy("key_name", "key").agg(*[F.sum(c).alias(c) for c in ADDITIVE])


def current_totals(spark: SparkSession, folder: str) -> DataFrame:
    """``(key_name, key, rating_sum, rating_count, rating_mean, row_count)`` over all loads, as
    ``all_key_totals`` of the rows that are left would give them. Keys without rows are gone."""
    added = _added(_loads(spark, folder)).where(F.col("row_count") > 0)
    rated = F.col("rating_count") > 0
    return added.select(
        "key_name",
        "key",
        F.when(rated, F.col("rating_sum")).alias("rating_sum"),
        "rating_count",
        F.when(rated, F.col("rating_sum") / F.col("rating_count")).alias("rating_mean"),
        "row_count",
    )


def write_current(spark: SparkSession, store: str, folder: str) -> None:
    """Write the totals over all loads in the layout of the feature job's, whose ``read_totals`` gives the
    table of each key and the prior."""
    with shuffles_released(spark):
        current_totals(spark, store).write.mode("overwrite").partitionBy("key_name").parquet(folder)


def load_names(spark: SparkSession, folder: str) -> DataFrame:
    """``(loaded)``: the loads that the totals consist of, those in a compacted table included."""
    own = _loads(spark, folder).where(F.col("key_name") == ALL_ROWS).select("loaded")
    return own.where(F.col("loaded") != COMPACTED).unionByName(_covered(spark, folder)).distinct()


def compact(spark: SparkSession, folder: str, into: str) -> None:
    """A new store ``into`` with the sums of all loads in one table, and the list of their names.

    The old store stays as it is, so a compaction that fails or is run again loses nothing; whoever adds
    loads goes over to the new store.
    """
    totals = _added(_loads(spark, folder))
    totals = totals.where(" OR ".join(f"{c} <> 0" for c in ADDITIVE))
    _write_load(totals.withColumn("loaded", F.lit(COMPACTED)), into, COMPACTED)
    _write_covered(load_names(spark, folder).coalesce(1), into)
