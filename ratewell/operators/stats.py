"""Aggregates over the reviews: the global mean and statistics per key.

All group by key with partial aggregation, so a hot key shuffles one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewell.functions.numeric import conditional_prior, log_count
from ratewell.session import shuffles_released

ALL_ROWS = "all_rows"


def global_mean(rows: DataFrame, target: str = "rating") -> DataFrame:
    """One row: the mean target."""
    return rows.agg(F.avg(target).alias("global_avg"))


def prior_of(rows: DataFrame, target: str = "rating") -> Column:
    """The global mean as a scalar subquery: no join, and no round trip through the driver."""
    return global_mean(rows, target).scalar()


def _totals(target: str) -> list[Column]:
    return [
        F.sum(target).alias("rating_sum"),
        F.count(target).alias("rating_count"),
        F.avg(target).alias("rating_mean"),
        F.count(F.lit(1)).alias("row_count"),
    ]


def key_totals(rows: DataFrame, key: str, target: str = "rating") -> DataFrame:
    """Sum, count of non-null targets, mean, and number of rows per key.

    One such table serves training rows (``encode.loo_encode``) and others (``lookup_of``).
    """
    return rows.groupBy(key).agg(*_totals(target))


def by_all_keys(rows: DataFrame, keys: tuple[str, ...], aggregates: list[Column], names: list[str]) -> DataFrame:
    """``(key_name, key, *names)``: aggregates of several string keys by one scan and one shuffle.

    The row with the name ``ALL_ROWS`` holds those of all rows.
    """
    sets = [[F.col(key)] for key in keys] + [[]]
    grouped = rows.groupingSets(sets, *keys).agg(
        *aggregates, *[F.grouping(key).alias(f"_without_{key}") for key in keys]
    )
    name, value = F.lit(ALL_ROWS), F.lit(None).cast("string")
    for key in keys:
        in_set = F.col(f"_without_{key}") == 0
        name, value = F.when(in_set, key).otherwise(name), F.when(in_set, F.col(key)).otherwise(value)
    return grouped.select(name.alias("key_name"), value.alias("key"), *names)


def all_key_totals(rows: DataFrame, keys: tuple[str, ...], target: str = "rating") -> DataFrame:
    """``key_totals`` of several string keys and of all rows, the global mean among them."""
    return by_all_keys(rows, keys, _totals(target), ["rating_sum", "rating_count", "rating_mean", "row_count"])


def written_totals(
    rows: DataFrame, folder: str, keys: tuple[str, ...], target: str = "rating"
) -> tuple[dict[str, DataFrame], Column]:
    """``all_key_totals`` written to ``folder``, a part per key: the table of each key, and the global mean."""
    with shuffles_released(rows.sparkSession):
        all_key_totals(rows, keys, target).write.mode("overwrite").partitionBy("key_name").parquet(folder)
    return read_totals(rows.sparkSession, folder, keys)


def written_counts(rows: DataFrame, folder: str, keys: tuple[str, ...]) -> dict[str, DataFrame]:
    """``(key, key_rows)`` per key, null keys left out: one scan for all keys, written to ``folder``."""
    keyed = rows.withColumn("_one", F.lit(1))
    totals = all_key_totals(keyed, keys, "_one").where(F.col("key").isNotNull())
    counts = totals.select("key_name", "key", F.col("row_count").alias("key_rows"))
    with shuffles_released(rows.sparkSession):
        counts.write.mode("overwrite").parquet(folder)
    read = rows.sparkSession.read.schema(counts.schema).parquet(folder)
    return {
        key: read.where(F.col("key_name") == key).select(F.col("key").cast(rows.schema[key].dataType).alias(key), "key_rows")
        for key in keys
    }


def read_totals(spark: SparkSession, folder: str, keys: tuple[str, ...]) -> tuple[dict[str, DataFrame], Column]:
    def part(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/key_name={name}")

    tables = {key: part(key).withColumnRenamed("key", key) for key in keys}
    return tables, part(ALL_ROWS).select("rating_mean").scalar()


def group_stats(rows: DataFrame, key: str, target: str = "rating") -> DataFrame:
    """Sum, count of non-null targets and mean per key."""
    return key_totals(rows, key, target).drop("row_count")


def lookup_of(totals: DataFrame, key: str, prefix: str) -> DataFrame:
    """``key_totals`` as the mean and number of rows per key, as ``group_mean_count`` gives them."""
    mean = F.when(F.col("rating_count") > 0, F.col("rating_sum") / F.col("rating_count"))
    return totals.select(key, mean.alias(f"{prefix}_avg"), F.col("row_count").alias(f"{prefix}_cnt"))


def group_mean_count(rows: DataFrame, key: str, prefix: str, target: str = "rating") -> DataFrame:
    """Mean target and number of rows per key; rows with a null target count as rows."""
    return rows.groupBy(key).agg(
        F.avg(target).alias(f"{prefix}_avg"), F.count(F.lit(1)).alias(f"{prefix}_cnt")
    )


def group_mean_rated(rows: DataFrame, key: str, prefix: str, target: str = "rating") -> DataFrame:
    """Mean and count per key over rows with a non-null target."""
    return rows.groupBy(key).agg(
        F.avg(target).alias(f"{prefix}_avg"), F.count(target).alias(f"{prefix}_cnt")
    )


def group_mean_encode(
    rows: DataFrame, key: str, prior: Column | None = None, target: str = "rating"
) -> DataFrame:
    """Per key: the plain mean where the group has more than one row, else the prior; the count
    and its log. Joined back to training rows this leaks their target, so it serves only as a
    lookup for other rows; ``encode.loo_encode`` is the leak-free form for training rows."""
    if prior is None:
        prior = prior_of(rows, target)
    stats = group_stats(rows, key, target)
    return stats.select(
        key,
        conditional_prior(F.col("rating_mean"), "rating_count", prior).alias(f"{key}_avg"),
        F.col("rating_count").alias(f"{key}_count"),
        log_count("rating_count").alias(f"{key}_log_count"),
    )
