"""Feature scaling and assembly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STAT_COLUMNS = ("user_avg", "user_log_cnt", "prod_avg", "prod_log_cnt", "parent_avg", "parent_log_cnt")
RAW_COLUMNS = ("purchased", "votes")
NUMERIC_COLUMNS = RAW_COLUMNS + STAT_COLUMNS
STATS_FIRST_COLUMNS = STAT_COLUMNS + RAW_COLUMNS
# The averages are already on the rating scale; this variant scales the other columns only.
UNBOUNDED_COLUMNS = ("user_log_cnt", "prod_log_cnt", "parent_log_cnt", "purchased", "votes")
STD_EPSILON = 1e-8

FEATURE_SUBSETS = {
    "embedding": ((), True),
    "embedding_raw": (RAW_COLUMNS, True),
    "embedding_all": (NUMERIC_COLUMNS, True),
    "raw": (RAW_COLUMNS, False),
    "stats": (STAT_COLUMNS, False),
    "stats_raw": (NUMERIC_COLUMNS, False),
}


def moments(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """One row: mean and population standard deviation of each column."""
    parts = []
    for name in columns:
        parts += [F.avg(name).alias(f"{name}_mean"), F.stddev_pop(name).alias(f"{name}_std")]
    return rows.agg(*parts)


def standardize(
    rows: DataFrame,
    columns: tuple[str, ...],
    fitted: DataFrame,
    epsilon: float | None = STD_EPSILON,
) -> DataFrame:
    """Centre and scale by the one-row ``fitted`` moments, which must come from training rows.

    ``epsilon`` is added to the deviation; with None a constant column is divided by 1 instead.
    """
    fit = fitted.select(F.struct(*fitted.columns)).scalar()

    def scaled(name: str) -> Column:
        mean, std = F.col("_fit")[f"{name}_mean"], F.col("_fit")[f"{name}_std"]
        divisor = F.when(std == 0, 1.0).otherwise(std) if epsilon is None else std + F.lit(epsilon)
        return (F.col(name) - mean) / divisor

    return rows.withColumn("_fit", fit).withColumns({name: scaled(name) for name in columns}).drop("_fit")


def feature_array(columns: tuple[str, ...], embedding: str | None = None) -> Column:
    """One array: the embedding, then the numeric columns in the given order."""
    parts = [F.col(embedding).cast("array<double>")] if embedding else []
    if columns:
        parts.append(F.array(*[F.col(c).cast("double") for c in columns]))
    return F.concat(*parts)


def feature_subset(name: str, embedding: str = "embedding") -> Column:
    """The feature array of a named ablation."""
    columns, with_embedding = FEATURE_SUBSETS[name]
    return feature_array(columns, embedding if with_embedding else None)
