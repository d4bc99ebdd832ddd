"""Masked mean pooling of vectors per group."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_MASK = 1e-9


def masked_mean_pool(rows: DataFrame, group: str, mask: str = "mask", vector: str = "embedding") -> DataFrame:
    """``sum(mask * vector) / max(sum(mask), 1e-9)`` per group; no active row gives a zero vector.

    The vector sum runs in the JVM with partial aggregation, so a hot group shuffles one vector
    per map task and rows are never exploded into their elements.
    """
    weight = F.coalesce(F.col(mask).cast("double"), F.lit(0.0))
    masked = F.transform(F.col(vector).cast("array<double>"), lambda x: x * F.col("_w"))
    sums = (
        rows.select(group, weight.alias("_w"), F.col(vector))
        .select(group, "_w", array_to_vector(masked).alias("_v"))
        .groupBy(group)
        .agg(vector_to_array(Summarizer.sum(F.col("_v"))).alias("_sum"), F.sum("_w").alias("_n"))
    )
    divisor = F.greatest(F.col("_n"), F.lit(MIN_MASK))
    return sums.select(group, F.transform("_sum", lambda x: x / divisor).alias("pooled"))
