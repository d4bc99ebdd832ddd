"""Scores and summaries: each is one pass with partial aggregation and a fixed-size result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewell.functions.numeric import clip_rating


def rmse_of(prediction: str | Column, target: str | Column = "rating") -> Column:
    """Aggregate expression: root mean squared error of the clipped prediction."""
    target = F.col(target) if isinstance(target, str) else target
    return F.sqrt(F.avg(F.pow(clip_rating(prediction) - target, F.lit(2.0))))


def rmse(rows: DataFrame, prediction: str = "prediction", target: str = "rating") -> DataFrame:
    return rows.agg(rmse_of(prediction, target).alias("rmse"))


def rating_distribution(rows: DataFrame, target: str = "rating") -> DataFrame:
    """Rows and percent per rating, in rating order. The window runs over the few ratings."""
    counts = rows.groupBy(target).agg(F.count(F.lit(1)).alias("reviews"))
    total = F.sum("reviews").over(Window.partitionBy())
    return counts.withColumn("percent", F.col("reviews") * 100.0 / total).orderBy(target)


def _distinct(key: str) -> list[Column]:
    # As a DISTINCT select does, a null key counts as one value.
    return [F.count_distinct(key), F.coalesce(F.max(F.col(key).isNull().cast("int")), F.lit(0))]


def entity_summary(rows: DataFrame, approximate: bool = False) -> DataFrame:
    """Reviews, distinct users, products and parents, and reviews per user and product.

    The exact form dedupes on the map side; ``approximate`` keeps fixed-size sketches instead.
    """

    def entities(key: str) -> Column:
        exact, null = _distinct(key)
        return (F.approx_count_distinct(key, 0.01) if approximate else exact) + null

    reviews, users, products = F.col("reviews"), F.col("users"), F.col("products")
    return rows.agg(
        F.count(F.lit(1)).alias("reviews"),
        entities("user_id").alias("users"),
        entities("prod_id").alias("products"),
        entities("parent_prod_id").alias("parents"),
    ).select(
        "*",
        (reviews / users).alias("reviews_per_user"),
        (reviews / products).alias("reviews_per_product"),
    )


def row_counts(**frames: DataFrame) -> DataFrame:
    """Rows per named frame."""
    counts = [
        frame.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("row_count"))
        for name, frame in frames.items()
    ]
    result = counts[0]
    for count in counts[1:]:
        result = result.unionByName(count)
    return result


def prediction_stats(rows: DataFrame, prediction: str = "rating") -> DataFrame:
    return rows.agg(
        F.min(prediction).alias("min"),
        F.max(prediction).alias("max"),
        F.avg(prediction).alias("mean"),
        F.stddev_pop(prediction).alias("std"),
    )


def best_by_rmse(candidates: DataFrame, candidate: str, score: str = "rmse") -> DataFrame:
    """The candidate with the lowest score; the first in candidate order on a tie."""
    best = F.min(F.struct(F.col(score), F.col(candidate)))
    return candidates.agg(best.alias("_best")).select(f"_best.{candidate}", f"_best.{score}")
