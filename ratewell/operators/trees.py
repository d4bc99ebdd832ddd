"""Gradient-boosted trees on the numeric features."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewell.functions.numeric import clip_rating


def _vectors(rows: DataFrame, features: str) -> DataFrame:
    return rows.withColumn("_features", array_to_vector(F.col(features).cast("array<double>")))


def gbt_fit(
    rows: DataFrame,
    features: str = "features",
    target: str = "rating",
    trees: int = 20,
    depth: int = 5,
    seed: int = 42,
) -> GBTRegressionModel:
    """Train on leak-free features only: encode training rows with ``loo_encode``."""
    trainer = GBTRegressor(
        featuresCol="_features", labelCol="_target", maxIter=trees, maxDepth=depth, seed=seed
    )
    rated = _vectors(rows.filter(F.col(target).isNotNull()), features)
    return trainer.fit(rated.select("_features", F.col(target).cast("double").alias("_target")))


def gbt_predict(
    rows: DataFrame, model: GBTRegressionModel, features: str = "features", prediction: str = "prediction"
) -> DataFrame:
    """Add the clipped prediction."""
    scored = model.setPredictionCol("_score").transform(_vectors(rows, features))
    return scored.withColumn(prediction, clip_rating("_score")).drop("_features", "_score")
