"""Ridge regression with an unpenalised intercept.

The normal equations need one pass over the rows, after one for the means that they are centred on:
each task adds up its own Gram matrix with BLAS, Spark adds the matrices row by row, and the driver
solves a system whose size depends on the number of features alone. The matrices serve every
penalty and, kept per split, every subset of splits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewell.functions.numeric import clip_rating
from ratewell.operators.evaluate import best_by_rmse, rmse_of
from ratewell.schemas import RIDGE_ALPHAS
from ratewell.session import pinned

MAX_FEATURES = 4096


def _matrix(values: pa.Array, rows: int) -> np.ndarray:
    """The rows of a list column as a dense matrix, without a copy per row."""
    if values.null_count or values.flatten().null_count:
        raise ValueError("features must not be null")
    flat = values.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64, copy=False).reshape(rows, -1)


def _check_width(width: int) -> None:
    if width > MAX_FEATURES:
        raise ValueError(f"at most {MAX_FEATURES} features")


def feature_means(rows: DataFrame, features: str = "features", target: str = "rating") -> np.ndarray:
    """Means of the features and the target over rows with a target; nulls count as 0. The widest row
    is found first, so that a width whose means would not fit is refused without adding them up."""
    with_target = F.col(target).isNotNull() & F.col(features).isNotNull()
    found = rows.agg(F.max(F.size(features)), F.count_if(with_target)).first()
    _check_width(found[0] or 0)
    if not found[1]:
        return np.array([0.0])
    values = F.transform(F.col(features), lambda x: F.coalesce(x.cast("double"), F.lit(0.0)))
    vector = array_to_vector(F.concat(values, F.array(F.col(target).cast("double"))))
    return np.array(rows.filter(with_target).agg(vector_to_array(Summarizer.mean(vector))).first()[0])


def gram(
    rows: DataFrame,
    features: str = "features",
    target: str = "rating",
    split: str = "split",
    shift: np.ndarray | None = None,
) -> DataFrame:
    """``(split, i, values)``: row ``i`` of ``ZᵀZ`` with ``Z = [1, features, target]``, per split.

    With ``shift``, features and target are taken less these numbers. Rows without a target are left
    out. The width is known before the pass that adds up the matrices, so that one whose matrix
    would not fit is refused without running it.
    """
    if shift is None:
        _check_width(rows.agg(F.max(F.size(features))).first()[0] or 0)

    def partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = _matrix(batch.column(1), batch.num_rows)
            y = batch.column(2).to_numpy(zero_copy_only=False)
            z = np.column_stack([np.ones(len(y)), x, y])
            if shift is not None:
                z[:, 1:] -= shift
            labels = np.asarray(batch.column(0).to_pylist(), dtype=object)
            for label in dict.fromkeys(labels):
                part = z[labels == label]
                sums[label] = sums.get(label, 0.0) + part.T @ part
        for label, matrix in sums.items():
            width = len(matrix)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([label] * width, pa.string()),
                    pa.array(range(width), pa.int32()),
                    pa.array(list(matrix), pa.list_(pa.float64())),
                ],
                names=["split", "i", "values"],
            )

    narrow = rows.filter(F.col(target).isNotNull()).select(
        F.col(split).cast("string"), F.col(features).cast("array<double>"), F.col(target).cast("double")
    )
    parts = narrow.mapInArrow(partials, "split string, i int, values array<double>")
    total = Summarizer.sum(array_to_vector(F.col("values")))
    return parts.groupBy("split", "i").agg(vector_to_array(total).alias("values"))


def gram_matrices(gram_rows: DataFrame) -> dict[str, np.ndarray]:
    """The matrix of each split, fetched as ``d + 2`` rows each."""
    found: dict[str, dict[int, list[float]]] = {}
    for row in gram_rows.collect():
        found.setdefault(row["split"], {})[row["i"]] = row["values"]
    return {split: np.array([parts[i] for i in sorted(parts)]) for split, parts in found.items()}


def centred_grams(
    rows: DataFrame, features: str = "features", target: str = "rating", split: str = "split"
) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The matrix of each split with features and target less their means over all rows, and the means.

    Sums of products of raw columns are far larger than the spread that the fit needs from them, and
    lose it to rounding when means are large or rows are many; sums around the means keep it.
    """
    means = feature_means(rows, features, target)
    return gram_matrices(gram(rows, features, target, split, means)), means


@dataclass(frozen=True)
class RidgeModel:
    alpha: float
    coefficients: np.ndarray
    intercept: float
    name: str = "all"


def solve_ridge(
    matrix: np.ndarray,
    alpha: float,
    places: np.ndarray | None = None,
    name: str = "all",
    shift: np.ndarray | None = None,
) -> RidgeModel:
    """Closed form from one Gram matrix: centre, penalise, solve, recover the intercept.

    ``places`` restricts the fit to some features; the others get coefficient 0. ``shift`` is what the
    matrix's features and target were taken less.
    """
    width = len(matrix) - 2
    _check_width(width)
    places = np.arange(width) if places is None else places
    n, means, target = matrix[0, 0], matrix[0, 1:-1][places] / matrix[0, 0], matrix[0, -1] / matrix[0, 0]
    products = matrix[1:-1, 1:-1][np.ix_(places, places)]
    centred = products - n * np.outer(means, means)
    with_target = matrix[1:-1, -1][places] - n * means * target
    solved = np.linalg.solve(centred + alpha * np.eye(len(places)), with_target)
    coefficients = np.zeros(width)
    coefficients[places] = solved
    intercept = target - means @ solved
    if shift is not None:
        intercept += shift[-1] - shift[:-1] @ coefficients
    return RidgeModel(float(alpha), coefficients, float(intercept), name)


def ridge_fit(
    rows: DataFrame, alpha: float = 1.0, features: str = "features", target: str = "rating"
) -> RidgeModel:
    matrices, means = centred_grams(rows.withColumn("_all", F.lit("all")), features, target, "_all")
    return solve_ridge(matrices["all"], alpha, shift=means)


def ridge_fit_mllib(
    rows: DataFrame, alpha: float = 1.0, features: str = "features", target: str = "rating"
) -> LinearRegressionModel:
    """The same fit by MLlib, whose penalty is per row and relative to the target's deviation."""
    rated = rows.filter(F.col(target).isNotNull())
    size = rated.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(target).alias("std")).first()
    trainer = LinearRegression(
        featuresCol="_features",
        labelCol="_target",
        regParam=alpha * size["std"] / size["n"],
        elasticNetParam=0.0,
        standardization=False,
        solver="normal",
    )
    vectors = array_to_vector(F.col(features).cast("array<double>")).alias("_features")
    return trainer.fit(rated.select(vectors, F.col(target).cast("double").alias("_target")))


def linear_scores(models: list[RidgeModel], features: str | Column = "features") -> Column:
    """The unclipped predictions of all models as one array, by one matrix product per batch."""
    weights = np.column_stack([m.coefficients for m in models])
    intercepts = np.array([m.intercept for m in models])

    @F.arrow_udf("array<double>")
    def score(values: pa.Array) -> pa.Array:
        if len(values) == 0:
            return pa.array([], pa.list_(pa.float64()))
        scores = _matrix(values, len(values)) @ weights + intercepts
        offsets = np.arange(len(values) + 1, dtype=np.int32) * len(intercepts)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(scores.ravel()))

    features = F.col(features) if isinstance(features, str) else features
    return score(features.cast("array<double>"))


def predict(
    rows: DataFrame, model: RidgeModel, features: str = "features", prediction: str = "prediction"
) -> DataFrame:
    """Add the clipped prediction."""
    return rows.withColumn(prediction, clip_rating(linear_scores([model], features)[0]))


def score_models(
    rows: DataFrame, models: list[RidgeModel], features: str = "features", target: str = "rating"
) -> DataFrame:
    """``(name, alpha, rmse)`` of every model in one pass over the rows."""
    scored = rows.select(linear_scores(models, features).alias("_scores"), F.col(target))
    entries = [
        F.struct(
            F.lit(m.name).alias("name"),
            F.lit(m.alpha).alias("alpha"),
            rmse_of(F.col("_scores")[i], target).alias("rmse"),
        )
        for i, m in enumerate(models)
    ]
    return scored.agg(F.array(*entries).alias("grid")).select(F.inline("grid"))


@dataclass(frozen=True)
class GridResult:
    scores: DataFrame
    best: RidgeModel


def ridge_alpha_grid(
    rows: DataFrame,
    alphas: tuple[float, ...] = RIDGE_ALPHAS,
    features: str = "features",
    target: str = "rating",
    split: str = "split",
) -> GridResult:
    """Fit each penalty on ``train``, score it on ``val``, refit the best on both.

    Gram matrices add up, so the refit needs no further pass over the rows. The features are kept
    while the width, means, matrices and scores are read; the scores, a row per penalty, are fetched.
    """
    with pinned(rows.select(features, target, split)) as kept:
        matrices, means = centred_grams(kept, features, target, split)
        models = [solve_ridge(matrices["train"], alpha, shift=means) for alpha in alphas]
        scores = score_models(kept.filter(F.col(split) == "val"), models, features, target).drop("name")
        scores = rows.sparkSession.createDataFrame(scores.collect(), scores.schema)
    best = best_by_rmse(scores, "alpha").first()["alpha"]
    return GridResult(scores, solve_ridge(matrices["train"] + matrices["val"], best, shift=means))


def leave_one_out_scores(
    matrix: np.ndarray, alphas: tuple[float, ...], shift: np.ndarray, features: str = "features", target: str = "rating"
) -> Column:
    """For each penalty, what a model fitted to all other rows predicts for the row; one array.

    No model is fitted anew: leaving row ``i`` out divides its residual by ``1 - h`` with its leverage
    ``h``, its weight in its own prediction. One eigendecomposition of the centred products gives the
    leverages of all penalties. ``matrix`` is that of all rows, taken less ``shift``.
    """
    if min(alphas) <= 0:
        raise ValueError("penalties must be above 0")
    n = matrix[0, 0]
    means = matrix[0, 1:] / n
    centred = matrix[1:, 1:] - n * np.outer(means, means)
    values, axes = np.linalg.eigh(centred[:-1, :-1])
    inverse = 1.0 / (np.maximum(values, 0.0)[:, None] + np.array(alphas))
    weights = (axes.T @ centred[:-1, -1])[:, None] * inverse
    middle, height = shift[:-1] + means[:-1], shift[-1] + means[-1]
    count = len(alphas)

    @F.arrow_udf("array<double>")
    def score(rows: pa.Array, rated: pa.Array) -> pa.Array:
        if len(rows) == 0:
            return pa.array([], pa.list_(pa.float64()))
        turned = (_matrix(rows, len(rows)) - middle) @ axes
        y = rated.to_numpy(zero_copy_only=False)[:, None]
        others = 1.0 - 1.0 / n - (turned * turned) @ inverse
        alone = y - (y - height - turned @ weights) / np.where(others > 0, others, np.nan)
        offsets = np.arange(len(rows) + 1, dtype=np.int32) * count
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(alone.ravel(), from_pandas=True))

    return score(F.col(features).cast("array<double>"), F.col(target).cast("double"))


def ridge_leave_one_out(
    rows: DataFrame, alphas: tuple[float, ...] = RIDGE_ALPHAS, features: str = "features", target: str = "rating"
) -> GridResult:
    """Score each penalty on every row by the model without that row, and fit the best on all rows.

    It needs no rows held out, and two passes more than a fit: means and matrix, then the scores of all
    penalties at once. Predictions are clipped, as in ``score_models``. Rows without a target take no
    part. A single row has no others to predict it: its score is null, and the smallest penalty stands.
    """
    with pinned(rows.filter(F.col(target).isNotNull()).select(features, target, F.lit("all").alias("_all"))) as kept:
        matrices, means = centred_grams(kept, features, target, "_all")
        if not matrices:
            raise ValueError("no row has a target")
        alone = kept.select(leave_one_out_scores(matrices["all"], alphas, means, features, target).alias("_alone"), target)
        entries = [
            F.struct(F.lit(float(alpha)).alias("alpha"), rmse_of(F.col("_alone")[i], target).alias("rmse"))
            for i, alpha in enumerate(alphas)
        ]
        scores = alone.agg(F.array(*entries).alias("grid")).select(F.inline("grid"))
        scores = rows.sparkSession.createDataFrame(scores.collect(), scores.schema)
    best = best_by_rmse(scores, "alpha").first()["alpha"]
    return GridResult(scores, solve_ridge(matrices["all"], best, shift=means))
