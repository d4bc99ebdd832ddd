"""Blending prediction sets, which are aligned on the row id."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewell.functions.numeric import blend, clip_rating
from ratewell.operators.joins import join_on_id, require_alignment
from ratewell.operators.ridge import gram, gram_matrices
from ratewell.schemas import BLEND_WEIGHTS


def join_predictions(
    a: DataFrame, b: DataFrame, row_id: str = "id", rating: str = "rating", strict: bool = False
) -> DataFrame:
    """``(id, rating_a, rating_b)`` of two prediction sets. ``strict`` first checks, by one pass over the
    ids of both, that they are the same."""
    if strict:
        require_alignment(a, b, row_id)
    return join_on_id(
        a.select(row_id, F.col(rating).alias("rating_a")),
        b.select(row_id, F.col(rating).alias("rating_b")),
        row_id,
    )


def prediction_corr(pairs: DataFrame) -> DataFrame:
    return pairs.agg(F.corr("rating_a", "rating_b").alias("correlation"))


def blend_predictions(pairs: DataFrame, weight: float, row_id: str = "id") -> DataFrame:
    return pairs.select(row_id, blend("rating_a", "rating_b", weight).alias("rating"))


def blend_weight_sweep(pairs: DataFrame, weights: tuple[float, ...] = BLEND_WEIGHTS) -> DataFrame:
    """Min, max and mean of the blend per weight, all in one pass without copying rows per weight."""

    def summary(weight: float):
        value = blend("rating_a", "rating_b", weight)
        return F.struct(
            F.lit(float(weight)).alias("weight"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
            F.avg(value).alias("mean"),
        )

    return pairs.agg(F.array(*[summary(w) for w in weights]).alias("sweep")).select(F.inline("sweep"))


def join_prediction_sets(
    sets: dict[str, DataFrame], row_id: str = "id", rating: str = "rating", strict: bool = False
) -> DataFrame:
    """``(id, <a column per set>)`` of any number of prediction sets, by one grouping and not a join per set.

    Rows that are not in every set are left out; ``strict`` refuses them. Ids are unique within a set.
    A null prediction stays null.
    """
    names = list(sets)
    marked = [
        frame.select(row_id, F.lit(i).alias("_set"), F.col(rating).cast("double").alias("_rating"))
        for i, frame in enumerate(sets.values())
    ]
    ratings = [F.max(F.when(F.col("_set") == i, F.col("_rating"))).alias(name) for i, name in enumerate(names)]
    there = [F.max(F.when(F.col("_set") == i, True)) for i in range(len(names))]
    complete = reduce(lambda a, b: a & b, [column.isNotNull() for column in there])
    grouped = reduce(DataFrame.unionByName, marked).where(F.col(row_id).isNotNull()).groupBy(row_id)
    joined = grouped.agg(*ratings, complete.alias("_complete"))
    if strict:
        refused = F.raise_error(F.lit("prediction sets hold different ids")).cast("boolean")
        return joined.where(F.when(F.col("_complete"), True).otherwise(refused)).drop("_complete")
    return joined.where("_complete").drop("_complete")


@dataclass(frozen=True)
class BlendWeights:
    weights: dict[str, float]
    rmse: float


def simplex_blend(rows: DataFrame, predictions: list[str], target: str = "rating") -> BlendWeights:
    """Weights of at least 0 that add up to 1 with the least squared error of the weighted prediction.

    As the weights add up to 1, the error is quadratic in them with the matrix of products of the sets'
    own errors, which one pass adds up; the driver sees a row per set. Rows without a target or without
    one of the predictions take no part; without any row the weights are even and the error is NaN.
    """
    errors = F.array(*[F.col(p).cast("double") - F.col(target) for p in predictions])
    products = rows.select(errors.alias("features"), F.lit(0.0).alias("rating"), F.lit("all").alias("split"))
    products = products.where(F.forall("features", lambda e: e.isNotNull()))
    matrices = gram_matrices(gram(products))
    if not matrices:
        return BlendWeights({p: 1 / len(predictions) for p in predictions}, float("nan"))
    matrix = matrices["all"][:-1, :-1]
    squares = matrix[1:, 1:] / matrix[0, 0]
    weights = simplex_minimum(squares)
    return BlendWeights(dict(zip(predictions, weights.tolist())), float(np.sqrt(max(weights @ squares @ weights, 0.0))))


def simplex_minimum(squares: np.ndarray) -> np.ndarray:
    """The least ``wᵀ S w`` over weights of at least 0 that add up to 1, for a positive semidefinite ``S``.

    Active sets: from the best single set on, the set whose slope is steepest joins; the free weights
    move to their own optimum, or as far as none falls below 0, where one leaves. Each round lowers the
    error, so no choice of sets comes twice. Sets with equal predictions leave the error as it is.
    """
    count = len(squares)
    scale = max(float(np.trace(squares)) / count, 1e-300)
    weights = np.zeros(count)
    weights[int(np.argmin(np.diag(squares)))] = 1.0
    free = weights > 0
    for _ in range(50 * count + 50):
        slope = squares @ weights
        gain = slope - weights @ slope
        gain[free] = 0.0
        joins = int(np.argmin(gain))
        if gain[joins] >= -1e-12 * scale:
            break
        free[joins] = True
        while True:
            places = np.flatnonzero(free)
            wanted = _on_the_plane(squares[np.ix_(places, places)], scale)
            if (wanted >= 0).all():
                weights[:] = 0.0
                weights[places] = wanted
                break
            held = weights[places]
            falling = wanted < 0
            shares = held[falling] / (held[falling] - wanted[falling])
            weights[places] = held + shares.min() * (wanted - held)
            gone = places[falling][int(np.argmin(shares))]
            weights[gone] = 0.0
            free[gone] = False
    return weights / weights.sum()


def _on_the_plane(squares: np.ndarray, scale: float) -> np.ndarray:
    """The least ``wᵀ S w`` over weights of any sign that add up to 1."""
    count = len(squares)
    system = np.ones((count + 1, count + 1))
    system[:count, :count] = squares / scale
    system[count, count] = 0.0
    return np.linalg.lstsq(system, np.append(np.zeros(count), 1.0), rcond=1e-13)[0][:count]


def blend_sets(rows: DataFrame, weights: dict[str, float], row_id: str = "id") -> DataFrame:
    """``(id, rating)``: the weighted prediction, clipped; null where a set with a weight has none."""
    terms = [F.col(name) * F.lit(float(weight)) for name, weight in weights.items() if weight]
    return rows.select(row_id, clip_rating(reduce(lambda a, b: a + b, terms)).alias("rating"))
