"""Ridge regression on sparse rows, for more features than a Gram matrix can hold.

The normal equations are solved by conjugate gradients with a diagonal preconditioner. A step needs the
product of the Gram matrix with one vector per penalty: each task multiplies its rows with all of them
at once, Spark adds the parts up by feature, and the driver holds a few vectors of the features' number.
The matrix itself is never made. All penalties share every pass, and one that has converged drops out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewell.operators.ridge import RidgeModel
from ratewell.schemas import RIDGE_ALPHAS
from ratewell.session import pinned

#: Vectors of so many numbers per penalty go to the tasks and come back: 2 MB each.
MAX_SPARSE_FEATURES = 1 << 18


def _entries(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, feature and value of each entry of a batch of ``(slots, values)`` lists."""
    slots, values = batch.column(0), batch.column(1)
    sizes = np.diff(slots.offsets.to_numpy())
    return np.repeat(np.arange(len(sizes)), sizes), slots.flatten().to_numpy(), values.flatten().to_numpy()


def gram_products(rows: DataFrame, vectors: np.ndarray) -> np.ndarray:
    """``XᵀX P`` for the columns of ``vectors``, by one pass over ``rows (slots, values)``."""
    width, count = vectors.shape
    shared = rows.sparkSession.sparkContext.broadcast(vectors)
    names = [f"g{j}" for j in range(count)]

    def partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        total = np.zeros((count, width))
        for batch in batches:
            row, slot, value = _entries(batch)
            if not len(row):
                continue
            for j in range(count):
                along = np.bincount(row, value * p[slot, j], batch.num_rows)
                total[j] += np.bincount(slot, value * along[row], width)
        used = np.flatnonzero(total.any(axis=0))
        for at in range(0, len(used), 1 << 14):
            part = used[at : at + (1 << 14)]
            columns = [pa.array(part.astype(np.int32)), *(pa.array(total[j, part]) for j in range(count))]
            yield pa.RecordBatch.from_arrays(columns, names=["slot", *names])

    schema = ", ".join(["slot int", *(f"{n} double" for n in names)])
    parts = rows.select("slots", "values").mapInArrow(partials, schema)
    # At most a row per feature, whose number is bounded.
    found = parts.groupBy("slot").agg(*[F.sum(n).alias(n) for n in names]).toArrow()
    shared.destroy()
    result = np.zeros_like(vectors)
    slot = found.column("slot").to_numpy()
    for j, name in enumerate(names):
        result[slot, j] = found.column(name).to_numpy()
    return result


def _moments(rows: DataFrame, width: int) -> tuple[int, float, np.ndarray, np.ndarray, np.ndarray]:
    """Rows, mean target, and per feature its mean, its centred squares and its product with the target."""
    n, middle = rows.agg(F.count(F.lit(1)), F.avg("target")).first()
    if not n:
        raise ValueError("no row has a target")
    entry = F.inline(F.arrays_zip("slots", "values")).alias("slot", "value")
    entries = rows.select((F.col("target") - F.lit(middle)).alias("y"), entry)
    sums = entries.groupBy("slot").agg(
        F.sum("value").alias("x"), F.sum(F.col("value") * F.col("value")).alias("xx"), F.sum(F.col("value") * F.col("y")).alias("xy")
    )
    found = sums.toArrow()
    slot = found.column("slot").to_numpy()
    vectors = []
    for name in ("x", "xx", "xy"):
        vector = np.zeros(width)
        vector[slot] = found.column(name).to_numpy()
        vectors.append(vector)
    means = vectors[0] / n
    return n, middle, means, np.maximum(vectors[1] - n * means**2, 0.0), vectors[2]


def fit_sparse(
    rows: DataFrame,
    width: int,
    alphas: tuple[float, ...] = RIDGE_ALPHAS,
    slots: str = "slots",
    values: str = "values",
    target: str = "rating",
    tolerance: float = 1e-10,
    max_steps: int = 1000,
) -> list[RidgeModel]:
    """The model of each penalty, with an intercept that is not penalised.

    A row lists the features it has, ``slots`` from 0 to ``width`` - 1, and their ``values``; a slot that
    is listed twice has the sum. Rows without a target or without lists take no part; null values count
    as 0. Features no row has get a weight of 0. Steps end when each penalty's residual is below
    ``tolerance`` times that of zero weights; running out of steps raises, as it would give a wrong model.
    """
    if width > MAX_SPARSE_FEATURES:
        raise ValueError(f"at most {MAX_SPARSE_FEATURES} features")
    if min(alphas) <= 0:
        raise ValueError("penalties must be above 0")
    filled = F.transform(F.col(values).cast("array<double>"), lambda x: F.coalesce(x, F.lit(0.0)))
    narrow = rows.select(
        F.col(slots).cast("array<int>").alias("slots"), filled.alias("values"), F.col(target).cast("double").alias("target")
    )
    narrow = narrow.where("target IS NOT NULL AND slots IS NOT NULL AND values IS NOT NULL")
    with pinned(narrow) as kept:
        wrong = kept.where((F.size("slots") != F.size("values")) | F.exists("slots", lambda s: s.isNull() | (s < 0) | (s >= width)))
        if not wrong.isEmpty():
            raise ValueError("slots must be numbers below the width, one for each value")
        n, middle, means, spread, right = _moments(kept, width)
        weights = _conjugate_gradients(kept, n, means, spread, right, np.array(alphas, float), tolerance, max_steps)
    return [
        RidgeModel(coefficients=weights[:, j], intercept=float(middle - means @ weights[:, j]), alpha=alpha)
        for j, alpha in enumerate(alphas)
    ]


def _conjugate_gradients(rows, n, means, spread, right, alphas, tolerance, max_steps) -> np.ndarray:
    weights = np.zeros((len(means), len(alphas)))
    residual = np.repeat(right[:, None], len(alphas), axis=1)
    scale = 1.0 / (spread[:, None] + alphas)
    scaled = residual * scale
    direction, size = scaled.copy(), (residual * scaled).sum(0)
    enough = tolerance * np.linalg.norm(right)
    for _ in range(max_steps):
        active = np.flatnonzero(np.linalg.norm(residual, axis=0) > enough)
        if not len(active):
            return weights
        p = direction[:, active]
        # The means' part is taken off afterwards, which leaves the rows sparse.
        product = gram_products(rows, p) - n * np.outer(means, means @ p) + alphas[active] * p
        step = size[active] / (p * product).sum(0)
        weights[:, active] += step * p
        residual[:, active] -= step * product
        scaled = residual[:, active] * scale[:, active]
        grown = (residual[:, active] * scaled).sum(0)
        direction[:, active] = scaled + (grown / size[active]) * p
        size[active] = grown
    raise ValueError(f"not solved in {max_steps} steps")


def score_sparse(rows: DataFrame, models: list[RidgeModel], slots: str = "slots", values: str = "values") -> DataFrame:
    """``rows`` with ``scores``, an array of one unclipped prediction per model; a row without lists has
    the intercepts."""
    shared = rows.sparkSession.sparkContext.broadcast(np.column_stack([m.coefficients for m in models]))
    intercepts = np.array([m.intercept for m in models])

    @F.arrow_udf("array<double>")
    def score(slots: pa.Array, values: pa.Array) -> pa.Array:
        row, slot, value = _entries(pa.RecordBatch.from_arrays([slots, values], names=["slots", "values"]))
        weights = shared.value
        found = np.column_stack(
            [np.bincount(row, value * weights[slot, j], len(slots)) + b for j, b in enumerate(intercepts)]
        )
        offsets = np.arange(len(slots) + 1, dtype=np.int32) * len(intercepts)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.ravel()))

    listed = F.coalesce(F.col(slots).cast("array<int>"), F.array().cast("array<int>"))
    numbers = F.coalesce(F.col(values).cast("array<double>"), F.array().cast("array<double>"))
    numbers = F.transform(numbers, lambda x: F.coalesce(x, F.lit(0.0)))
    return rows.withColumn("scores", score(listed, numbers))
