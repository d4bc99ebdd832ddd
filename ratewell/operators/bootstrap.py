"""Intervals for differences between models by a Poisson bootstrap.

Each row takes part in each replicate with a weight that a hash of its id draws from the Poisson
distribution of mean 1, so replicates depend on ids only and are the same in any layout or retry. All
replicates of all models are summed in one pass, with partial sums in the tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewell.functions.numeric import clip_rating

#: One digest has numbers of four hexadecimal digits for so many replicates.
PER_DIGEST, DIGITS = 8, 4
#: Digests that a row carries at a time, and rows whose weights are drawn at a time.
DIGESTS, BLOCK = 32, 2048


def poisson_steps() -> list[int]:
    """The drawn numbers from which the weight is at least 1, 2, ...: the distribution's cumulative
    shares of all numbers of four hexadecimal digits."""
    steps, share = [], 0.0
    for k in range(8):
        share += math.exp(-1) / math.factorial(k)
        steps.append(math.floor(16**DIGITS * share))
    return steps


def _weighted_sums(weights: np.ndarray, errors: np.ndarray) -> np.ndarray:
    """The sums of errors per replicate. An error that is no finite number counts where it was drawn only."""
    finite = np.isfinite(errors).all(axis=1)
    sums = weights[finite].T @ errors[finite]
    for odd in np.flatnonzero(~finite):
        drawn = weights[odd] > 0
        sums[drawn] += weights[odd][drawn, None] * errors[odd]
    return sums


def replicate_sums(
    rows: DataFrame,
    models: dict[str, Column],
    replicates: int = 200,
    row_id: str = "id",
    target: str = "rating",
    seed: int = 42,
) -> DataFrame:
    """``(replicate, model, weight, squared)``: the weights of all rows and of their squared errors, per
    replicate and model. Replicate 0 has every row once; the drawn ones are numbered from 1.

    A task draws the weights of a block of rows from their digests and adds up all replicates of all
    models by one matrix product, so no row is copied and a task returns a row per replicate.

    Predictions are clipped. Rows without a target, or without a prediction of any model, take no part,
    so that all models are compared on the same rows. Rows with one id are drawn together. An empty
    table gives no rows.
    """
    names = list(models)
    error = F.array(*[F.pow(clip_rating(models[name]) - F.col(target), 2) for name in names])
    scored = rows.select(F.col(row_id).cast("string").alias("_id"), error.alias("_errors"))
    scored = scored.where(F.forall("_errors", lambda e: e.isNotNull()))
    groups = math.ceil(replicates / (PER_DIGEST * DIGESTS))
    grouped = scored.select("_id", "_errors", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("_group"))

    def digest(place: int) -> Column:
        number = (F.col("_group") * DIGESTS + place).cast("string")
        return F.unhex(F.md5(F.concat_ws(":", F.lit(str(seed)), number, F.coalesce("_id", F.lit("")))))

    many = min(math.ceil(replicates / PER_DIGEST), DIGESTS)
    hashed = grouped.select("_errors", "_group", F.concat(*[digest(place) for place in range(many)]).alias("_drawn"))
    width, per_group = len(names), PER_DIGEST * DIGESTS
    weight_of = np.searchsorted(poisson_steps(), np.arange(16**DIGITS), "right").astype(np.float64)

    def partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, squared = np.zeros(replicates + 1, np.int64), np.zeros((replicates + 1, width))
        for batch in batches:
            groups = batch.column(1).to_numpy()
            for first in range(0, batch.num_rows, BLOCK):
                part = batch.slice(first, BLOCK)
                errors = part.column(0).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, width)
                drawn = np.frombuffer(b"".join(part.column(2).to_pylist()), ">u2").reshape(part.num_rows, -1)
                for group in np.unique(groups[first : first + BLOCK]):
                    mine = groups[first : first + BLOCK] == group
                    start = group * per_group
                    weights = weight_of[drawn[mine][:, : replicates - start]]
                    places = slice(start + 1, start + 1 + weights.shape[1])
                    weight[places] += weights.sum(axis=0).astype(np.int64)
                    squared[places] += _weighted_sums(weights, errors[mine])
                    if group == 0:
                        weight[0] += mine.sum()
                        squared[0] += errors[mine].sum(axis=0)
        found = np.flatnonzero(weight)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found, pa.int32()), pa.array(weight[found]), pa.array(list(squared[found]), pa.list_(pa.float64()))],
            names=["replicate", "weight", "sums"],
        )

    parts = hashed.mapInArrow(partials, "replicate int, weight bigint, sums array<double>")
    sums = [F.sum(F.col("sums")[i]).alias(f"_{i}") for i in range(len(names))]
    summed = parts.groupBy("replicate").agg(F.sum("weight").alias("weight"), *sums)
    entries = [F.struct(F.lit(name).alias("model"), F.col(f"_{i}").alias("squared")) for i, name in enumerate(names)]
    return summed.select("replicate", "weight", F.inline(F.array(*entries))).select("replicate", "model", "weight", "squared")


def difference_intervals(sums: DataFrame, against: str, level: float = 0.95) -> DataFrame:
    """``(model, rmse, difference, low, high)``: each model's error, how far it is above that of
    ``against``, and the interval of that difference over the drawn replicates.

    ``sums`` has a row per replicate and model, so this reads a few hundred rows. ``against`` itself
    has differences of 0; a replicate that drew no row, as in tiny tables, is not there.
    """
    scored = sums.select("replicate", "model", F.sqrt(F.col("squared") / F.col("weight")).alias("rmse"))
    other = scored.where(F.col("model") == against).select("replicate", F.col("rmse").alias("_other"))
    compared = scored.join(other, "replicate").withColumn("difference", F.col("rmse") - F.col("_other"))
    whole = F.col("replicate") == 0
    tail = (1 - level) / 2
    drawn = F.when(~whole, F.col("difference"))
    return compared.groupBy("model").agg(
        F.max(F.when(whole, F.col("rmse"))).alias("rmse"),
        F.max(F.when(whole, F.col("difference"))).alias("difference"),
        F.percentile(drawn, tail).alias("low"),
        F.percentile(drawn, 1 - tail).alias("high"),
    )
