"""Training plan: split first, encode both sides, scale by training moments, fit, score."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewell.operators.bootstrap import difference_intervals, replicate_sums
from ratewell.operators.encode import apply_all_stats, loo_all_keys, numeric_features
from ratewell.operators.evaluate import rmse_of
from ratewell.operators.features import (
    FEATURE_SUBSETS,
    NUMERIC_COLUMNS,
    feature_array,
    feature_subset,
    moments,
    standardize,
)
from ratewell.operators.joins import lookup_join
from ratewell.operators.ridge import (
    centred_grams,
    linear_scores,
    predict,
    ridge_alpha_grid,
    score_models,
    solve_ridge,
)
from ratewell.operators.split import fraction_split
from ratewell.operators.trees import gbt_fit, gbt_predict
from ratewell.plans.feature_job import build_lookup_tables, lookups
from ratewell.schemas import RIDGE_ALPHAS, SPLIT_SEED
from ratewell.session import scratch_path
from ratewell.sources.files import metrics_frame, read_metrics, write_metrics, write_submission
from ratewell.sources.tables import drop_table, write_table


def encoded_splits(
    rows: DataFrame,
    folder: str,
    percent: int = 80,
    keep: tuple[str, ...] = ("id", "rating"),
    seed: int = SPLIT_SEED,
) -> tuple[DataFrame, DataFrame]:
    """Numeric features of the train and val rows. The prior, the key statistics and the
    leave-one-out means all come from training rows; ``folder`` gets the statistics, and in ``encoding`` what
    the train rows are read from."""
    split = fraction_split(rows, percent, seed)
    train = split.filter(F.col("split") == "train").drop("split")
    val = split.filter(F.col("split") == "val").drop("split")
    totals, prior = build_lookup_tables(train, folder)
    return (
        numeric_features(loo_all_keys(train, prior=prior, totals=totals, folder=f"{folder}/encoding"), keep, "loo_avg"),
        numeric_features(apply_all_stats(val, lookups(totals), prior), keep, "avg"),
    )


def fitted_features(
    rows: DataFrame, folder: str, percent: int, keep: tuple[str, ...], seed: int = SPLIT_SEED
) -> tuple[DataFrame, DataFrame]:
    """Scaled numeric features of all rows with their ``split``, and the moments of the train part
    that scaled them. Both are written once; the parts are encoded one after the other, and their unscaled
    features deleted when they are scaled."""
    train, val = encoded_splits(rows, folder, percent, keep, seed)
    parts = {"train": train, "val": val}
    written = [write_table(part.withColumn("split", F.lit(name)), folder, f"raw-{name}") for name, part in parts.items()]
    drop_table(rows.sparkSession, folder, "encoding")
    raw = written[0].unionByName(written[1])
    fitted = moments(raw.filter(F.col("split") == "train"), NUMERIC_COLUMNS)
    fitted = write_table(fitted, folder, "moments.parquet")
    scaled = write_table(standardize(raw, NUMERIC_COLUMNS, fitted), folder, "scaled.parquet")
    for name in parts:
        drop_table(rows.sparkSession, folder, f"raw-{name}")
    return scaled, fitted


def feature_table(rows: DataFrame, percent: int = 80, keep: tuple[str, ...] = ("id", "rating")) -> DataFrame:
    """Scaled numeric features of all rows with their ``split``: fitting, scoring and every
    ablation read this table instead of repeating the key joins."""
    return fitted_features(rows, scratch_path(rows.sparkSession, "features"), percent, keep)[0]


def with_embeddings(features: DataFrame, embeddings: DataFrame, width: int, key: str = "id") -> DataFrame:
    """Add the ``embedding`` that ``embeddings (key, embedding)``, unique on ``key``, has for each row.
    No row is lost: where there is none, or the key is null, the embedding is a zero vector."""
    joined = lookup_join(features, embeddings, key)
    zeros = F.array_repeat(F.lit(0.0), width)
    return joined.withColumn("embedding", F.coalesce(F.col("embedding").cast("array<double>"), zeros))


def run_submission(
    train: DataFrame,
    test: DataFrame,
    embeddings: DataFrame,
    width: int,
    folder: str,
    key: str = "id",
    percent: int = 80,
    alphas: tuple[float, ...] = RIDGE_ALPHAS,
) -> dict[str, DataFrame]:
    """From reviews to a submission: ``(id, rating)`` of the test rows and the metrics, both written.

    Val rows are encoded by the statistics of the train part, test rows by those of all training rows.
    The features are the embedding of ``key`` (``width`` numbers) and the scaled numeric columns. The
    penalty with the best val error is refitted on train and val together; test predictions are clipped.
    """
    keep = tuple(dict.fromkeys(("id", key)))
    scaled, fitted = fitted_features(train, f"{folder}/fit", percent, (*keep, "rating"))
    totals, prior = build_lookup_tables(train, f"{folder}/all")
    encoded = numeric_features(apply_all_stats(test, lookups(totals), prior), keep, "avg")
    features = feature_array(NUMERIC_COLUMNS, "embedding").alias("features")

    def assembled(rows: DataFrame, *columns: str) -> DataFrame:
        return with_embeddings(rows, embeddings, width, key).select("id", *columns, features)

    known = assembled(scaled, "rating", "split")
    grid = ridge_alpha_grid(known, alphas)
    scored = predict(assembled(standardize(encoded, NUMERIC_COLUMNS, fitted)), grid.best)
    predictions = write_table(scored.select("id", F.col("prediction").alias("rating")), folder, "predictions.parquet")
    write_submission(predictions, f"{folder}/submission.csv")
    own = predict(known, grid.best).agg(rmse_of("prediction").alias("rmse")).scalar()
    best = grid.scores.agg(F.min("rmse").alias("rmse")).scalar()
    write_metrics(metrics_frame(predictions, best, train_rmse=own), f"{folder}/metrics.json")
    return {"predictions": predictions, "metrics": read_metrics(train.sparkSession, f"{folder}/metrics.json")}


def ablation_table(
    features: DataFrame,
    subsets: tuple[str, ...] = tuple(FEATURE_SUBSETS),
    alphas: tuple[float, ...] = RIDGE_ALPHAS,
    tree_subsets: tuple[str, ...] = (),
    trees: int = 20,
    depth: int = 5,
) -> DataFrame:
    """``(model, features, alpha, rmse)``: validation error of ridge per feature subset and penalty,
    and of boosted trees, which have no penalty, per subset in ``tree_subsets``.

    ``features`` holds the scaled columns, ``embedding`` if a subset reads it, rating and split.
    The Gram matrix of a subset is part of that of all features, so one pass fits every model,
    and a second one scores them all.
    """
    embedding = "embedding" if any(FEATURE_SUBSETS[name][1] for name in subsets) else None
    rows = features.select("rating", "split", feature_array(NUMERIC_COLUMNS, embedding).alias("features"))
    matrices, means = centred_grams(rows.filter(F.col("split") == "train"))
    matrix = matrices["train"]
    width = len(matrix) - 2
    offset = width - len(NUMERIC_COLUMNS)
    models = []
    for name in subsets:
        places = subset_places(name, offset)
        models += [solve_ridge(matrix, alpha, places, name, means) for alpha in alphas]
    scores = score_models(rows.filter(F.col("split") == "val"), models)
    table = scores.select(F.lit("ridge").alias("model"), F.col("name").alias("features"), "alpha", "rmse")
    for name in tree_subsets:
        scored = gbt_scores(features, name, trees, depth)
        table = table.unionByName(scored.withColumn("alpha", F.lit(None).cast("double")))
    return table


def subset_places(name: str, width: int) -> np.ndarray:
    """Where a subset's features stand in an array of an embedding of ``width`` numbers and all columns."""
    columns, with_embedding = FEATURE_SUBSETS[name]
    places = list(range(width)) if with_embedding else []
    return np.array(places + [width + NUMERIC_COLUMNS.index(c) for c in columns])


def ablation_intervals(
    features: DataFrame,
    subsets: tuple[str, ...] = tuple(FEATURE_SUBSETS),
    against: str = "embedding_all",
    alpha: float = 1.0,
    replicates: int = 200,
) -> DataFrame:
    """``(model, rmse, difference, low, high)``: how far each feature subset's validation error is above
    that of ``against``, with a 95 % interval over Poisson replicates of the validation rows.

    One pass over the train rows fits the models of all subsets, one over the val rows sums all
    replicates of all of them.
    """
    embedding = "embedding" if any(FEATURE_SUBSETS[name][1] for name in subsets) else None
    array = feature_array(NUMERIC_COLUMNS, embedding).alias("features")
    rows = features.select("id", "rating", "split", array)
    matrices, means = centred_grams(rows.filter(F.col("split") == "train"))
    matrix = matrices["train"]
    offset = len(matrix) - 2 - len(NUMERIC_COLUMNS)
    models = [solve_ridge(matrix, alpha, subset_places(name, offset), name, means) for name in subsets]
    val = rows.filter(F.col("split") == "val").select("id", "rating", linear_scores(models, "features").alias("_scores"))
    predictions = {m.name: F.col("_scores")[i] for i, m in enumerate(models)}
    sums = replicate_sums(val, predictions, replicates)
    sums = write_table(sums, scratch_path(features.sparkSession, "replicates"), "sums")
    return difference_intervals(sums, against)


def gbt_scores(features: DataFrame, subset: str = "stats_raw", trees: int = 20, depth: int = 5) -> DataFrame:
    """``(model, features, rmse)``: validation error of boosted trees on one feature subset."""
    rows = features.withColumn("features", feature_subset(subset))
    model = gbt_fit(rows.filter(F.col("split") == "train"), trees=trees, depth=depth)
    scored = gbt_predict(rows.filter(F.col("split") == "val"), model)
    rmse = scored.agg(rmse_of("prediction").alias("rmse"))
    return rmse.select(F.lit("gbt").alias("model"), F.lit(subset).alias("features"), "rmse")
