import numpy as np
import pytest
from pyspark.sql import functions as F

from ratewell.operators import blend, features, ridge
from ratewell.plans import training
from ratewell.schemas import RIDGE_ALPHAS
from ratewell.sources import reviews as source

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 6))
    y = x @ rng.normal(size=6) + 3 + rng.normal(size=400)
    rows = [(i, x[i].tolist(), float(y[i]), "train" if i % 5 else "val") for i in range(400)]
    frame = spark.createDataFrame(rows, "id long, features array<double>, rating double, split string")
    return x, y, np.arange(400) % 5 != 0, frame.repartition(7)


def closed_form(x, y, alpha):
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ yc)
    return w, y.mean() - x.mean(0) @ w


@pytest.mark.parametrize("alpha", RIDGE_ALPHAS)
def test_ridge_equals_closed_form(data, alpha):
    x, y, _, frame = data
    w, b = closed_form(x, y, alpha)
    model = ridge.ridge_fit(frame, alpha)
    assert model.coefficients == pytest.approx(w, abs=1e-10)
    assert model.intercept == pytest.approx(b, abs=1e-10)


def test_ridge_keeps_small_spread_around_large_means(spark):
    """Raw sums of products would lose the spread of the features altogether."""
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (300, 3)) + np.array([1e9, -3e9, 0.0])
    y = 3 + 0.01 * (x - [1e9, -3e9, 0.0]) @ np.array([50.0, -30.0, 20.0])
    rows = [(i, [float(v) for v in x[i]], float(y[i])) for i in range(300)]
    frame = spark.createDataFrame(rows, "id long, features array<double>, rating double").repartition(3)
    w, _ = closed_form(x, y, 1.0)
    model = ridge.ridge_fit(frame, 1.0)
    assert model.coefficients == pytest.approx(w, abs=1e-6)
    assert x @ model.coefficients + model.intercept == pytest.approx(x @ w + y.mean() - x.mean(0) @ w, abs=1e-4)


def test_mllib_penalty_is_converted(data):
    x, y, _, frame = data
    w, b = closed_form(x, y, 5.0)
    model = ridge.ridge_fit_mllib(frame, 5.0)
    assert np.array(model.coefficients) == pytest.approx(w, abs=1e-9)
    assert model.intercept == pytest.approx(b, abs=1e-9)


def test_rows_without_target_are_left_out(data):
    x, y, _, frame = data
    unrated = frame.limit(3).withColumn("rating", F.lit(None).cast("double"))
    model = ridge.ridge_fit(frame.unionByName(unrated), 1.0)
    assert model.coefficients == pytest.approx(closed_form(x, y, 1.0)[0], abs=1e-10)


def test_grid_scores_val_and_refits_on_all(data):
    x, y, train, frame = data
    grid = ridge.ridge_alpha_grid(frame)
    want = {}
    for alpha in RIDGE_ALPHAS:
        w, b = closed_form(x[train], y[train], alpha)
        want[alpha] = np.sqrt(np.mean((np.clip(x[~train] @ w + b, 1, 5) - y[~train]) ** 2))
    got = {r["alpha"]: r["rmse"] for r in grid.scores.collect()}
    assert got == pytest.approx(want, abs=1e-10)
    best = min(want, key=want.get)
    assert grid.best.alpha == best
    assert grid.best.coefficients == pytest.approx(closed_form(x, y, best)[0], abs=1e-10)


def test_predictions_are_clipped_and_keep_rows(data):
    x, y, _, frame = data
    model = ridge.ridge_fit(frame, 1.0)
    got = {r["id"]: r["prediction"] for r in ridge.predict(frame, model).collect()}
    want = np.clip(x @ model.coefficients + model.intercept, 1, 5)
    assert [got[i] for i in range(400)] == pytest.approx(want.tolist())


def test_null_features_are_refused(spark):
    rows = spark.createDataFrame([(1, [1.0, None], 2.0)], "id long, features array<double>, rating double")
    with pytest.raises(Exception, match="must not be null"):
        ridge.ridge_fit(rows)


def test_embedding_ridge_equals_closed_form(spark):
    rows = source.embedded(spark, SMALL).withColumn("features", features.feature_array((), "embedding"))
    local = rows.select("features", "rating").toPandas()
    w, b = closed_form(np.array(local["features"].tolist()), local["rating"].to_numpy(), 1.0)
    model = ridge.ridge_fit(rows, 1.0)
    assert model.coefficients == pytest.approx(w, abs=1e-8)


def test_ablation_equals_separate_grids(table):
    subsets = ("raw", "stats", "stats_raw")
    got = {(r["features"], r["alpha"]): r["rmse"] for r in training.ablation_table(table, subsets).collect()}
    for name in subsets:
        rows = table.withColumn("features", features.feature_subset(name))
        for row in ridge.ridge_alpha_grid(rows).scores.collect():
            assert got[name, row["alpha"]] == pytest.approx(row["rmse"], abs=1e-9)


@pytest.fixture(scope="module")
def table(spark):
    return training.feature_table(source.reviews(spark, SMALL))


def test_train_features_are_scaled_and_val_uses_train_moments(table):
    train = table.filter("split = 'train'").toPandas()
    for column in features.NUMERIC_COLUMNS:
        assert train[column].mean() == pytest.approx(0, abs=1e-6)
        assert train[column].std(ddof=0) == pytest.approx(1, abs=1e-5) or train[column].nunique() == 1
    assert table.filter("split = 'val'").count() + len(train) == 6_000


def test_boosted_trees_and_ablation_score_no_better_than_noise_allows(table):
    """The ratings are independent of all features, so a score far below the deviation is a leak."""
    deviation = table.filter("split = 'val'").agg(F.stddev_pop("rating")).first()[0]
    scores = [r["rmse"] for r in training.gbt_scores(table, trees=5).collect()]
    ablation = training.ablation_table(table, ("raw", "stats", "stats_raw"))
    scores += [r["rmse"] for r in ablation.collect()]
    assert len(scores) == 1 + 3 * len(RIDGE_ALPHAS)
    assert all(0.9 * deviation < score < 1.2 * deviation for score in scores)


def test_missing_embeddings_are_zero_and_lose_no_row(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id long, key string")
    vectors = spark.createDataFrame([("a", [1.0, 2.0])], "key string, embedding array<float>")
    got = {r["id"]: r["embedding"] for r in training.with_embeddings(rows, vectors, 2, "key").collect()}
    assert got == {1: [1.0, 2.0], 2: [0.0, 0.0], 3: [0.0, 0.0]}


def test_lost_ids_are_reported(spark):
    a = spark.createDataFrame([(1, 2.0), (2, 3.0)], "id long, rating double")
    assert blend.join_predictions(a, a, strict=True).count() == 2
    for other in (a.filter("id = 1"), a.filter("id < 0"), a.unionByName(a.filter("id = 1"))):
        with pytest.raises(ValueError, match="ids differ"):
            blend.join_predictions(a, other, strict=True)


def test_submission_scores_every_test_row(spark, tmp_path):
    rows = source.reviews(spark, SMALL)
    train, test = rows.filter(F.crc32("id") % 4 > 0), rows.filter(F.crc32("id") % 4 == 0).drop("rating")
    vectors = spark.createDataFrame([("1", [0.5]), ("2", [-0.5])], "parent_prod_id string, embedding array<double>")
    made = training.run_submission(train, test, vectors, 1, str(tmp_path), "parent_prod_id")
    scores = made["predictions"].agg(F.count("rating"), F.min("rating"), F.max("rating")).first()
    assert scores[0] == test.count() and 1.0 <= scores[1] <= scores[2] <= 5.0
    metrics = made["metrics"].first()
    assert 0.5 < metrics["train_rmse"] < 2 and 0.5 < metrics["best_val_rmse"] < 2
