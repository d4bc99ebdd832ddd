import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratewell.functions import numeric, text
from ratewell.operators import blend, evaluate, features, joins, pooling


def one(spark, column, value, kind):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x"))).first()[0]


def test_review_text_keeps_the_separator(spark):
    rows = spark.createDataFrame(
        [("a", "b"), (None, "b"), ("a", None), (None, None)], "title string, comment string"
    )
    got = [r[0] for r in rows.select(text.review_text()).collect()]
    assert got == ["a [SEP] b", " [SEP] b", "a [SEP] ", " [SEP] "]


@pytest.mark.parametrize("value,expected", [(0.2, 1.0), (7.0, 5.0), (3.3, 3.3), (None, None)])
def test_clip(spark, value, expected):
    assert one(spark, numeric.clip_rating, value, "double") == expected


def test_clip_keeps_nan(spark):
    assert math.isnan(one(spark, numeric.clip_rating, float("nan"), "double"))


@pytest.mark.parametrize("votes,log,filled", [(None, 0.0, 0.0), (-3, 0.0, -3.0), (4, math.log(5), 4.0)])
def test_votes(spark, votes, log, filled):
    assert one(spark, numeric.votes_log, votes, "int") == pytest.approx(log)
    assert one(spark, numeric.votes_filled, votes, "int") == filled


@pytest.mark.parametrize("purchased,flag", [(None, 0.0), (False, 0.0), (True, 1.0)])
def test_purchased_flag(spark, purchased, flag):
    assert one(spark, numeric.purchased_flag, purchased, "boolean") == flag


def test_standardize(spark):
    train = spark.createDataFrame([(float(i), 7.0) for i in range(10)], "a double, constant double")
    fitted = features.moments(train, ("a", "constant"))
    scaled = features.standardize(train, ("a", "constant"), fitted)
    a = np.array([r["a"] for r in scaled.collect()])
    assert a.mean() == pytest.approx(0, abs=1e-6) and a.std() == pytest.approx(1, abs=1e-6)
    other = spark.createDataFrame([(2.0, 8.0)], "a double, constant double")
    # A constant column divides by the epsilon alone, or by one.
    assert features.standardize(other, ("constant",), fitted).first()["constant"] == pytest.approx(1e8)
    assert features.standardize(other, ("constant",), fitted, None).first()["constant"] == 1.0


def test_feature_array_order(spark):
    row = spark.createDataFrame([([0.5, 0.25], 1.0, 2)], "embedding array<float>, a double, b int")
    array = row.select(features.feature_array(("b", "a"), "embedding").alias("f")).first()["f"]
    assert array == [0.5, 0.25, 2.0, 1.0]


def test_masked_mean_pool(spark):
    data = [("a", 1.0, [1.0, 2.0]), ("a", 0.0, [9.0, 9.0]), ("a", 1.0, [3.0, 6.0]), ("zero", 0.0, [5.0, 5.0])]
    data += [("none", None, [5.0, 5.0]), ("half", 0.5, [4.0, 0.0])]
    rows = spark.createDataFrame(data, "g string, mask double, embedding array<float>")
    pooled = {r["g"]: r["pooled"] for r in pooling.masked_mean_pool(rows, "g").collect()}
    assert pooled == {"a": [2.0, 4.0], "zero": [0.0, 0.0], "none": [0.0, 0.0], "half": [4.0, 0.0]}


@pytest.fixture(scope="module")
def pairs(spark):
    rng = np.random.default_rng(1)
    a, b = rng.uniform(0, 6, 200), rng.uniform(0, 6, 200)
    frame = lambda x: spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "id long, rating double")
    return a, b, blend.join_predictions(frame(a), frame(b).repartition(7))


def test_blend(pairs):
    a, b, frame = pairs
    for weight in (1.0, 0.7, 0.0):
        got = {r["id"]: r["rating"] for r in blend.blend_predictions(frame, weight).collect()}
        want = np.clip(weight * a + (1 - weight) * b, 1, 5)
        assert [got[i] for i in range(200)] == pytest.approx(want.tolist())


def test_sweep_and_correlation(pairs):
    a, b, frame = pairs
    for row in blend.blend_weight_sweep(frame).collect():
        want = np.clip(row["weight"] * a + (1 - row["weight"]) * b, 1, 5)
        assert (row["min"], row["max"]) == (pytest.approx(want.min()), pytest.approx(want.max()))
        assert row["mean"] == pytest.approx(want.mean())
    assert blend.prediction_corr(frame).first()[0] == pytest.approx(np.corrcoef(a, b)[0, 1])


def test_best_by_rmse_takes_the_first_of_a_tie(spark):
    rows = spark.createDataFrame([(5.0, 0.9), (0.5, 0.8), (0.1, 0.8)], "alpha double, rmse double")
    assert evaluate.best_by_rmse(rows, "alpha").first()["alpha"] == 0.1


def test_entity_summary_counts_null_as_one_user(spark):
    rows = spark.createDataFrame(
        [("u", "p", "g"), (None, "p", "g"), ("v", "q", "g"), (None, "q", "h")],
        "user_id string, prod_id string, parent_prod_id string",
    )
    for approximate in (False, True):
        row = evaluate.entity_summary(rows, approximate).first()
        assert (row["users"], row["products"], row["parents"]) == (3, 2, 2)


def test_alignment_reports_lost_ids(spark):
    row = joins.alignment(spark.range(0, 10), spark.range(8, 15)).first()
    assert tuple(row) == (10, 7, 2, 8, 5)
