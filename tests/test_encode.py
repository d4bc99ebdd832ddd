import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ratewell.operators import encode, stats
from ratewell.schemas import KEY_PREFIXES

# A key with a third of all rows, many null keys, singletons, and null ratings.
ROWS = (
    [(i, "hot", i % 5 + 1) for i in range(40)]
    + [(100 + i, None, i % 3 + 2) for i in range(30)]
    + [(200 + i, f"k{i // 3}", i % 5 + 1) for i in range(30)]
    + [(300 + i, f"single{i}", 4) for i in range(10)]
    + [(400, "k1", None), (401, None, None), (402, "only_null", None), (403, "hot", None)]
)
# Limits under which the hot key really is handled as hot.
HOT = {"share": 0.1, "min_rows": 1}


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, "id long, user_id string, rating int").repartition(5, "id")


def brute_force(rows=ROWS):
    """The encoding by definition: average the other rated rows of the same key."""
    prior = pd.Series([r for _, _, r in rows if r is not None]).mean()
    result = {}
    for row_id, key, rating in rows:
        rated = [] if key is None else [(i, r) for i, k, r in rows if k == key and r is not None]
        others = [r for i, r in rated if i != row_id]
        known = rating is not None and len(rated) > 1
        result[row_id] = (sum(others) / len(others) if known else prior, len(rated))
    return result


def check(encoded, expected):
    got = {r["id"]: r for r in encoded.collect()}
    assert got.keys() == expected.keys()
    for row_id, (avg, count) in expected.items():
        assert got[row_id]["u_loo_avg"] == pytest.approx(avg, abs=1e-12), row_id
        assert got[row_id]["u_cnt"] == count
        assert got[row_id]["u_log_cnt"] == pytest.approx(math.log1p(count), abs=1e-12)


@pytest.mark.parametrize("limits", [{}, HOT])
@pytest.mark.parametrize(
    "encoder,options",
    [(encode.loo_encode, {}), (encode.loo_encode_window, {}), (encode.loo_encode_window, {"full_frame": True})],
)
def test_loo_by_definition(rows, encoder, options, limits):
    check(encoder(rows, "user_id", prefix="u", **options, **limits), brute_force())


def test_loo_accepts_integer_keys(spark):
    data = [(i, None if i % 4 == 0 else i % 3, i % 5 + 1) for i in range(60)]
    frame = spark.createDataFrame(data, "id long, user_id int, rating int")
    check(encode.loo_encode(frame, "user_id", prefix="u", **HOT), brute_force(data))


def test_loo_identity(rows):
    """Adding a row's rating back to its leave-one-out sum gives the group sum."""
    encoded = encode.loo_encode(rows, "user_id", prefix="u").filter("u_cnt > 1 and rating is not null")
    restored = encoded.withColumn("total", F.col("u_loo_avg") * (F.col("u_cnt") - 1) + F.col("rating"))
    per_key = restored.groupBy("user_id").agg(
        F.min("total").alias("lo"), F.max("total").alias("hi"), F.sum("rating").alias("sum")
    )
    for row in per_key.collect():
        assert row["lo"] == pytest.approx(row["sum"]) and row["hi"] == pytest.approx(row["sum"])


def test_own_rating_never_reaches_own_encoding(spark, rows):
    changed = rows.withColumn("rating", F.when(F.col("id") == 5, 99).otherwise(F.col("rating")).cast("int"))
    prior = F.lit(3.0)
    before = encode.loo_encode(rows, "user_id", prefix="u", prior=prior).filter("id = 5").first()
    after = encode.loo_encode(changed, "user_id", prefix="u", prior=prior).filter("id = 5").first()
    other = encode.loo_encode(changed, "user_id", prefix="u", prior=prior).filter("id = 6").first()
    assert before["u_loo_avg"] == after["u_loo_avg"]
    assert other["u_loo_avg"] > before["u_loo_avg"]


def test_group_mean_encode_is_the_plain_mean(rows):
    prior = stats.global_mean(rows).first()[0]
    for row in stats.group_mean_encode(rows, "user_id").collect():
        rated = [r for _, k, r in ROWS if k == row["user_id"] and r is not None]
        expected = sum(rated) / len(rated) if len(rated) > 1 else prior
        assert row["user_id_avg"] == pytest.approx(expected)
        assert row["user_id_count"] == len(rated)


def test_rows_and_rated_rows_are_counted_apart(rows):
    by_row = {r["user_id"]: r["u_cnt"] for r in stats.group_mean_count(rows, "user_id", "u").collect()}
    by_rating = {r["user_id"]: r["u_cnt"] for r in stats.group_mean_rated(rows, "user_id", "u").collect()}
    assert (by_row["hot"], by_rating["hot"]) == (41, 40)
    assert (by_row["only_null"], by_rating["only_null"]) == (1, 0)


@pytest.mark.parametrize("limits", [{}, HOT])
def test_apply_stats_to_unseen_null_and_hot_keys(spark, rows, limits):
    keys = ["hot"] * 30 + ["unseen"] * 30 + [None] * 20 + ["k1", "single3", "only_null"]
    test = spark.createDataFrame(list(enumerate(keys)), "id long, user_id string")
    table = stats.group_mean_rated(rows, "user_id", "u")
    applied = encode.apply_stats(test, table, "user_id", "u", F.lit(3.5), **limits).collect()
    assert len(applied) == len(keys)
    for row in applied:
        rated = [r for _, k, r in ROWS if k is not None and k == row["user_id"] and r is not None]
        assert row["u_avg"] == pytest.approx(sum(rated) / len(rated) if rated else 3.5)
        assert row["u_cnt"] == len(rated)


def test_chained_keys_keep_every_row(spark):
    data = [(i, f"u{i % 7}", f"p{i % 50}", None if i % 3 else "g", i % 5 + 1) for i in range(200)]
    frame = spark.createDataFrame(
        data, "id long, user_id string, prod_id string, parent_prod_id string, rating int"
    )
    joined = {r["id"]: r.asDict() for r in encode.loo_all_keys(frame).collect()}
    window = {r["id"]: r.asDict() for r in encode.loo_all_keys(frame, encoder=encode.loo_encode_window).collect()}
    assert joined == window and len(joined) == 200


def test_keys_one_after_another_keep_every_row_and_one_table(spark, tmp_path):
    data = [(i % 190, f"u{i % 7}", f"p{i % 50}", None if i % 3 else "g", i % 5 + 1) for i in range(200)]
    frame = spark.createDataFrame(
        data, "id long, user_id string, prod_id string, parent_prod_id string, rating int"
    )
    folder = tmp_path.as_uri()
    frame.write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")
    totals, prior = stats.written_totals(frame, f"{folder}/totals", tuple(KEY_PREFIXES))
    found = encode.loo_all_keys(rows, prior=prior, totals=totals, folder=folder, earlier="rows")
    assert sorted(p.name for p in tmp_path.iterdir()) == ["by-prod", "totals"]
    assert sorted(map(repr, found.collect())) == sorted(map(repr, encode.loo_all_keys(frame).collect()))
