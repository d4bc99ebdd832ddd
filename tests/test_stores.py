"""Totals by loads, lookups stored by key, and scores without held-out rows."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratewell.operators import encode, joins, ridge, stats
from ratewell.sources import bucketed, increments

KEYS = ("user_id", "prod_id")
SCHEMA = "id long, user_id string, prod_id string, rating int"
ROWS = [
    (1, "a", "x", 5), (2, "a", "y", 1), (3, "b", "x", None), (4, None, "x", 4), (5, "b", None, 2), (6, "c", "z", 3),
    (7, "a", "x", 2),
]


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


@pytest.fixture
def store(spark, tmp_path):
    folder = str(tmp_path / "store")
    increments.create_store(spark, folder)
    return folder


def whole(spark, rows):
    return rows_of(stats.all_key_totals(spark.createDataFrame(rows, SCHEMA), KEYS))


def test_loads_equal_one_and_a_load_run_again_counts_once(spark, store):
    for name, part in (("one", ROWS[:3]), ("two", ROWS[3:5]), ("three", ROWS[5:]), ("two", ROWS[3:5]), ("none", [])):
        increments.add_load(spark.createDataFrame(part, SCHEMA), store, name, KEYS)
    assert rows_of(increments.current_totals(spark, store)) == whole(spark, ROWS)
    assert {r.loaded for r in increments.load_names(spark, store).collect()} == {"one", "two", "three"}


def test_corrections_change_ratings_and_take_rows_away(spark, store):
    increments.add_load(spark.createDataFrame(ROWS, SCHEMA), store, "all", KEYS)
    signed = [(*ROWS[0], -1), (1, "a", "x", 4, 1), (*ROWS[5], -1), (*ROWS[2], -1), (3, "b", "x", 1, 1)]
    increments.add_load(spark.createDataFrame(signed, SCHEMA + ", sign int"), store, "fix", KEYS, sign="sign")
    left = [(1, "a", "x", 4), ROWS[1], (3, "b", "x", 1), ROWS[3], ROWS[4], ROWS[6]]
    assert rows_of(increments.current_totals(spark, store)) == whole(spark, left)


def test_compaction_keeps_totals_and_refuses_what_it_merged(spark, store, tmp_path):
    increments.add_load(spark.createDataFrame(ROWS[:3], SCHEMA), store, "one", KEYS)
    increments.add_load(spark.createDataFrame(ROWS[3:5], SCHEMA), store, "two", KEYS)
    second, third = str(tmp_path / "second"), str(tmp_path / "third")
    increments.compact(spark, store, second)
    increments.add_load(spark.createDataFrame(ROWS[5:], SCHEMA), second, "three", KEYS)
    increments.compact(spark, second, third)
    for folder in (second, third):
        assert rows_of(increments.current_totals(spark, folder)) == whole(spark, ROWS)
        assert {r.loaded for r in increments.load_names(spark, folder).collect()} == {"one", "two", "three"}
    with pytest.raises(ValueError, match="compacted already"):
        increments.add_load(spark.createDataFrame(ROWS[:1], SCHEMA), third, "one", KEYS)
    for name in ("compacted", "a/b", ""):
        with pytest.raises(ValueError, match="not a name"):
            increments.add_load(spark.createDataFrame(ROWS[:1], SCHEMA), third, name, KEYS)


def test_a_load_does_not_read_the_history(spark, store):
    increments.add_load(spark.createDataFrame(ROWS[:3], SCHEMA), store, "one", KEYS)
    before = rows_of(spark.read.parquet(f"{store}/loads/load=one"))
    increments.add_load(spark.createDataFrame(ROWS[3:], SCHEMA), store, "two", KEYS)
    assert rows_of(spark.read.parquet(f"{store}/loads/load=one")) == before
    assert spark.read.parquet(f"{store}/loads/load=two").where("key_name = 'all_rows'").first().row_count == 4


@pytest.fixture
def sorted_joins(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def shuffles(frame):
    """The keys by which the executed plan shuffles."""
    frame.write.format("noop").mode("overwrite").save()
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    return re.findall(r"hashpartitioning\((\w+)#", plan)


def test_a_lookup_stored_by_its_key_stays_in_place(spark, sorted_joins, tmp_path):
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = spark.range(2_000).select("id", F.concat(F.lit("k"), F.col("id") % 300).alias("user_id"))
    lookup = spark.range(250).select(F.concat(F.lit("k"), F.col("id")).alias("user_id"), (F.col("id") * 2).alias("looked"))
    lookup.write.parquet(str(tmp_path / "plain"))
    plain = spark.read.parquet(str(tmp_path / "plain"))
    stored = bucketed.write_bucketed(plain, str(tmp_path / "stored"), "user_id", buckets)
    again = bucketed.open_bucketed(spark, str(tmp_path / "stored"), "user_id string, looked long", "user_id", buckets)
    want = rows_of(joins.lookup_join(rows, plain, "user_id"))
    assert "_cold_key" in shuffles(joins.lookup_join(rows, plain, "user_id"))
    for table in (stored, again):
        joined = joins.lookup_join(rows, table, "user_id")
        assert rows_of(joined) == want
        dealt = shuffles(joins.lookup_join(rows, table, "user_id"))
        assert "_probe_key" in dealt and "_cold_key" not in dealt
        hot = joins.lookup_join(rows, table, "user_id", share=1e-3, min_rows=1)
        assert rows_of(hot) == want


def test_encoding_by_a_stored_table_with_null_and_unseen_keys(spark, tmp_path):
    rows = spark.createDataFrame(ROWS, SCHEMA)
    lookup = stats.group_mean_count(rows.where("id < 4"), "user_id", "user")
    stored = bucketed.write_bucketed(lookup, str(tmp_path / "stored"), "user_id", 8)
    prior = F.lit(3.0)
    assert rows_of(encode.apply_stats(rows, stored, "user_id", "user", prior)) == rows_of(
        encode.apply_stats(rows, lookup, "user_id", "user", prior)
    )
    empty = bucketed.write_bucketed(lookup.limit(0), str(tmp_path / "empty"), "user_id", 8)
    found = encode.apply_stats(rows, empty, "user_id", "user", prior).collect()
    assert len(found) == len(ROWS) and {(r.user_avg, r.user_cnt) for r in found} == {(3.0, 0)}


def test_leave_one_out_equals_refitting_without_the_row(spark):
    random = np.random.default_rng(5)
    x = random.normal(size=(40, 5)) * [1, 10, 0.1, 1, 1] + [0, 1000, 0, 0, 3]
    x[:, 4] = 3.0
    y = np.clip(np.round(x[:, 0] + 3 + random.normal(size=40)), 1, 5)
    data = [(x[i].tolist(), float(y[i])) for i in range(40)] + [(x[0].tolist(), None)]
    rows = spark.createDataFrame(data, "features array<double>, rating double").repartition(3)
    alphas = (0.1, 2.0, 50.0)
    got = {r.alpha: r.rmse for r in ridge.ridge_leave_one_out(rows, alphas).scores.collect()}
    for alpha in alphas:
        errors = []
        for i in range(40):
            keep = np.arange(40) != i
            z = np.column_stack([np.ones(39), x[keep], y[keep]])
            z[:, 1:] -= z[:, 1:].mean(axis=0)
            slope = np.linalg.solve(z[:, 1:-1].T @ z[:, 1:-1] + alpha * np.eye(5), z[:, 1:-1].T @ z[:, -1])
            guess = y[keep].mean() + (x[i] - x[keep].mean(axis=0)) @ slope
            errors.append(np.clip(guess, 1, 5) - y[i])
        assert got[alpha] == pytest.approx(np.sqrt(np.mean(np.square(errors))), rel=1e-9)
    fitted = ridge.ridge_leave_one_out(rows, alphas)
    direct = ridge.ridge_fit(rows, fitted.best.alpha)
    assert np.allclose(fitted.best.coefficients, direct.coefficients) and fitted.best.alpha == min(got, key=got.get)


def test_leave_one_out_needs_other_rows_and_a_penalty(spark):
    one = spark.createDataFrame([([1.0, 2.0], 3.0)], "features array<double>, rating double")
    found = ridge.ridge_leave_one_out(one, (1.0, 2.0))
    assert [r.rmse for r in found.scores.collect()] == [None, None] and found.best.alpha == 1.0
    with pytest.raises(ValueError, match="above 0"):
        ridge.ridge_leave_one_out(one, (0.0, 1.0))
    with pytest.raises(ValueError, match="no row"):
        ridge.ridge_leave_one_out(one.limit(0), (1.0,))
