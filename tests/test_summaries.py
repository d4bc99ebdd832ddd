"""Stored sketches and rank summaries, bootstrap intervals, blends of many sets, ridge on sparse rows."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratewell import queries
from ratewell.operators import blend, bootstrap, encoders, ridge_sparse
from ratewell.sources import rank_summaries, sketches


def values_of(spark, numbers):
    return spark.createDataFrame([(x,) for x in numbers], "x double")


def test_sketches_unite_parts_that_overlap(spark, tmp_path):
    folder = str(tmp_path / "sketches")
    rows = spark.range(30_000).select(F.col("id").cast("string").alias("a"), F.lit(None).cast("string").alias("b"))
    for name, part in (("one", rows.where("a < 20000")), ("two", rows.where("a >= 10000")), ("two", rows.where("a >= 10000"))):
        sketches.add_part(part, folder, name, ("a", "b"))
    sketches.add_part(rows.limit(0), folder, "none", ("a", "b"))
    found = {r.key_name: r for r in sketches.distinct_counts(spark, folder).collect()}
    assert abs(found["a"].distinct_count - 30_000) <= 30_000 * sketches.ERROR_BOUND
    assert (found["b"].distinct_count, found["a"].row_count) == (1, 40_000)
    one = {r.key_name: r.distinct_count for r in sketches.distinct_counts(spark, folder, ["one"]).collect()}
    assert abs(one["a"] - 20_000) <= 20_000 * sketches.ERROR_BOUND
    into = str(tmp_path / "compacted")
    sketches.compact(spark, folder, into, "all")
    assert {r.key_name: r for r in sketches.distinct_counts(spark, into).collect()} == found
    with pytest.raises(ValueError):
        sketches.add_part(rows, folder, "a/b", ("a",))


def assert_within(numbers, found, error):
    assert found
    ordered = sorted(numbers)
    for row in found:
        target = max(1, math.ceil(row.share * len(ordered)))
        assert row.n_rows == len(ordered)
        assert row.slack <= error * len(ordered) + 1e-9
        assert sum(x <= row.value for x in ordered) >= target
        assert sum(x < row.value for x in ordered) < target + row.slack


@pytest.mark.parametrize("blocks, fan", [(1 << 20, 64), (50, 2), (7, 3)])
def test_rank_summaries_keep_their_bound_over_parts(spark, tmp_path, blocks, fan):
    rng = np.random.default_rng(1)
    parts = [rng.normal(size=900).tolist(), [3.0] * 700 + rng.exponential(5, 300).tolist(), [-1.5], []]
    folder = str(tmp_path / "ranks")
    for i, numbers in enumerate(parts):
        frame = values_of(spark, [*numbers, None, float("nan")])
        rank_summaries.add_part(frame, folder, f"p{i}", "x", 0.02, blocks, fan)
    shares = (0.0, 0.1, 0.25, 0.5, 0.9, 0.999, 1.0)
    found = rank_summaries.quantiles(spark, folder, shares).collect()
    assert len(found) == len(shares)
    assert_within(sum(parts, []), found, 0.02)
    assert_within(parts[1], rank_summaries.quantiles(spark, folder, shares, ["p1"]).collect(), 0.02)
    assert rank_summaries.quantiles(spark, folder, shares, ["p3"]).collect() == []
    everything = sum(parts, [])
    for row in rank_summaries.ranks(spark, folder, (-9.0, 0.0, 3.0, 99.0)).collect():
        assert row.at_least <= sum(x <= row.value for x in everything) <= row.at_most
    stored = spark.read.parquet(f"{folder}/parts")
    assert stored.groupBy("part_name").count().agg(F.max("count")).first()[0] <= math.ceil(12 / 0.02)


def test_rank_summary_is_the_same_in_any_layout_and_a_part_replaces_itself(spark, tmp_path):
    numbers = np.random.default_rng(2).integers(0, 400, 2000).astype(float).tolist()
    folder = str(tmp_path / "ranks")
    rank_summaries.add_part(values_of(spark, numbers), folder, "p", "x", 0.05, 30, 2)
    first = sorted(map(tuple, spark.read.parquet(f"{folder}/parts").collect()))
    rank_summaries.add_part(values_of(spark, numbers[::-1]).repartition(5), folder, "p", "x", 0.05, 30, 2)
    assert sorted(map(tuple, spark.read.parquet(f"{folder}/parts").collect())) == first
    with pytest.raises(ValueError):
        rank_summaries.add_part(values_of(spark, numbers), folder, "p", "x", 1.5)


def test_poisson_weights_have_mean_and_variance_one(spark):
    steps = bootstrap.poisson_steps()
    drawn = np.searchsorted(steps, np.arange(16**bootstrap.DIGITS), side="right")
    assert abs(drawn.mean() - 1) < 2e-4
    assert abs(drawn.var() - 1) < 1e-3


def test_replicates_by_plain_loops(spark):
    import hashlib

    rng = np.random.default_rng(3)
    rows = [(i, int(rng.integers(1, 6)), float(rng.normal(3, 1)), float(rng.normal(3, 2))) for i in range(60)]
    rows += [(60, None, 1.0, 2.0), (61, 3, None, 2.0)]
    frame = spark.createDataFrame(rows, "id long, rating int, a double, b double")
    models = {"a": F.col("a"), "b": F.col("b")}
    found = bootstrap.replicate_sums(frame, models, 20)
    want = {}
    steps = bootstrap.poisson_steps()
    for i, y, *predictions in rows[:60]:
        for r in range(21):
            weight = 1
            if r:
                digest = hashlib.md5(f"42:{(r - 1) // 8}:{i}".encode()).hexdigest()
                at = (r - 1) % 8 * 4
                weight = sum(int(digest[at : at + 4], 16) >= s for s in steps)
            for name, p in zip("ab", predictions):
                w, s = want.get((r, name), (0, 0.0))
                want[r, name] = (w + weight, s + weight * (min(5, max(1, p)) - y) ** 2)
    got = {(r.replicate, r.model): (r.weight, r.squared) for r in found.collect()}
    assert got.keys() == want.keys()
    for key, (weight, squared) in want.items():
        assert got[key][0] == weight
        assert got[key][1] == pytest.approx(squared)
    table = {r.model: r for r in bootstrap.difference_intervals(found, "a").collect()}
    differences = [
        math.sqrt(want[r, "b"][1] / want[r, "b"][0]) - math.sqrt(want[r, "a"][1] / want[r, "a"][0]) for r in range(1, 21)
    ]
    assert table["b"].low == pytest.approx(np.quantile(differences, 0.025))
    assert table["b"].high == pytest.approx(np.quantile(differences, 0.975))
    assert (table["a"].difference, table["a"].low, table["a"].high) == (0, 0, 0)
    assert bootstrap.replicate_sums(frame.limit(0), models, 20).collect() == []


def test_replicates_copy_no_row_and_keep_odd_errors_where_they_are_drawn(spark, monkeypatch):
    rows = [(i, 3, float("nan") if i % 5 == 0 else 2.0, 4.0) for i in range(40)] + [(0, 3, 1.0, 4.0)]
    frame = spark.createDataFrame(rows, "id long, rating int, a double, b double")
    models = {"a": F.col("a"), "b": F.col("b")}

    def found(replicates):
        sums = bootstrap.replicate_sums(frame, models, replicates)
        # The old plan made a row per digest and one per replicate: two generators after another.
        assert sums._jdf.queryExecution().optimizedPlan().toString().count("Generate explode") <= 1
        return {(r.replicate, r.model): (r.weight, repr(r.squared)) for r in sums.collect()}

    whole = found(50)
    assert whole[0, "a"] == (41, "nan") and whole[0, "b"] == (41, "41.0")
    assert all(squared == repr(float(weight)) for (_, model), (weight, squared) in whole.items() if model == "b")
    # Digests come in several groups, and their numbers stay the same.
    monkeypatch.setattr(bootstrap, "DIGESTS", 3)
    monkeypatch.setattr(bootstrap, "BLOCK", 7)
    assert found(50) == whole
    one = spark.createDataFrame(rows[:1], frame.schema)
    drawn = {r.replicate: r.weight for r in bootstrap.replicate_sums(one, models, 50).collect()}
    assert 0 in drawn and 0 not in drawn.values() and len(drawn) < 51


def test_intervals_read_written_sums(spark):
    found = queries.bootstrap_intervals(spark, "/root/testdata/sf0.001")
    assert all("replicates" in path for path in found.inputFiles()) and "lineitem" not in str(found.inputFiles())


def best_on_grid(squares, steps=20):
    count = len(squares)
    return min(
        np.array(w) @ squares @ np.array(w) / steps**2
        for w in itertools.product(range(steps + 1), repeat=count)
        if sum(w) == steps
    )


@pytest.mark.parametrize("seed", range(12))
def test_no_grid_point_beats_the_simplex_minimum(seed):
    rng = np.random.default_rng(seed)
    errors = rng.normal(size=(50, 4)) @ rng.normal(size=(4, 4)) + rng.normal(size=4)
    squares = errors.T @ errors / 50
    weights = blend.simplex_minimum(squares)
    assert weights.min() >= 0
    assert weights.sum() == pytest.approx(1)
    least = weights @ squares @ weights
    assert least <= best_on_grid(squares) + 1e-9
    slope = squares @ weights
    assert slope.min() >= least - 1e-8 * np.trace(squares)


@pytest.mark.parametrize("squares", [np.zeros((3, 3)), np.ones((3, 3)), np.diag([1.0, 1e-12, 5.0]), np.array([[2.0]])])
def test_simplex_minimum_of_equal_and_perfect_sets(squares):
    weights = blend.simplex_minimum(squares)
    assert weights.min() >= 0
    assert weights.sum() == pytest.approx(1)
    assert weights @ squares @ weights <= np.diag(squares).min() + 1e-12


def test_blend_of_sets(spark):
    rng = np.random.default_rng(5)
    y = rng.integers(1, 6, 80)
    sets = {n: y + rng.normal(b, s, 80) for n, b, s in (("a", 0.3, 1.0), ("b", -0.5, 1.0), ("c", 3.0, 1.0))}
    frames = {
        n: spark.createDataFrame([(i, float(p)) for i, p in enumerate(v)], "id long, rating double") for n, v in sets.items()
    }
    frames["b"] = frames["b"].union(spark.createDataFrame([(99, 1.0)], "id long, rating double"))
    joined = blend.join_prediction_sets(frames)
    assert joined.count() == 80
    with pytest.raises(Exception, match="different ids"):
        blend.join_prediction_sets(frames, strict=True).collect()
    rated = joined.join(spark.createDataFrame([(i, int(v)) for i, v in enumerate(y)], "id long, rating int"), "id")
    found = blend.simplex_blend(rated, ["a", "b", "c"])
    errors = np.column_stack([sets[n] - y for n in "abc"])
    squares = errors.T @ errors / 80
    assert found.rmse**2 <= best_on_grid(squares, 40) + 1e-9
    two = blend.simplex_blend(rated, ["a", "b"])
    a, b = errors[:, 0], errors[:, 1]
    assert two.weights["a"] == pytest.approx(min(1, max(0, b @ (b - a) / ((a - b) @ (a - b)))))
    got = {r.id: r.rating for r in blend.blend_sets(joined, found.weights).collect()}
    w = np.array([found.weights[n] for n in "abc"])
    for i in range(80):
        assert got[i] == pytest.approx(min(5, max(1, (errors[i] + y[i]) @ w)))
    empty = blend.simplex_blend(rated.limit(0), ["a", "b"])
    assert empty.weights == {"a": 0.5, "b": 0.5}
    assert math.isnan(empty.rmse)


def sparse_rows(spark, rng, n=120, width=40):
    rows, dense = [], np.zeros((n, width))
    for i in range(n):
        slots = rng.integers(0, width - 3, rng.integers(0, 9)).tolist()
        values = (rng.normal(2, 1, len(slots)) * 10.0 ** rng.integers(-1, 2)).tolist()
        for s, v in zip(slots, values):
            dense[i, s] += v
        rows.append((i, slots, values, float(rng.normal(4, 1) + dense[i, 0])))
    return spark.createDataFrame(rows, "id long, slots array<int>, values array<double>, rating double"), dense, np.array([r[3] for r in rows])


def test_sparse_ridge_equals_the_direct_solution(spark):
    frame, x, y = sparse_rows(spark, np.random.default_rng(6))
    odd = [(900, [1], [1.0], None), (901, None, [1.0], 2.0), (902, [1], None, 2.0)]
    alphas = (0.1, 1.0, 100.0)
    models = ridge_sparse.fit_sparse(frame.union(spark.createDataFrame(odd, frame.schema)).repartition(5), 40, alphas)
    centred = x - x.mean(0)
    for model, alpha in zip(models, alphas):
        want = np.linalg.solve(centred.T @ centred + alpha * np.eye(40), centred.T @ (y - y.mean()))
        assert np.abs(model.coefficients - want).max() < 1e-8
        assert model.intercept == pytest.approx(y.mean() - x.mean(0) @ want, abs=1e-8)
        assert (model.coefficients[-3:] == 0).all()
    scored = ridge_sparse.score_sparse(frame, models).orderBy("id").collect()
    for j, model in enumerate(models):
        assert np.allclose([r.scores[j] for r in scored], x @ model.coefficients + model.intercept)


def test_sparse_ridge_refuses_what_it_cannot_fit(spark):
    frame, _, _ = sparse_rows(spark, np.random.default_rng(7), 30)
    for bad in ({"width": 20}, {"width": ridge_sparse.MAX_SPARSE_FEATURES + 1}, {"width": 40, "alphas": (0.0,)}):
        with pytest.raises(ValueError):
            ridge_sparse.fit_sparse(frame, **bad)
    with pytest.raises(ValueError, match="no row"):
        ridge_sparse.fit_sparse(frame.limit(0), 40)
    with pytest.raises(ValueError, match="not solved"):
        ridge_sparse.fit_sparse(frame, 40, (1e-3,), max_steps=1)


def test_tfidf_slots_equal_the_dense_vectors(spark):
    texts = spark.createDataFrame([(1, "a b a"), (2, "b c"), (3, ""), (4, None)], "id long, text string")
    dense = {r.id: r.embedding for r in encoders.tfidf_embeddings(texts, 16).collect()}
    for row in encoders.tfidf_slots(texts, 16).collect():
        filled = [0.0] * 16
        for slot, value in zip(row.slots, row["values"]):
            filled[slot] = value
        assert filled == pytest.approx(dense[row.id], abs=1e-6)
