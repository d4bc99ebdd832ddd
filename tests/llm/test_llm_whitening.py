"""Whitening against plain loops over integers of any size."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratewell.llm import whitening
from ratewell.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def covariance(points):
    """Exact covariances of a list of integer vectors, from their definition."""
    n, width = len(points), len(points[0])
    sums = [sum(p[i] for p in points) for i in range(width)]
    centred = [[n * p[i] - sums[i] for i in range(width)] for p in points]
    return sums, np.array([[sum(c[i] * c[j] for c in centred) / n**3 for j in range(width)] for i in range(width)])


def check(rows, vectors, components=4):
    """``vectors`` maps ids to entries."""
    points = {key: [math.floor(256 * float(c)) for c in vector] for key, vector in vectors.items()}
    distinct = sorted(set(map(tuple, points.values())))
    sums, matrix = covariance(distinct)
    n, values = len(distinct), np.linalg.eigvalsh(matrix)[::-1]
    found = {}
    for row in rows:
        found.setdefault(row.vec_id, {})[row.component] = row
    assert sorted(found) == sorted(vectors)
    for key, mine in found.items():
        assert sorted(mine) == list(range(1, components + 1))
        far = sum((n * c - s) ** 2 for c, s in zip(points[key], sums))
        for k, row in mine.items():
            assert row.n == n and row.deviation == (far if far < 1 << 63 else None)
            assert row.explained == pytest.approx(values[k - 1] / values.sum(), rel=1e-9)
            assert 0 <= row.identity_error <= 1e-9
    # Projections on unit eigenvectors give back the matrix they came from, whatever their signs.
    at = {tuple(points[key]): key for key in points}
    white = np.array([[found[at[p]][k].whitened for k in range(1, components + 1)] for p in distinct])
    assert np.abs(white.mean(0)).max() < 1e-9 and np.abs(white.T @ white / n - np.eye(components)).max() < 1e-8
    centred = np.array([[c - s / n for c, s in zip(p, sums)] for p in distinct])
    axes = centred.T @ white / n / np.sqrt(values[:components])
    assert np.abs(matrix @ axes - axes * values[:components]).max() < 1e-8 * values[0]


def test_whole_table(spark):
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet").limit(120)
    vectors = {row.vec_id: row.embedding for row in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()}
    rows = QUERIES["op11_whitening"](spark, FOLDER).collect()
    check(rows, vectors)
    assert table.count() == 120


def test_nulls_copies_and_other_columns(spark):
    rng, nan, inf = np.random.default_rng(3), float("nan"), float("inf")
    rows = [(i, rng.normal(size=5).tolist()) for i in range(40)] + [(100 + i, [0.5, 0.0, -0.0, 1.0, -1.0]) for i in range(30)]
    odd = [(None, [0.5, 0.0, 0.0, 1.0, -1.0]), (200, None), (201, []), (202, [nan] * 5), (203, [inf] * 5), (204, [None] * 5), (205, [1.0])]
    frame = spark.createDataFrame(rows + odd + rows[:3], "vec_id bigint, embedding array<double>")
    frame = frame.withColumns({name: F.lit("odd") for name in ("x", "n", "component", "label")})
    found = whitening.whiten(frame).collect()
    assert len(found) == 4 * (len(rows) + 4) and sum(r.vec_id is None for r in found) == 4
    check([r for r in found if r.vec_id is not None], dict(rows))
    assert whitening.whiten(frame.limit(0)).count() == 0 and whitening.whiten(frame.where("vec_id = 0")).count() == 0


@pytest.mark.parametrize("scale", [1e6, 1e12])
def test_large_entries_stay_exact(spark, scale):
    rng = np.random.default_rng(5)
    rows = [(i, (scale * (1 + 0.1 * rng.normal(size=3))).tolist()) for i in range(50)]
    check(whitening.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), 2).collect(), dict(rows), 2)


def test_entries_beyond_the_grid(spark):
    rows = [(0, [1e300, 0.0]), (1, [-1e300, 1.0]), (2, [0.0, 5.0]), (3, [3.0, -2.0])]
    found = whitening.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    assert {r.vec_id for r in found} == {0, 1, 2, 3} and all(np.isfinite(r.whitened) for r in found)


def test_fewer_dimensions_than_components(spark):
    rows = [(i, [float(i), 2.0 * i, float(i * i)]) for i in range(6)]
    found = whitening.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    assert {r.component for r in found} == {1, 2}


def test_squares_of_blocks_add_up():
    rng = np.random.default_rng(6)
    x = rng.integers(-500, 900, (70, 4))
    sums = [int(s) for s in x.sum(0)]
    partial = whitening.centred_squares(len(x), sums)
    total = {}
    for block in (x[:11], x[11:40], x[40:]):
        for place, q in partial(block).items():
            total[place] = total.get(place, 0) + q
    y = [[len(x) * int(c) - s for c, s in zip(row, sums)] for row in x]
    assert total == {(i, j): sum((r[i] + r[j] * (i != j)) ** 2 for r in y) for i in range(4) for j in range(i, 4)}
