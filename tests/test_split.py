import pytest
from pyspark.sql import functions as F

from ratewell.operators import split


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(3_000)


def members(frame, name):
    return {r["id"] for r in frame.filter(F.col("split") == name).collect()}


def by_hash(rows):
    hashed = rows.select("id", split.split_hash().alias("h")).collect()
    return [r["id"] for r in sorted(hashed, key=lambda r: r["h"])]


@pytest.mark.parametrize("n", [0, 1, 37, 2_999, 3_000, 5_000])
def test_holdout_is_exact(rows, n):
    cut = split.holdout_split(rows, n)
    order = by_hash(rows)
    assert members(cut, "val") == set(order[:n])
    assert members(cut, "train") == set(order[n:])


def test_training_subset_follows_the_validation_block(rows):
    cut = split.holdout_split(rows, 100, 250)
    order = by_hash(rows)
    assert members(cut, "val") == set(order[:100])
    assert members(cut, "train") == set(order[100:350])
    assert cut.filter("split is null").count() == 2_650


def test_subset_sample(rows):
    assert split.subset_sample(rows, 123).count() == 123
    assert split.subset_sample(rows, 10_000).count() == 3_000


def test_splits_depend_on_seed_and_not_on_partitions(rows):
    for make in (lambda r, s: split.holdout_split(r, 300, seed=s), lambda r, s: split.fraction_split(r, 80, s)):
        first = members(make(rows, 1), "val")
        assert members(make(rows.repartition(13).orderBy(F.desc("id")), 1), "val") == first
        assert members(make(rows, 2), "val") != first


def test_fraction_split_is_disjoint_complete_and_near_the_share(rows):
    cut = split.fraction_split(rows, 80)
    train, val = members(cut, "train"), members(cut, "val")
    assert not train & val and len(train | val) == 3_000
    assert 0.77 < len(train) / 3_000 < 0.83


def test_null_ids_and_empty_rows(spark, rows):
    with_null = rows.unionByName(spark.sql("select cast(null as bigint) as id"))
    assert members(split.holdout_split(with_null, 5), "val") == set(by_hash(rows)[:5])
    assert split.subset_sample(rows.filter("id < 0"), 5).count() == 0
