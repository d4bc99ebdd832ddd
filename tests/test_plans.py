"""What the plans must look like to hold at scale."""

import re
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ratewell import queries
from ratewell.operators import encode, joins, split, stats, text
from ratewell.plans import feature_job, training
from ratewell.queries import QUERIES
from ratewell.session import shuffles_released
from ratewell.sources import reviews as source
from ratewell.sources import tables

SMALL = "/root/testdata/sf0.001"
LAZY = [
    "loo_all_keys",
    "loo_all_keys_window",
    "lookup_join_stats",
    "holdout_split",
    "blend_weight_sweep",
    "rating_distribution",
    "vocabulary",
    "join_embeddings",
    "product_metadata_join",
]


def planned(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def executed(frame):
    frame.write.format("noop").mode("overwrite").save()
    frame.collect()
    return planned(frame)


def shuffles_on_disk(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(" ")
    return {int(number) for number in re.findall(r"shuffle_(\d+)_", blocks)}


def left_on_disk(spark, before, few=0):
    """The shuffles since ``before`` whose files are still there after some time to delete them, or ``few``."""
    until = time.time() + 20
    while len(left := shuffles_on_disk(spark) - before) > few and time.time() < until:
        time.sleep(0.2)
    return left


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_no_global_top_k_and_no_python(spark, name):
    plan = planned(QUERIES[name](spark, SMALL))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "TakeOrderedAndProject", "Python", "InPandas"):
        assert operator not in plan


def test_totals_scan_reads_the_key_and_the_rating_only(spark, tmp_path):
    path = str(tmp_path / "reviews")
    rows = source.reviews(spark, SMALL).withColumn("comment", F.lit("a long text"))
    rows.write.parquet(path)
    narrow = spark.read.parquet(path).select("id", "prod_id", "rating")
    plan = planned(encode.loo_encode(narrow, "prod_id"))
    schemas = set(re.findall(r"ReadSchema: (\S+)", plan))
    assert schemas == {
        "struct<id:string,prod_id:string,rating:int>",
        "struct<prod_id:string,rating:int>",
        "struct<rating:int>",
    } or schemas == {
        "struct<id:string,prod_id:string,rating:int>",
        "struct<prod_id:string,rating:int>",
        "struct<rating:int>",
        "struct<>",
    }


def test_hot_and_cold_read_one_aggregation(spark):
    rows = source.reviews(spark, SMALL).select("id", "prod_id", "rating")
    assert "Reused" in executed(encode.loo_encode(rows, "prod_id"))


def test_vocabulary_counts_tokens_once(spark):
    texts = source.text_reviews(spark, SMALL).select("id", F.col("title").alias("text"))
    plan = executed(text.vocabulary(texts)).split("Initial Plan")[0]
    assert plan.count("Generate explode") == 1


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows have one key, a third have none."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id")))
    return spark.range(30_000).select("id", key.alias("user_id"), (F.col("id") % 5 + 1).alias("rating"))


def largest_part(frame, value):
    """The largest task's share of the rows. The value is read, or the join would be pruned."""
    parts = frame.groupBy(F.spark_partition_id().alias("p")).agg(
        F.count(F.lit(1)).alias("count"), F.sum(value)
    )
    counts = [row["count"] for row in parts.collect()]
    return max(counts) / sum(counts)


@pytest.mark.parametrize("encoder", [encode.loo_encode, encode.loo_encode_window])
def test_hot_and_null_keys_spread_over_all_tasks(spark, skewed, encoder):
    settings = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        totals = stats.key_totals(skewed, "user_id")
        assert largest_part(skewed.join(totals, "user_id", "left"), "row_count") > 0.3
        encoded = encoder(skewed, "user_id", prior=F.lit(3.0), share=0.01, min_rows=1)
        assert largest_part(encoded, "user_id_cnt") < 0.2
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_number_of_hot_keys_is_bounded(spark, skewed):
    totals = stats.key_totals(skewed, "user_id")
    hot, _ = joins.hot_and_cold(skewed, totals, "user_id", "row_count", None, share=0.01, min_rows=1)
    assert [r["_hot_key"] for r in hot.collect()] == ["hot"]
    hot, _ = joins.hot_and_cold(skewed, totals.drop("row_count"), "user_id", None, None, 0.01, 1)
    assert [r["_hot_key"] for r in hot.collect()] == ["hot"]


def test_holdout_moves_no_row(spark):
    rows = spark.range(1_000).withColumn("text", F.lit("x"))
    plan = planned(split.holdout_split(rows, 10)).split("Subquery")[0]
    assert "Exchange" not in plan


@pytest.mark.parametrize("name, scans", [("loo_all_keys", 1), ("loo_all_keys_window", 1), ("lookup_join_stats", 1)])
def test_rows_are_scanned_once_beside_the_written_totals(spark, name, scans):
    plan = planned(QUERIES[name](spark, SMALL)).split("Initial Plan")[0]
    assert len(re.findall(r"lineitem\.parquet", plan)) == scans


def test_no_text_moves_in_the_feature_job(spark, tmp_path):
    rows = source.reviews(spark, SMALL).withColumns({"title": F.lit("a title"), "comment": F.lit("a long text")})
    rows.write.parquet(f"{tmp_path}/reviews")
    train = spark.read.parquet(f"{tmp_path}/reviews")
    written = feature_job.run_feature_job(train, train.drop("rating"), f"{tmp_path}/out")
    assert not {"title", "comment"} & {c for table in written.values() for c in table.columns}
    assert written["train"].count() == written["test"].count() == rows.count()


def test_a_written_table_leaves_no_shuffle_files(spark, tmp_path):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = shuffles_on_disk(spark), spark.conf.get(setting, None)
    counted = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    written = tables.write_table(counted, str(tmp_path), "counted")
    assert not left_on_disk(spark, before)
    assert written.count() == 7
    assert spark.conf.get(setting, None) == was
    with pytest.raises(ValueError), shuffles_released(spark):
        raise ValueError
    assert spark.conf.get(setting, None) == was


def test_prediction_sets_shuffle_one_step_at_a_time(spark):
    before = shuffles_on_disk(spark)
    sets = queries._prediction_sets(spark, SMALL)
    assert "Exchange" not in planned(sets)
    assert not left_on_disk(spark, before)


def test_simplex_blend_leaves_only_the_last_step_on_disk(spark):
    before = shuffles_on_disk(spark)
    assert QUERIES["blend_simplex"](spark, SMALL).count() == 3
    # The widest row and the products of errors are fetched, a shuffle of a few rows each.
    assert len(left_on_disk(spark, before, few=3)) <= 3


def test_loads_read_written_reviews_and_leave_no_shuffles(spark):
    before = shuffles_on_disk(spark)
    encoded = QUERIES["incremental_loo"](spark, SMALL)
    assert not any("testdata" in path for path in encoded.inputFiles())
    assert len(left_on_disk(spark, before, few=2)) <= 2


def test_a_feature_table_leaves_no_shuffles_and_no_unscaled_features(spark):
    before = shuffles_on_disk(spark)
    table = training.feature_table(source.reviews(spark, SMALL))
    assert not left_on_disk(spark, before)
    folder = Path(table.inputFiles()[0].removeprefix("file:")).parent.parent
    assert sorted(p.name for p in folder.iterdir() if any(p.rglob("*.parquet"))) == ["moments.parquet", "scaled.parquet", "stats.parquet"]
    assert table.count() == 6_000
