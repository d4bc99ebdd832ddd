import glob

import pytest
from pyspark.sql import functions as F

from ratewell.operators import encode, evaluate, stats
from ratewell.plans import feature_job
from ratewell.schemas import TRAIN_SCHEMA
from ratewell.session import pinned, scratch_path
from ratewell.sources import embeddings, files, tables

ROWS = [
    (1, "u1", "p1", "g1", "plain", "text", 10, 2, True, 5),
    (2, "u1", "p2", "g1", 'a "quoted" word', "two\nlines, and a comma", 11, None, None, 4),
    (3, None, "p1", "g1", None, 'ends with "', 12, -1, False, 1),
    (4, "u2", "p3", None, "  spaces kept  ", None, None, 0, True, None),
    (5, "u2", "p3", "g2", "NA", "back\\slash", 14, 7, False, 3),
]


@pytest.fixture(scope="module")
def reviews(spark):
    return spark.createDataFrame(ROWS, TRAIN_SCHEMA)


def plain(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_csv_round_trip(spark, reviews, tmp_path):
    path = str(tmp_path / "csv")
    files.write_reviews_csv(reviews, path)
    assert plain(files.read_reviews_csv(spark, path)) == plain(reviews)


def test_csv_written_by_hand(spark, tmp_path):
    file = tmp_path / "reviews.csv"
    file.write_text(
        ",".join(TRAIN_SCHEMA.names)
        + '\n7,u,p,g,"say ""hi""","first line\nsecond, line",1,2,true,4\n8,u,p,g,NA,,1,,,\n'
    )
    rows = {r["id"]: r for r in files.read_reviews_csv(spark, str(file)).collect()}
    assert rows[7]["title"] == 'say "hi"' and rows[7]["comment"] == "first line\nsecond, line"
    assert rows[8]["title"] == "NA" and rows[8]["comment"] is None
    assert rows[8]["votes"] is None and rows[8]["purchased"] is None and rows[8]["rating"] is None


def test_conversion_deals_rows_anew_on_request_only(spark, tmp_path):
    rows = spark.range(100).select("id")
    files.write_reviews_csv(rows.coalesce(1), f"{tmp_path}/csv")
    one = files.convert_reviews(spark, f"{tmp_path}/csv", f"{tmp_path}/one", rows.schema)
    more = files.convert_reviews(spark, f"{tmp_path}/csv", f"{tmp_path}/more", rows.schema, partitions=4)
    assert len(one.inputFiles()) == 1 and len(more.inputFiles()) == 4
    assert one.count() == more.count() == 100


def test_corrupt_rows_are_kept_on_request(spark, tmp_path):
    file = tmp_path / "reviews.csv"
    file.write_text(",".join(TRAIN_SCHEMA.names) + "\nnot a number,u,p,g,t,c,1,2,true,4\n")
    row = files.read_reviews_csv(spark, str(file), keep_corrupt=True).first()
    assert row["id"] is None and row["user_id"] == "u" and row["_corrupt_record"].startswith("not a number")


def test_csv_scan_is_pruned(spark, reviews, tmp_path):
    path = str(tmp_path / "parquet")
    csv = str(tmp_path / "csv")
    files.write_reviews_csv(reviews, csv)
    rows = files.convert_reviews(spark, csv, path).select("id", "rating").filter("rating > 3")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint,rating:int>" in plan
    assert "GreaterThan(rating,3)" in plan
    assert plain(rows) == [(1, 5), (2, 4)]


def test_prior_and_tables_are_replaced(spark, reviews, tmp_path):
    folder = str(tmp_path)
    for frame in (reviews, reviews.filter("rating < 5")):
        prior = tables.write_prior(stats.global_mean(frame), folder)
        want = frame.agg(F.avg("rating")).first()[0]
        assert spark.range(1).select(prior).first()[0] == want
        assert spark.range(1).select(tables.read_prior(spark, folder)).first()[0] == want


def test_feature_job_writes_what_it_returns(spark, reviews, tmp_path):
    folder = str(tmp_path)
    train, test = reviews, reviews.drop("rating").withColumn("user_id", F.lit("new"))
    written = feature_job.run_feature_job(train, test, folder)
    assert written["train"].count() == 5 and written["test"].count() == 5
    assert {r["user_cnt"] for r in written["test"].collect()} == {0}
    assert len(glob.glob(f"{folder}/*.parquet")) == 6
    loaded, prior = feature_job.load_lookup_tables(spark, folder)
    assert spark.range(1).select(prior).first()[0] == stats.global_mean(train).first()[0]
    assert plain(loaded["prod_id"].drop("row_count")) == plain(stats.group_stats(train, "prod_id"))
    direct = encode.loo_all_keys(train.drop("title", "comment"))
    assert plain(written["train"]) == plain(direct)


def test_store_encodes_only_missing_ids(spark, tmp_path):
    path = str(tmp_path / "store")
    assert embeddings.read_store(spark, path) is None

    def encode(mark):
        return lambda rows: rows.select("id", F.array(F.lit(mark).cast("float")).alias("embedding"))

    embeddings.update_store(spark.range(0, 3), path, encode(1.0), "id")
    embeddings.update_store(spark.range(0, 5), path, encode(2.0), "id")
    store = embeddings.update_store(spark.range(0, 5), path, encode(3.0), "id")
    assert plain(store) == [(0, [1.0]), (1, [1.0]), (2, [1.0]), (3, [2.0]), (4, [2.0])]


def test_submission_has_a_header_and_all_rows(spark, tmp_path):
    path = str(tmp_path / "submission")
    rows = spark.range(10).select("id", (F.col("id") / 2).alias("prediction"))
    files.write_submission(rows, path, rating="prediction")
    assert plain(files.read_submission(spark, path)) == [(i, i / 2) for i in range(10)]
    first = sorted(glob.glob(f"{path}/part-*.csv"))[0]
    assert open(first).readline().strip() == "id,rating"


def test_metrics_round_trip(spark, tmp_path):
    path = str(tmp_path / "metrics")
    rows = spark.createDataFrame([(1.0,), (2.0,)], "rating double")
    files.write_metrics(files.metrics_frame(rows, F.lit(0.5), 12.0), path)
    row = files.read_metrics(spark, path).first()
    assert row["best_val_rmse"] == 0.5 and row["total_time_seconds"] == 12.0
    assert tuple(row["prediction_stats"]) == (1.0, 2.0, 1.5)


def test_pinned_frame_is_released(spark):
    frame = spark.range(10).withColumn("x", F.col("id") * 2)
    with pinned(frame) as kept:
        assert kept.count() == 10 and kept.is_cached
        assert evaluate.row_counts(all=kept).first()["row_count"] == 10
    assert not frame.is_cached


def test_scratch_paths_are_new_each_time(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second
    assert not root or first.startswith(root)
