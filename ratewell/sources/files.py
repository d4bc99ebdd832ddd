"""Review CSVs, prediction CSVs and metrics JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewell.schemas import TRAIN_SCHEMA

# Texts hold line breaks and doubled quotes inside quoted fields.
CSV_FORMAT = {"header": True, "multiLine": True, "quote": '"', "escape": '"'}
CORRUPT_COLUMN = "_corrupt_record"


def read_reviews_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = TRAIN_SCHEMA,
    columns: tuple[str, ...] | None = None,
    keep_corrupt: bool = False,
) -> DataFrame:
    """Reviews from CSV with a header. ``columns`` prunes the scan.

    Without a schema the types are inferred, at the price of one more pass over the files; a
    boolean or numeric column can then come out as text. Rows that do not fit the schema become
    nulls, and ``keep_corrupt`` keeps their raw text as ``_corrupt_record``.

    A quoted line break rules out splitting one file among tasks, so ship the reviews as many
    files, and convert them to Parquet once with ``convert_reviews``.
    """
    reader = spark.read.options(**CSV_FORMAT, mode="PERMISSIVE")
    if schema is None:
        reader = reader.option("inferSchema", True)
    else:
        if keep_corrupt:
            schema = T.StructType([*schema.fields, T.StructField(CORRUPT_COLUMN, T.StringType())])
            reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        reader = reader.schema(schema)
    rows = reader.csv(path)
    return rows.select(*columns) if columns else rows


def write_reviews_csv(rows: DataFrame, path: str) -> None:
    """CSV that ``read_reviews_csv`` restores exactly, with spaces at the ends of texts."""
    rows.write.mode("overwrite").options(
        header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)


def convert_reviews(
    spark: SparkSession,
    csv_path: str,
    parquet_path: str,
    schema: T.StructType = TRAIN_SCHEMA,
    partitions: int | None = None,
) -> DataFrame:
    """Convert CSV reviews to Parquet once; every later scan is columnar and splittable.

    A task writes what it read. ``partitions`` deals the rows anew by id, for a few CSV files with
    quoted line breaks, which cannot be split and would become as few Parquet files.
    """
    rows = read_reviews_csv(spark, csv_path, schema)
    rows = rows.repartition(partitions, "id") if partitions else rows
    rows.write.mode("overwrite").parquet(parquet_path)
    return spark.read.parquet(parquet_path)


def write_submission(predictions: DataFrame, path: str, row_id: str = "id", rating: str = "rating") -> None:
    """``(id, rating)`` as CSV with a header, one part file per task, so that no task gets all rows."""
    rows = predictions.select(F.col(row_id).alias("id"), F.col(rating).alias("rating"))
    rows.write.mode("overwrite").option("header", True).csv(path)


def read_submission(spark: SparkSession, path: str, id_type: str = "long") -> DataFrame:
    return spark.read.option("header", True).schema(f"id {id_type}, rating double").csv(path)


def metrics_frame(
    predictions: DataFrame,
    best_val_rmse: Column,
    seconds: float | None = None,
    prediction: str = "rating",
    train_rmse: Column | None = None,
) -> DataFrame:
    """One row: the best validation RMSE, the refitted model's RMSE on its own training rows where it
    is given, the run time and the nested prediction statistics."""
    stats = F.struct(
        F.min(prediction).alias("min"), F.max(prediction).alias("max"), F.avg(prediction).alias("mean")
    )
    return predictions.agg(stats.alias("prediction_stats")).select(
        best_val_rmse.alias("best_val_rmse"),
        (F.lit(None) if train_rmse is None else train_rmse).cast("double").alias("train_rmse"),
        F.lit(seconds).cast("double").alias("total_time_seconds"),
        "prediction_stats",
    )


def write_metrics(metrics: DataFrame, path: str) -> None:
    metrics.write.mode("overwrite").json(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    schema = (
        "best_val_rmse double, train_rmse double, total_time_seconds double, "
        "prediction_stats struct<min: double, max: double, mean: double>"
    )
    return spark.read.schema(schema).json(path)
