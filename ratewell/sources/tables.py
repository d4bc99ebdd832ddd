"""Lookup tables of the feature job, one Parquet folder each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from ratewell.session import shuffles_released

PRIOR_TABLE = "global_avg.parquet"


def write_table(table: DataFrame, folder: str, name: str) -> DataFrame:
    """Write (replacing an older one) and return the written table, which cuts the lineage. The write's
    shuffle files go with it, so that a plan of several tables has the disk of one step at a time."""
    path = f"{folder}/{name}"
    with shuffles_released(table.sparkSession):
        table.write.mode("overwrite").parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def drop_table(spark: SparkSession, folder: str, name: str) -> None:
    """Delete a written table that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}")


def write_prior(prior: DataFrame, folder: str) -> Column:
    """Persist the one-row global mean and return it as a scalar subquery on the written value."""
    return write_table(prior, folder, PRIOR_TABLE).scalar()


def read_prior(spark: SparkSession, folder: str) -> Column:
    return read_table(spark, folder, PRIOR_TABLE).scalar()
