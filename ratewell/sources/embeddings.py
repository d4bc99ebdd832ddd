"""A Parquet store of embeddings by row id, filled with the missing ids only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ratewell.session import scratch_path
from ratewell.sources.tables import write_table

def read_store(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored ``(id, embedding)``, or None if nothing was stored yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def missing_ids(rows: DataFrame, store: DataFrame, row_id: str = "id") -> DataFrame:
    """Ids whose embedding is not stored. Only ids are read and shuffled."""
    return rows.select(row_id).join(store.select(row_id), row_id, "left_anti")


def missing_rows(rows: DataFrame, store: DataFrame | None, row_id: str = "id") -> DataFrame:
    """Rows whose embedding is not stored; Spark broadcasts the missing ids if their size allows it."""
    if store is None:
        return rows
    missing = write_table(
        missing_ids(rows, store, row_id), scratch_path(rows.sparkSession, "missing"), "ids.parquet"
    )
    return rows.join(missing, row_id, "left_semi")


def update_store(
    rows: DataFrame,
    path: str,
    encode: Callable[[DataFrame], DataFrame],
    row_id: str = "id",
) -> DataFrame:
    """Encode and append the rows that the store lacks; return the whole store.

    A failed job commits nothing, so running it again encodes what is still missing.
    """
    spark = rows.sparkSession
    missing = missing_rows(rows, read_store(spark, path), row_id)
    encode(missing).write.mode("append").parquet(path)
    return spark.read.parquet(path)
