"""Lookup tables stored by their key, so that a join finds them in place.

The rows of a bucket lie in one file, by Spark's own hash of the key. A join on the key then shuffles
the other side into as many parts and leaves the table where it is: a statistics table is dealt once,
when it is written, and not again by every job that reads it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def write_bucketed(table: DataFrame, path: str, key: str, buckets: int, name: str | None = None) -> DataFrame:
    """Write ``table`` to ``path`` in ``buckets`` files by ``key`` and return it as stored.

    Spark keeps the layout of a table in its catalog, so the table gets a ``name`` there (a new one
    unless given); the data lie in ``path`` alone. ``buckets`` should be ``spark.sql.shuffle.partitions``
    or more: with fewer, Spark deals the table anew to use all tasks. Rows with a null key lie in one
    bucket; a lookup table has one at most.
    """
    name = name or f"lookup_{uuid.uuid4().hex}"
    dealt = table.repartition(buckets, key)
    writer = dealt.write.format("parquet").bucketBy(buckets, key).sortBy(key)
    writer.option("path", path).mode("overwrite").saveAsTable(name)
    return table.sparkSession.table(name)


def open_bucketed(
    spark: SparkSession, path: str, schema: str, key: str, buckets: int, name: str | None = None
) -> DataFrame:
    """A table that another session wrote by ``write_bucketed`` with this schema, key and number."""
    name = name or f"lookup_{uuid.uuid4().hex}"
    place = path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE `{name}` ({schema}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
        f"INTO {int(buckets)} BUCKETS LOCATION '{place}'"
    )
    return spark.table(name)
