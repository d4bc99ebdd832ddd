"""Helpers that several operators share."""

from __future__ import annotations

import sys
import types

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratewell.session import scratch_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def saved(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared scratch folder: cuts the lineage and survives a lost executor."""
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def release(frame: DataFrame) -> None:
    """Delete the files of a ``saved`` frame that nothing reads any more."""
    spark = frame.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for folder in {path.rsplit("/", 1)[0] for path in frame.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def placed(rows: DataFrame, order: list[str], key: str | None = None) -> DataFrame:
    """``rows`` with ``place``, from 1, in ascending ``order`` (null first) within each non-null ``key``, or
    among all rows; written.

    Rows are dealt by ranges of key and order, equal ones by their place in the input, so that one key
    or one value may have any share of them. A key spans several ranges only as the last of one and
    the first of the next, so at most one offset per range has to be known elsewhere.
    """
    keys = [key] if key else []
    rows = rows.withColumn("_tie", F.monotonically_increasing_id())
    by = [F.col(c).asc_nulls_first() for c in (*keys, *order, "_tie")]
    dealt = rows.repartitionByRange(*by).withColumn("_part", F.spark_partition_id())
    inside = Window.partitionBy(*keys, "_part").orderBy(*by[len(keys) :])
    dealt = saved(dealt.withColumn("place", F.row_number().over(inside).cast("bigint")).drop("_tie"), "placed")
    sizes = dealt.groupBy(*keys, "_part").agg(F.max("place").alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_before", F.sum("_n").over(earlier)).where(F.col("_before") > 0).drop("_n")
    found = dealt.join(F.broadcast(offsets), [*keys, "_part"], "left")
    place = (F.col("place") + F.coalesce("_before", F.lit(0))).alias("place")
    return found.select(*[c for c in dealt.columns if c not in ("place", "_part")], place)


def remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus


def majority_labels(labels: DataFrame, column: str) -> DataFrame:
    """``(doc_id, label)``, one row per document: 1 if at least half of its non-null labels are 1."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull())
    share = F.avg(F.col(column).cast("double"))
    return known.groupBy("doc_id").agg((share >= 0.5).cast("int").alias("label"))


def platt(margins: DataFrame, margin: str = "margin", label: str = "label") -> tuple[float, float]:
    """Slope and intercept of a logistic curve through (margin, label), each class with half of the weight.

    All rows count: they are reduced to a histogram of at most 2 x 401 cells, margins beyond the
    middle 400 cells in the end cells, and the curve is fitted to the cells.
    """
    import numpy as np

    spread = margins.agg(F.avg(margin), F.stddev_pop(margin)).first()
    centre, scale = spread[0] or 0.0, max(spread[1] or 0.0, 1e-9)
    cell = F.greatest(F.lit(-200), F.least(F.lit(200), F.round((F.col(margin) - centre) / scale * 40))).cast("int")
    cells = margins.groupBy(cell.alias("cell"), label).count().collect()
    x = np.array([row[0] / 40 for row in cells], float)
    y = np.array([row[1] for row in cells], float)
    n = np.array([row[2] for row in cells], float)
    if not n[y == 1].sum() or not n[y == 0].sum():
        return 1.0, 0.0
    weight = np.where(y == 1, n / n[y == 1].sum(), n / n[y == 0].sum()) / 2
    design, theta = np.stack([x, np.ones_like(x)]), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(theta @ design, -30, 30)))
        # A slight pull towards zero keeps the slope finite when a threshold separates the classes.
        gradient = design @ (weight * (p - y)) + 1e-3 * theta
        hessian = (design * (weight * p * (1 - p))) @ design.T + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        theta -= step
        if abs(step).max() < 1e-9:
            break
    return float(theta[0] / scale), float(theta[1] - theta[0] * centre / scale)


def worker_cache(name: str) -> dict:
    """A dictionary that lives as long as the Python worker, so that later tasks find it filled.

    Task functions travel by value, so their own globals start anew in each task.
    """
    module = sys.modules.setdefault("_ratewell_worker", types.ModuleType("_ratewell_worker"))
    return module.__dict__.setdefault(name, {})


def text_blocks(texts, size: int):
    """``(first text, slice)`` of an Arrow array of texts, about ``size`` bytes each, a longer text on its own.
    Null texts have no bytes."""
    import numpy as np
    import pyarrow.compute as pc

    upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        before = upto[start - 1] if start else 0
        stop = max(int(np.searchsorted(upto, before + size, "right")), start + 1)
        yield start, texts.slice(start, stop - start)
        start = stop


def text_slices(batches, size: int):
    """Slices of Arrow batches with a ``text`` column, by ``text_blocks``. A batch of Spark's holds thousands of
    texts; a task that turns them into Python strings and arrays a slice at a time needs memory for
    little more than the batch itself, and its results leave in small batches too."""
    for batch in batches:
        for first, texts in text_blocks(batch.column("text"), size):
            yield batch.slice(first, len(texts))


def in_blocks(encode, texts: list[str], size: int = 1 << 20):
    """Encode texts in blocks of about ``size`` characters, a longer text on its own."""
    start = chars = 0
    for stop, text in enumerate(texts, 1):
        chars += len(text)
        if chars >= size or stop == len(texts):
            yield from encode(texts[start:stop])
            start, chars = stop, 0
