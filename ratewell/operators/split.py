"""Reproducible splits. Membership is decided row by row from a seeded hash of the row id, so
rows never shuffle, and a split is the same under any partitioning. Ids must be unique."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewell.functions.hashing import split_bucket, split_hash
from ratewell.schemas import SPLIT_SEED
from ratewell.session import scratch_path
from ratewell.sources.tables import write_table

PREFIX_DIGITS = (3, 7)
PAST_ALL_HASHES = "g"


def fraction_split(
    rows: DataFrame, percent: int = 80, seed: int = SPLIT_SEED, row_id: str = "id"
) -> DataFrame:
    """Add ``split``: about ``percent`` of the rows are ``train``, the others ``val``."""
    in_train = split_bucket(row_id, seed) < percent
    return rows.withColumn("split", F.when(in_train, "train").otherwise("val"))


def _edge(hashes: DataFrame, digits: int, n: int, before: Column) -> Column:
    """``(bucket, before)``: the first hex digits of the n-th smallest hash, and how many hashes have
    smaller ones, as a scalar subquery; null if there are fewer than n."""
    histogram = hashes.groupBy(F.substring("hash", 1, digits).alias("bucket")).agg(F.count(F.lit(1)).alias("size"))
    running = histogram.withColumn("upto", before + F.sum("size").over(Window.orderBy("bucket")))
    found = F.struct("bucket", (F.col("upto") - F.col("size")).alias("before"))
    return running.filter(F.col("upto") >= n).agg(F.min_by(found, "bucket")).scalar()


def nth_hashes(rows: DataFrame, places: list[int], seed: int = SPLIT_SEED, row_id: str = "id") -> list[Column]:
    """The n-th smallest row hash for each n as a scalar subquery; a bound above all hashes if there are
    fewer, and one below all for n = 0.

    A global sort or limit would pass its rows through one task. Instead, one histogram over the
    first three hex digits (4,096 entries, few enough to combine well in every task) finds the
    buckets that hold the hashes sought. A second pass over the rows writes the hashes of those
    buckets, one in 4,096 for each n. Of these, a histogram over the next four digits divides a
    bucket, and only the hashes that share all seven digits, one in 268 million, are ranked.
    """
    hashes = rows.select(split_hash(row_id, seed).alias("hash")).filter(F.col("hash").isNotNull())
    first, second = PREFIX_DIGITS
    histogram = hashes.groupBy(F.substring("hash", 1, first).alias("bucket")).agg(F.count(F.lit(1)).alias("size"))
    # At most 4,096 rows, bounded by the digits.
    sizes = sorted(histogram.collect())
    edges, before = {}, 0
    for bucket, size in sizes:
        edges |= {n: (bucket, before) for n in places if before < n <= before + size}
        before += size
    inside = hashes.filter(F.substring("hash", 1, first).isin(sorted({bucket for bucket, _ in edges.values()})))
    if edges:
        inside = write_table(inside, scratch_path(rows.sparkSession, "split"), "hashes.parquet")

    def bound(n: int) -> Column:
        if n <= 0:
            return F.lit("")
        if n not in edges:
            return F.lit(PAST_ALL_HASHES)
        bucket, before = edges[n]
        mine = inside.filter(F.col("hash").startswith(bucket))
        edge = _edge(mine, second, n, F.lit(before))
        ranked = mine.filter(F.col("hash").startswith(edge["bucket"])).withColumn(
            "rank", edge["before"] + F.row_number().over(Window.orderBy("hash"))
        )
        return ranked.filter(F.col("rank") == n).agg(F.min("hash")).scalar()

    return [bound(n) for n in places]


def holdout_split(
    rows: DataFrame,
    n_val: int,
    n_train: int | None = None,
    seed: int = SPLIT_SEED,
    row_id: str = "id",
) -> DataFrame:
    """Add ``split``: exactly ``n_val`` rows ``val``, the next ``n_train`` (or all others) ``train``,
    and null for rows past the training subset. Both bounds come from the same two passes."""
    row_hash = split_hash(row_id, seed)
    val, *train = nth_hashes(rows, [n_val] + ([] if n_train is None else [n_val + n_train]), seed, row_id)
    split = F.when(row_hash <= val, "val")
    split = split.when(row_hash <= train[0], "train") if train else split.otherwise("train")
    return rows.withColumn("split", split)


def subset_sample(rows: DataFrame, n: int, seed: int = SPLIT_SEED, row_id: str = "id") -> DataFrame:
    """Exactly ``n`` rows, or all if there are fewer: a seeded sample without replacement."""
    return rows.filter(split_hash(row_id, seed) <= nth_hashes(rows, [n], seed, row_id)[0])
