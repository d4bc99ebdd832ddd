"""Key lookups that stay balanced when one key, or null, holds a large share of the rows.

A plain left join hashes all rows of a key, and all rows with a null key, into one task.
Here keys above a share of the rows count as hot. At most ``1 / share`` keys can reach that
share, so their lookup rows are broadcast with a proven bound. In the shuffle join that serves
all other keys, rows with a hot or null key travel under a hash of their id instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 1e-4
HOT_MIN_ROWS = 1_000_000


def rows_per_key(rows: DataFrame, key: str, name: str = "key_rows") -> DataFrame:
    """Rows per key, combined on the map side before the shuffle."""
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def hot_limit(total: Column, share: float = HOT_SHARE, min_rows: int = HOT_MIN_ROWS) -> Column:
    """Rows from which a key is hot: a share of all rows, but never fewer than ``min_rows``."""
    return F.greatest(total * F.lit(share), F.lit(float(min_rows)))


def total_rows(rows: DataFrame) -> Column:
    """The row count as a scalar subquery: a scan without columns, shared by all keys of a query."""
    return rows.agg(F.count(F.lit(1)).alias("total")).scalar()


def total_weight(counts: DataFrame, weight: str) -> Column:
    """The row count as a scalar subquery over counts per key that exist anyway."""
    return counts.agg(F.sum(weight).alias("total")).scalar()


def _packed(table: DataFrame, key: str, key_name: str, value_name: str) -> DataFrame:
    values = [F.col(c) for c in table.columns if c != key]
    return table.select(F.col(key).alias(key_name), F.struct(*values).alias(value_name))


def hot_and_cold(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    weight: str | None,
    total: Column | None,
    share: float,
    min_rows: int,
    counts: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(_hot_key, _hot)``, at most ``1 / share`` hot keys of ``rows`` with their row of ``table``,
    and ``(_cold_key, _cold)``, the other rows of ``table``.

    ``weight`` names the column of ``table`` that holds the number of ``rows`` per key, ``total``
    their sum; both results then read one aggregation. Without a weight, the keys of ``rows`` are
    counted.
    """
    table = table.filter(F.col(key).isNotNull())
    if weight:
        limit = hot_limit(total_rows(rows) if total is None else total, share, min_rows)
        hot = _packed(table.filter(F.col(weight) >= limit), key, "_hot_key", "_hot")
        return hot, _packed(table.filter(F.col(weight) < limit), key, "_cold_key", "_cold")
    counts = rows_per_key(rows.filter(F.col(key).isNotNull()), key) if counts is None else counts
    limit = hot_limit(total_weight(counts, "key_rows"), share, min_rows)
    hot_keys = counts.filter(F.col("key_rows") >= limit).select(key)
    known = _packed(table.join(F.broadcast(hot_keys), key, "left_semi"), key, "_known_key", "_hot")
    # Hot keys that the table lacks stay in the list: their rows must be spread as well.
    hot = hot_keys.join(F.broadcast(known), F.col(key) == F.col("_known_key"), "left")
    return hot.select(F.col(key).alias("_hot_key"), "_hot"), _packed(table, key, "_cold_key", "_cold")


def spread_hot_rows(rows: DataFrame, hot: DataFrame, key: str, row_id: str = "id") -> DataFrame:
    """Add ``_hot``, ``_is_cold`` and the balanced shuffle key ``_probe_key``.

    The probe key is the key itself for cold rows. Hot and null keys get a hash of the row id: it
    may equal some key by chance, so what it finds is to be ignored where ``_is_cold`` is false.
    """
    is_cold = F.col(key).isNotNull() & F.col("_hot_key").isNull()
    spread = F.hash(F.col(row_id)).cast(rows.schema[key].dataType)
    return (
        rows.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left")
        .withColumn("_is_cold", is_cold)
        .withColumn("_probe_key", F.when(F.col("_is_cold"), F.col(key)).otherwise(spread))
    )


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    weight: str | None = None,
    total: Column | None = None,
    source: DataFrame | None = None,
    share: float = HOT_SHARE,
    min_rows: int = HOT_MIN_ROWS,
    row_id: str = "id",
    counts: DataFrame | None = None,
) -> DataFrame:
    """All ``rows``, with the other columns of ``table`` (unique on ``key``); null where unknown.

    A null key matches nothing. ``source`` is the same rows before earlier lookups: hot keys are
    found there without repeating those joins. ``counts`` are its rows per key where those are
    written already.
    """
    source = rows if source is None else source
    hot, cold = hot_and_cold(source, table, key, weight, total, share, min_rows, counts)
    # The probe key is the key of cold rows, so these travel without a second copy of it.
    probe = spread_hot_rows(rows, hot, key, row_id).drop(key)
    joined = probe.join(cold, F.col("_probe_key") == F.col("_cold_key"), "left")
    own = F.when(F.col("_is_cold"), F.col("_probe_key")).otherwise(F.col("_hot_key")).alias(key)
    found = [
        F.when(F.col("_is_cold"), F.col("_cold")[c]).otherwise(F.col("_hot")[c]).alias(c)
        for c in table.columns
        if c != key
    ]
    return joined.select(*[own if c == key else c for c in rows.columns], *found)


def join_on_id(left: DataFrame, right: DataFrame, row_id: str = "id") -> DataFrame:
    """Inner join of two frames that are unique on the row id (embeddings, predictions)."""
    return left.join(right, row_id, "inner")


def join_matched(left: DataFrame, right: DataFrame, row_id: str = "id", strict: bool = False) -> DataFrame:
    """All rows of ``left``, with the columns of ``right`` (unique on the id), null where it has none, and
    ``matched``. With ``strict`` ids that only one side has are an error instead, as they are where
    rows are aligned by position."""
    if strict:
        require_alignment(left, right, row_id)
    found = left.join(right.withColumn("matched", F.lit(True)), row_id, "left")
    return found.withColumn("matched", F.coalesce("matched", F.lit(False)))


def alignment(left: DataFrame, right: DataFrame, row_id: str = "id") -> DataFrame:
    """One row: size of both sides, ids they share, and ids found on one side only."""
    sides = left.select(row_id, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(row_id, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    per_id = sides.groupBy(row_id).agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    both = (F.col("l") > 0) & (F.col("r") > 0)
    return per_id.agg(
        F.coalesce(F.sum("l"), F.lit(0)).alias("left_rows"),
        F.coalesce(F.sum("r"), F.lit(0)).alias("right_rows"),
        F.count_if(both).alias("shared_ids"),
        F.count_if(F.col("r") == 0).alias("left_only_ids"),
        F.count_if(F.col("l") == 0).alias("right_only_ids"),
    )


def require_alignment(left: DataFrame, right: DataFrame, row_id: str = "id") -> None:
    """Fail unless both frames hold the same ids once each, so that an inner join loses no row."""
    found = alignment(left, right, row_id).first()
    if not found["left_rows"] == found["right_rows"] == found["shared_ids"]:
        raise ValueError(f"ids differ: {found.asDict()}")


def product_metadata_join(reviews: DataFrame, products: DataFrame, key: str = "parent_prod_id") -> DataFrame:
    """Reviews with the category and price of their parent product, null where it is not listed."""
    return lookup_join(reviews, products, key)
