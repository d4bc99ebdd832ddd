"""Leave-one-out target encoding of training rows, and lookups for other rows.

Rules: the count is that of non-null targets; a group of one, a null target or a null key
gives the prior; a null or unseen key has count 0.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewell.functions.numeric import fill_prior, log_count, purchased_flag, votes_filled, votes_log
from ratewell.operators.joins import (
    HOT_MIN_ROWS,
    HOT_SHARE,
    hot_and_cold,
    lookup_join,
    spread_hot_rows,
    total_rows,
    total_weight,
)
from ratewell.operators.stats import key_totals, prior_of, written_counts, written_totals
from ratewell.schemas import KEY_PREFIXES
from ratewell.session import scratch_path
from ratewell.sources.tables import drop_table, write_table


def _totals(
    source: DataFrame, key: str, target: str, written: DataFrame | None
) -> tuple[DataFrame, Column]:
    """The totals of a key and the number of rows, from written totals if there are any."""
    totals = key_totals(source, key, target) if written is None else written
    total = total_rows(source) if written is None else total_weight(written, "row_count")
    return totals.select(key, "rating_sum", "rating_count", "row_count"), total


def _loo_columns(total: Column, count: Column, target: str, prior: Column, prefix: str) -> list[Column]:
    count = F.coalesce(count, F.lit(0).cast("bigint"))
    others = F.when(count > 1, (total - F.col(target)) / (count - 1))
    return [
        fill_prior(others, prior).alias(f"{prefix}_loo_avg"),
        count.alias(f"{prefix}_cnt"),
        log_count(count).alias(f"{prefix}_log_cnt"),
    ]


def loo_encode(
    rows: DataFrame,
    key: str,
    target: str = "rating",
    prior: Column | None = None,
    prefix: str | None = None,
    source: DataFrame | None = None,
    totals: DataFrame | None = None,
    share: float = HOT_SHARE,
    min_rows: int = HOT_MIN_ROWS,
) -> DataFrame:
    """Each row's mean target over the *other* rows of its key, by aggregate and lookup join.

    Only ``(key, sum, count)`` partials and the columns of ``rows`` shuffle; project ``rows`` to
    ids, keys and numbers first, so that texts stay where they are. ``source`` is the same rows
    before earlier encodings, so that the totals' scan reads the key and the target alone;
    ``totals`` are their ``key_totals`` where those are written already.
    """
    source = rows if source is None else source
    prior = prior_of(source, target) if prior is None else prior
    totals, total = _totals(source, key, target, totals)
    joined = lookup_join(rows, totals, key, "row_count", total, source, share, min_rows)
    encoded = _loo_columns(F.col("rating_sum"), F.col("rating_count"), target, prior, prefix or key)
    return joined.select(*rows.columns, *encoded)


def loo_encode_window(
    rows: DataFrame,
    key: str,
    target: str = "rating",
    prior: Column | None = None,
    prefix: str | None = None,
    source: DataFrame | None = None,
    totals: DataFrame | None = None,
    share: float = HOT_SHARE,
    min_rows: int = HOT_MIN_ROWS,
    full_frame: bool = False,
) -> DataFrame:
    """The same encoding by a window over the key, with an explicit full frame on request.

    A window takes a whole key into one task and shuffles whole rows, so hot keys get their
    totals by a bounded broadcast and leave the key's window; null keys are spread as well.
    """
    source = rows if source is None else source
    prior = prior_of(source, target) if prior is None else prior
    totals, total = _totals(source, key, target, totals)
    hot, _ = hot_and_cold(source, totals, key, "row_count", total, share, min_rows)
    probe = spread_hot_rows(rows, hot, key)
    window = Window.partitionBy("_is_cold", "_probe_key")
    if full_frame:
        window = window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    framed = probe.withColumn("_wsum", F.sum(target).over(window)).withColumn(
        "_wcnt", F.count(target).over(window)
    )
    total = F.when(F.col("_is_cold"), F.col("_wsum")).otherwise(F.col("_hot")["rating_sum"])
    count = F.when(F.col("_is_cold"), F.col("_wcnt")).otherwise(F.col("_hot")["rating_count"])
    return framed.select(*rows.columns, *_loo_columns(total, count, target, prior, prefix or key))


def loo_all_keys(
    rows: DataFrame,
    keys: dict[str, str] = KEY_PREFIXES,
    target: str = "rating",
    prior: Column | None = None,
    totals: dict[str, DataFrame] | None = None,
    encoder: Callable[..., DataFrame] = loo_encode,
    folder: str | None = None,
    earlier: str | None = None,
) -> DataFrame:
    """Leave-one-out columns of every key on each row, by either encoder; ``totals`` maps a key to
    its ``key_totals`` where those are written already.

    With ``folder``, rows are written there after each key but the last, and deleted when the next key's
    are, so that one key's shuffles are on disk at a time. ``earlier`` names the table there that ``rows``
    are read from, if it is to go likewise; ``totals`` and ``prior`` must not need it.
    """
    if totals is None:
        # Totals of all keys, the prior and the number of rows by one scan, written for all readers.
        totals, mean = written_totals(rows, scratch_path(rows.sparkSession, "totals"), tuple(keys), target)
        prior = mean if prior is None else prior
    prior = prior_of(rows, target) if prior is None else prior
    encoded = rows
    for place, (key, prefix) in enumerate(keys.items(), 1):
        encoded = encoder(encoded, key, target, prior, prefix, rows, totals[key])
        if folder is not None and place < len(keys):
            encoded = write_table(encoded, folder, f"by-{prefix}")
            if earlier:
                drop_table(rows.sparkSession, folder, earlier)
            earlier = f"by-{prefix}"
    return encoded


def apply_stats(
    rows: DataFrame,
    stats: DataFrame,
    key: str,
    prefix: str,
    prior: Column,
    source: DataFrame | None = None,
    share: float = HOT_SHARE,
    min_rows: int = HOT_MIN_ROWS,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Attach ``(key, {prefix}_avg, {prefix}_cnt)``: unseen and null keys get the prior and 0.
    ``source`` is the same rows before earlier lookups, ``counts`` their written rows per key."""
    avg, cnt = F.col(f"{prefix}_avg"), F.coalesce(F.col(f"{prefix}_cnt"), F.lit(0).cast("bigint"))
    joined = lookup_join(rows, stats, key, source=source, share=share, min_rows=min_rows, counts=counts)
    return joined.select(
        *rows.columns,
        fill_prior(avg, prior).alias(f"{prefix}_avg"),
        cnt.alias(f"{prefix}_cnt"),
        log_count(cnt).alias(f"{prefix}_log_cnt"),
    )


def apply_all_stats(
    rows: DataFrame, stats: dict[str, DataFrame], prior: Column, keys: dict[str, str] = KEY_PREFIXES
) -> DataFrame:
    """``apply_stats`` for every key; ``stats`` maps a key to its lookup table. One scan counts the
    keys of ``rows``, and the written counts tell each lookup which of its keys are hot."""
    counts = written_counts(rows, scratch_path(rows.sparkSession, "counts"), tuple(keys))
    applied = rows
    for key, prefix in keys.items():
        applied = apply_stats(applied, stats[key], key, prefix, prior, counts=counts[key])
    return applied


def distinct_lookup(encoded: DataFrame, key: str, prefix: str) -> DataFrame:
    """The distinct ``(key, avg, cnt)`` that a set of encoded rows uses."""
    return encoded.select(key, f"{prefix}_avg", f"{prefix}_cnt").distinct()


def numeric_features(
    encoded: DataFrame,
    keep: tuple[str, ...] = ("id",),
    average: str = "loo_avg",
    log_votes: bool = False,
    keys: dict[str, str] = KEY_PREFIXES,
) -> DataFrame:
    """The eight numeric features: purchased, votes, then mean and log count of each key.

    ``average`` is ``loo_avg`` for training rows and ``avg`` for rows encoded by lookup; both
    come out under the lookup's names, so that one model reads either.
    """
    votes = votes_log() if log_votes else votes_filled()
    columns = [purchased_flag().alias("purchased"), votes.alias("votes")]
    for prefix in keys.values():
        columns += [
            F.col(f"{prefix}_{average}").alias(f"{prefix}_avg"),
            F.col(f"{prefix}_log_cnt"),
        ]
    return encoded.select(*keep, *columns)
