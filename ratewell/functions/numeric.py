"""Numeric columns: counts, votes, flags, clipping, priors and blending."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratewell.schemas import RATING_MAX, RATING_MIN


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def log_count(count: str | Column) -> Column:
    return F.log1p(_col(count).cast("double"))


def votes_log(votes: str | Column = "votes") -> Column:
    """``log1p(max(votes, 0))``; null votes count as 0."""
    return F.log1p(F.greatest(F.coalesce(_col(votes), F.lit(0)), F.lit(0)).cast("double"))


def votes_filled(votes: str | Column = "votes") -> Column:
    return F.coalesce(_col(votes).cast("double"), F.lit(0.0))


def purchased_flag(purchased: str | Column = "purchased") -> Column:
    """1.0 for true, 0.0 for false and for null."""
    return F.coalesce(_col(purchased).cast("double"), F.lit(0.0))


def fill_prior(value: str | Column, prior: Column) -> Column:
    return F.coalesce(_col(value), prior)


def conditional_prior(value: Column, count: str | Column, prior: Column) -> Column:
    """``value`` where the group holds more than one row, else the prior."""
    return F.when(_col(count) > 1, value).otherwise(prior)


def clip_rating(value: str | Column, lo: float = RATING_MIN, hi: float = RATING_MAX) -> Column:
    """Bound a prediction. ``greatest``/``least`` skip nulls and order NaN above all numbers,
    so both are passed through explicitly."""
    x = _col(value).cast("double")
    return F.when(x.isNull() | F.isnan(x), x).otherwise(F.greatest(F.lit(lo), F.least(F.lit(hi), x)))


def blend(a: str | Column, b: str | Column, weight: float | Column) -> Column:
    """``weight * a + (1 - weight) * b``, clipped."""
    w = weight if isinstance(weight, Column) else F.lit(float(weight))
    return clip_rating(w * _col(a) + (F.lit(1.0) - w) * _col(b))
