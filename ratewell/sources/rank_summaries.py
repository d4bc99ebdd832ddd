"""Quantiles that grow with new reviews: mergeable rank summaries with a proven error.

A summary is a list of points ``(value, weight)``; a value's rank is taken for the weights of all points
up to it. Thinning a list of ``n`` rows to ``m`` points keeps a value whenever the number of rows up to
it passes a multiple of ``n / m``, with the rows since the value kept before as its weight. So a rank is
never too large, and too small by less than ``n / m``. Errors of lists that are put together add up in
proportion to their rows, and each thinning adds its own.

A store has one table of points per part. A part reads its own rows only and replaces itself when it is
run again. Results depend on the rows alone, not on their order or layout.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratewell.session import scratch_path
from ratewell.sources.tables import write_table

#: Distinct values that a window sorts at a time, and lists of points that are thinned together.
BLOCK_VALUES, FAN = 1 << 20, 64


def add_part(
    rows: DataFrame,
    folder: str,
    part: str,
    value: str,
    error: float = 0.01,
    block_values: int = BLOCK_VALUES,
    fan: int = FAN,
) -> None:
    """Write the summary of ``value`` in ``rows`` as the part of that name, in place of an earlier one.

    Ranks in it are wrong by less than ``error`` times its rows. Values are first counted, so that
    a hot one is one row; blocks of ``block_values`` distinct values are thinned, then ``fan`` blocks at
    a time until one is left. Null and NaN values take no part; a part without others has no points.
    """
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", part):
        raise ValueError(f"not a name for a part: {part}")
    if not 0 < error < 1 or fan < 2 or block_values < 1:
        raise ValueError("the error lies between 0 and 1, blocks hold a value and a fan two of them")
    number = F.col(value).cast("double")
    counted = rows.select(number.alias("value")).where("value IS NOT NULL AND NOT isnan(value)")
    counted = counted.groupBy("value").agg(F.count(F.lit(1)).alias("weight"))
    counted = write_table(counted, scratch_path(rows.sparkSession, "counted-values"), "values")
    blocks = max(1, math.ceil(counted.count() / block_values))
    levels = 1
    while fan ** (levels - 1) < blocks:
        levels += 1
    points = math.ceil(levels / error)
    found = _thinned(counted.withColumn("block", F.pmod(F.xxhash64("value"), F.lit(blocks))), points)
    for _ in range(levels - 1):
        found = _thinned(found.withColumn("block", F.floor(F.col("block") / fan)), points)
    slack = F.sum("weight").over(Window.partitionBy("block")) * (levels / points)
    found = found.select("value", "weight", slack.alias("slack"), F.lit(part).alias("part_name"))
    found.write.mode("overwrite").parquet(f"{folder}/parts/part={part}")


def _thinned(lists: DataFrame, points: int) -> DataFrame:
    """At most ``points`` points of each block's ``(value, weight)`` rows."""
    added = lists.groupBy("block", "value").agg(F.sum("weight").alias("weight"))
    block = Window.partitionBy("block")
    ordered = block.orderBy("value")
    ranked = added.withColumns({"upto": F.sum("weight").over(ordered), "n": F.sum("weight").over(block)})
    step = (F.expr(f"upto * {points} div n"), F.expr(f"(upto - weight) * {points} div n"))
    kept = ranked.where(step[0] > step[1])
    weight = F.col("upto") - F.coalesce(F.lag("upto").over(ordered), F.lit(0))
    return kept.select("block", "value", weight.alias("weight"))


def _points(spark: SparkSession, folder: str, parts: list[str] | None) -> DataFrame:
    stored = spark.read.schema("value double, weight bigint, slack double, part_name string").parquet(f"{folder}/parts")
    return stored if parts is None else stored.where(F.col("part_name").isin(parts))


def quantiles(spark: SparkSession, folder: str, shares: tuple[float, ...], parts: list[str] | None = None) -> DataFrame:
    """``(share, value, n_rows, slack)`` over all parts, or over those named.

    With ``t = ceil(share * n_rows)``, at least 1: at least ``t`` rows are at most ``value``, and fewer than
    ``t + slack`` rows are below it; ``slack`` is at most the parts' errors times their rows. Without rows
    there is no row. Parts have a bounded number of points each, and only those are read and sorted.
    """
    stored = _points(spark, folder, parts)
    slack = stored.groupBy("part_name").agg(F.max("slack").alias("slack")).agg(F.sum("slack")).scalar()
    merged = stored.groupBy("value").agg(F.sum("weight").alias("weight"))
    # One window over all points: parts x points of a part.
    everything = Window.partitionBy(F.lit(0))
    ranked = merged.withColumns(
        {"upto": F.sum("weight").over(everything.orderBy("value")), "n_rows": F.sum("weight").over(everything)}
    )
    asked = F.explode(F.array(*[F.lit(float(s)) for s in shares])).alias("share")
    target = F.greatest(F.lit(1), F.ceil(F.col("share") * F.col("n_rows")))
    reached = ranked.select("value", "upto", "n_rows", asked).where(F.col("upto") >= target)
    return reached.groupBy("share", "n_rows").agg(F.min("value").alias("value")).select("share", "value", "n_rows", slack.alias("slack"))


def ranks(spark: SparkSession, folder: str, values: tuple[float, ...], parts: list[str] | None = None) -> DataFrame:
    """``(value, at_least, at_most)``: bounds of the number of rows that are at most ``value``."""
    stored = _points(spark, folder, parts)
    slack = stored.groupBy("part_name").agg(F.max("slack").alias("slack")).agg(F.coalesce(F.sum("slack"), F.lit(0.0)))
    sums = [
        F.struct(
            F.lit(float(v)).alias("value"),
            F.coalesce(F.sum(F.when(F.col("value") <= v, F.col("weight"))), F.lit(0)).alias("at_least"),
        )
        for v in values
    ]
    found = stored.agg(F.array(*sums).alias("found")).select(F.inline("found"))
    return found.withColumn("at_most", F.col("at_least") + F.floor(slack.scalar()))
