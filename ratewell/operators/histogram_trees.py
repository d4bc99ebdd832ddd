"""Boosted regression trees with exact, repeatable splits, grown from histograms.

Features are cut into bins once. A level of a tree is one grouped pass that adds up residuals per
node, feature and bin, so what the driver sees depends on the numbers of nodes, features and bins, never
on rows. Residuals are integers in units of 1e-6 of a rating: their sums don't depend on the order of
rows, and equal data give equal trees on any cluster.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewell.functions.numeric import clip_rating
from ratewell.session import scratch_path
from ratewell.sources.tables import write_table

#: Equal cells between a feature's smallest and largest value, from which bins of about equal row counts are made.
CELLS = 4096
BINS = 32
#: Integer units of a rating.
UNIT = 1_000_000
RATE = 0.3
#: Trees after which the predictions so far are written, which bounds the expression that adds them up.
STEP = 8


@dataclass
class Tree:
    """``features`` and ``cuts`` of the inner nodes, level by level; ``leaves`` in units."""

    features: list[int] = field(default_factory=list)
    cuts: list[int] = field(default_factory=list)
    leaves: list[int] = field(default_factory=list)


@dataclass
class Forest:
    columns: tuple[str, ...]
    low: list[float]
    high: list[float]
    thresholds: list[list[int]]
    base: int
    trees: list[Tree]


def _cell(name: str, low: float, high: float) -> Column:
    if not high > low:
        return F.lit(0)
    place = F.floor((F.col(name) - low) / F.lit(high - low) * CELLS)
    return F.greatest(F.lit(0), F.least(F.lit(CELLS - 1), place)).cast("int")


def fit_bins(rows: DataFrame, columns: tuple[str, ...], bins: int = BINS) -> tuple[list, list, list]:
    """``(low, high, thresholds)`` per column: a value's bin is the number of thresholds up to its cell.

    Two passes, one for the ranges and one for the counts of cells; at most ``CELLS`` numbers a column
    reach the driver. A bin starts at the first cell below which its share of the rows lies.
    """
    ends = rows.agg(*[F.min(c).alias(f"{c}_low") for c in columns], *[F.max(c).alias(f"{c}_high") for c in columns]).first()
    low, high = ([ends[f"{c}_{side}"] or 0.0 for c in columns] for side in ("low", "high"))
    cells = F.array(*[F.struct(F.lit(i).alias("feature"), _cell(c, low[i], high[i]).alias("cell")) for i, c in enumerate(columns)])
    counts = rows.select(F.inline(cells)).groupBy("feature", "cell").agg(F.count(F.lit(1)).alias("n")).collect()
    thresholds = []
    for i in range(len(columns)):
        mine = sorted((row.cell, row.n) for row in counts if row.feature == i)
        total, before, seen, found = sum(n for _, n in mine), 0, 0, []
        for cell, n in mine:
            if before * bins // total > seen:
                seen = before * bins // total
                found.append(cell)
            before += n
        thresholds.append(found)
    return low, high, thresholds


def binned(columns: tuple[str, ...], low: list[float], high: list[float], thresholds: list[list[int]]) -> Column:
    """The bins of all columns as one array of small integers."""

    def bin_of(i: int) -> Column:
        if not thresholds[i]:
            return F.lit(0)
        cell = _cell(columns[i], low[i], high[i])
        return F.aggregate(F.array(*map(F.lit, thresholds[i])), F.lit(0), lambda n, t: n + (t <= cell).cast("int"))

    return F.array(*[bin_of(i).cast("int") for i in range(len(columns))])


def _node(tree: Tree, bins: Column) -> Column:
    """The place of a row in the last level that ``tree`` has cuts for, from 0."""
    node, first = F.lit(0), 0
    while first < len(tree.cuts):
        width = first + 1
        feature, cut = (F.array(*map(F.lit, values[first : first + width])) for values in (tree.features, tree.cuts))
        node = node * 2 + (F.element_at(bins, feature[node] + 1) > cut[node]).cast("int")
        first += width
    return node


def _sum(base: Column, trees: list[Tree], bins: Column) -> Column:
    for tree in trees:
        base = base + F.array(*map(F.lit, tree.leaves))[_node(tree, bins)]
    return base


def _best(counts: dict[tuple[int, int], tuple[int, int]]) -> tuple[int, int]:
    """Feature and last bin of the left side with the largest gain; ties to the smaller feature, then bin.
    ``counts`` has rows and residuals per feature and bin; without a gain all rows go left."""
    best, choice = 0.0, (0, BINS * CELLS)
    for feature in sorted({f for f, _ in counts}):
        mine = sorted((b, n, g) for (f, b), (n, g) in counts.items() if f == feature)
        n, g = sum(row[1] for row in mine), sum(row[2] for row in mine)
        left_n = left_g = 0
        for b, row_n, row_g in mine[:-1]:
            left_n, left_g = left_n + row_n, left_g + row_g
            right_n, right_g = n - left_n, g - left_g
            gain = float(left_g) ** 2 / left_n + float(right_g) ** 2 / right_n - float(g) ** 2 / n
            if gain > best:
                best, choice = gain, (feature, b)
    return choice


def fit_forest(
    rows: DataFrame,
    columns: tuple[str, ...],
    target: str = "rating",
    trees: int = 20,
    depth: int = 4,
    bins: int = BINS,
    rate: float = RATE,
) -> Forest:
    """Squared-error boosting on ``rows``; rows without a target or with a null feature take no part.

    Bins are written once and every level reads them. The table of an empty training set gives a
    forest that predicts 0.
    """
    known = rows.select(*columns, target).dropna()
    low, high, thresholds = fit_bins(known, columns, bins)
    goal = F.round(F.col(target).cast("double") * UNIT).cast("bigint")
    folder = scratch_path(rows.sparkSession, "bins")
    table = write_table(known.select(goal.alias("_goal"), binned(columns, low, high, thresholds).alias("bins")), folder, "0")
    first = table.agg(F.sum("_goal").alias("total"), F.count(F.lit(1)).alias("n")).first()
    base = math.floor(first.total / first.n + 0.5) if first.n else 0
    forest = Forest(columns, low, high, thresholds, base, [])
    table, done = table.withColumn("fitted", F.lit(base).cast("bigint")), 0
    while len(forest.trees) < (trees if first.n else 0):
        fitted = _sum(F.col("fitted"), forest.trees[done:], F.col("bins"))
        if len(forest.trees) - done == STEP:
            table = write_table(table.withColumn("fitted", fitted), folder, str(len(forest.trees)))
            done, fitted = len(forest.trees), F.col("fitted")
        residuals = table.select("bins", (F.col("_goal") - fitted).alias("g"))
        tree = Tree()
        for level in range(depth):
            placed = residuals.select(_node(tree, F.col("bins")).alias("node"), "g", F.posexplode("bins").alias("feature", "bin"))
            sums = placed.groupBy("node", "feature", "bin").agg(F.count(F.lit(1)).alias("n"), F.sum("g").alias("g")).collect()
            leaves = []
            for node in range(1 << level):
                counts = {(row.feature, row.bin): (row.n, row.g) for row in sums if row.node == node}
                feature, cut = _best(counts)
                tree.features.append(feature)
                tree.cuts.append(cut)
                for right in (False, True):
                    side = [pair for (f, b), pair in counts.items() if f == feature and (b > cut) == right]
                    n, g = sum(n for n, _ in side), sum(g for _, g in side)
                    leaves.append(math.floor(rate * g / n + 0.5) if n else 0)
            tree.leaves = leaves
        forest.trees.append(tree)
    return forest


def forest_predict(rows: DataFrame, forest: Forest, prediction: str = "prediction") -> DataFrame:
    """Add the clipped prediction; null where a feature is null."""
    bins = binned(forest.columns, forest.low, forest.high, forest.thresholds)
    whole = F.lit(True)
    for name in forest.columns:
        whole = whole & F.col(name).isNotNull()
    none = F.array(*[F.lit(0)] * len(forest.columns))
    scored = rows.withColumns({"_whole": whole, "_bins": F.when(whole, bins).otherwise(none)})
    units = _sum(F.lit(forest.base).cast("bigint"), forest.trees, F.col("_bins"))
    return scored.withColumn(prediction, F.when(F.col("_whole"), clip_rating(units / UNIT))).drop("_bins", "_whole")


def forest_table(spark, forest: Forest) -> DataFrame:
    """``(tree, node, feature, cut, value)``: inner nodes with their column and last bin of the left side, null
    where all rows go left, and leaves with their value in rating units; nodes count from 1 as in a heap."""
    out = []
    for t, tree in enumerate(forest.trees, 1):
        for node, (feature, cut) in enumerate(zip(tree.features, tree.cuts), 1):
            split = cut < BINS * CELLS
            out.append((t, node, forest.columns[feature] if split else None, cut if split else None, None))
        out += [(t, len(tree.cuts) + 1 + i, None, None, leaf / UNIT) for i, leaf in enumerate(tree.leaves)]
    return spark.createDataFrame(out, "tree int, node int, feature string, cut int, value double")
