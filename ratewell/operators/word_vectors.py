"""Word vectors trained from co-occurrence counts, all in tables: no vocabulary on the driver.

Positive pointwise mutual information of neighbouring words is a sparse symmetric matrix, kept as rows
``(word, other, weight)``. Its leading eigenvectors come by block power iteration: a product with
the matrix is a join and a grouped sum, and a block of ``dim`` columns is made orthonormal through its
``dim`` x ``dim`` matrix of inner products, the only thing that reaches the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewell.functions.hashing import hex_prefix
from ratewell.functions.text import word_tokens
from ratewell.operators.joins import lookup_join, rows_per_key, total_weight
from ratewell.operators.text import token_counts
from ratewell.session import scratch_path
from ratewell.sources.tables import drop_table, write_table

WINDOW = 2
#: Parts in which a matrix is multiplied.
SLICES = 4


def cooccurrences(
    rows: DataFrame, text: str = "text", window: int = WINDOW, min_count: int = 2, folder: str | None = None
) -> DataFrame:
    """``(word, other, n)``: how often two words stand at most ``window`` places apart in a text, in either
    order; words of fewer than ``min_count`` occurrences are left out after counting distances.

    Pairs of a text's shifted word list are counted on the map side, in the order of the two words, so that
    one row stands for both directions until they are read. Rare words leave the counted pairs, not the
    texts. Each of the three shuffles of pairs is written and gone before the next one; ``folder`` gets what
    is read in the end, and a new scratch folder if none is named.
    """
    spark = rows.sparkSession
    folder = scratch_path(spark, "cooccurrences") if folder is None else folder
    words = rows.select(word_tokens(text).alias("w"))
    ahead = []
    for gap in range(1, window + 1):
        n = F.greatest(F.size("w") - gap, F.lit(0))
        ahead.append(F.arrays_zip(F.slice("w", F.lit(1), n).alias("word"), F.slice("w", F.lit(gap + 1), n).alias("other")))
    pairs = words.select(F.inline(F.concat(*ahead)))
    pairs = pairs.select(F.least("word", "other").alias("word"), F.greatest("word", "other").alias("other"))
    counted = write_table(pairs.groupBy("word", "other").agg(F.count(F.lit(1)).alias("n")), folder, "counted")
    often = token_counts(rows, text).filter(F.col("token_count") >= min_count)
    often = write_table(often.select("token"), folder, "often")
    for side in ("word", "other"):
        found = counted.join(often.select(F.col("token").alias(side)), side, "left_semi")
        counted = write_table(found.select("word", "other", "n"), folder, f"often-{side}")
        drop_table(spark, folder, "counted" if side == "word" else "often-word")
    return _both_ways(counted, F.col("n") * F.when(F.col("word") == F.col("other"), 2).otherwise(1))


def _both_ways(pairs: DataFrame, n: Column, **weights: tuple[Column, Column]) -> DataFrame:
    """``(word, other, n, *weights)`` in both directions of each pair, where a word beside itself has one. ``weights``
    are columns by name, for the pair as it stands and for its reverse."""
    there = F.struct("word", "other", n.alias("n"), *[a.alias(name) for name, (a, _) in weights.items()])
    back = F.struct(
        F.col("other").alias("word"), F.col("word").alias("other"), n.alias("n"), *[b.alias(name) for name, (_, b) in weights.items()]
    )
    return pairs.select(F.inline(F.when(F.col("word") == F.col("other"), F.array(there)).otherwise(F.array(there, back))))


def positive_information(pairs: DataFrame, folder: str | None = None) -> DataFrame:
    """``(word, other, n, weight)``: ``ln(n * N / (n_word * n_other))`` where it is positive; ``pairs`` is written.

    The counts are symmetric, so one table of word totals serves both sides, and one direction of each
    pair meets them. Frequent words have a row per neighbour; they take the hot-key path of the lookup
    join. Each of the two lookups is written; what is returned reads the second without a shuffle. ``folder``
    gets it, and a new scratch folder if none is named.
    """
    spark = pairs.sparkSession
    folder = scratch_path(spark, "information") if folder is None else folder
    totals = pairs.groupBy("word").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("rows"))
    totals = write_table(totals, folder, "totals")
    every, rows = total_weight(totals, "total").cast("double"), total_weight(totals, "rows")
    found = lookup_join(pairs.filter("word <= other"), totals, "word", "rows", rows, row_id="other")
    found = write_table(found.withColumnRenamed("total", "of_word").drop("rows"), folder, "of-word")
    of_other = totals.withColumnRenamed("word", "other").withColumnRenamed("total", "of_other")
    found = lookup_join(found, of_other, "other", "rows", rows, row_id="word").drop("rows")
    together = F.col("n").cast("double") * every
    weight = F.log(together / F.col("of_word") / F.col("of_other"))
    back = F.log(together / F.col("of_other") / F.col("of_word"))
    found = write_table(found.filter((weight > 0) | (back > 0)), folder, "of-both")
    drop_table(spark, folder, "of-word")
    return _both_ways(found, F.col("n"), weight=(weight, back)).filter(F.col("weight") > 0)


def _signs(dim: int) -> list[Column]:
    """1 or -1 per dimension, by the digits of the word's hash."""
    return [F.when(hex_prefix(F.md5(F.concat(F.lit(f"{j}:"), F.col("word"))), 4) % 2 == 0, 1.0).otherwise(-1.0) for j in range(dim)]


def starting_block(matrix: DataFrame, dim: int) -> DataFrame:
    """``(word, v0, v1, ...)``: signs that depend on the word alone."""
    words = matrix.select("word").distinct()
    return words.select("word", *[sign.alias(f"v{j}") for j, sign in enumerate(_signs(dim))])


def multiplied(matrix: DataFrame, block: DataFrame, dim: int, folder: str | None = None) -> DataFrame:
    """The product of the matrix with a block, written to ``folder`` or a new scratch folder; both are written.
    Sums are combined before they move, and the matrix meets the block in ``SLICES`` parts by the second
    word, one after the other."""
    spark = matrix.sparkSession
    folder = scratch_path(spark, "product") if folder is None else folder
    by_other = block.withColumnRenamed("word", "other")
    counts = write_table(rows_per_key(matrix.filter(F.col("other").isNotNull()), "other"), folder, "counts")
    names = [f"v{j}" for j in range(dim)]
    slice_of = F.coalesce(F.pmod(F.xxhash64("other"), F.lit(SLICES)), F.lit(0))
    parts = None
    for k in range(SLICES):
        found = lookup_join(matrix.filter(slice_of == k), by_other, "other", row_id="word", counts=counts)
        sums = found.groupBy("word").agg(*[F.sum(F.col("weight") * F.col(name)).alias(name) for name in names])
        part = write_table(sums, folder, f"slice-{k}")
        parts = part if parts is None else parts.unionByName(part)
    product = write_table(parts.groupBy("word").agg(*[F.sum(name).alias(name) for name in names]), folder, "product")
    for name in ("counts", *[f"slice-{k}" for k in range(SLICES)]):
        drop_table(spark, folder, name)
    return product


def orthonormal(block: DataFrame, dim: int) -> tuple[DataFrame, np.ndarray]:
    """The block times the inverse of its triangular factor, and that factor's diagonal. Columns that depend on
    earlier ones up to rounding become zero."""
    products = [F.sum(F.col(f"v{i}") * F.col(f"v{j}")).alias(f"p{i}_{j}") for i in range(dim) for j in range(i + 1)]
    row = block.agg(*products).first()
    gram = np.array([[row[f"p{max(i, j)}_{min(i, j)}"] or 0.0 for j in range(dim)] for i in range(dim)])
    factor, inverse = np.zeros((dim, dim)), np.zeros((dim, dim))
    for j in range(dim):
        # Column j of the result is column j of the block less its parts along the earlier results.
        along = inverse.T @ gram[:, j]
        rest = gram[j, j] - along @ along
        if rest > 1e-12 * max(gram[j, j], 1e-300):
            unit = np.eye(dim)[j] - inverse @ along
            inverse[:, j] = unit / np.sqrt(rest)
            factor[j, j] = np.sqrt(rest)
    columns = []
    for j in range(dim):
        total = F.lit(0.0)
        for i in range(j + 1):
            if inverse[i, j]:
                total = total + F.col(f"v{i}") * float(inverse[i, j])
        columns.append(total.alias(f"v{j}"))
    return block.select("word", *columns), factor.diagonal()


def word_vectors(
    rows: DataFrame, dim: int = 16, steps: int = 4, text: str = "text", window: int = WINDOW, min_count: int = 2
) -> DataFrame:
    """``(word, embedding)``, written: places of the words along the leading eigenvectors of the information
    matrix, each axis stretched by the square root of its eigenvalue.

    ``steps`` products with the matrix; every step's block is written, so that a lost executor costs one
    step, and what no later step reads is deleted. Vectors depend on the texts alone, up to rounding. Texts without pairs of words, or an
    empty table, give no vectors.
    """
    spark, folder = rows.sparkSession, scratch_path(rows.sparkSession, "word-vectors")
    pairs = cooccurrences(rows, text, window, min_count, f"{folder}/pairs")
    matrix = positive_information(pairs, f"{folder}/matrix").select("word", "other", "weight")
    drop_table(spark, folder, "pairs")
    block, scale = write_table(starting_block(matrix, dim), folder, "block-0"), np.ones(dim)
    for step in range(1, steps + 1):
        product = multiplied(matrix, block, dim, f"{folder}/step-{step}")
        orthogonal, scale = orthonormal(product, dim)
        block = write_table(orthogonal, folder, f"block-{step}")
        for name in (f"step-{step}", f"block-{step - 1}"):
            drop_table(spark, folder, name)
    stretched = [F.col(f"v{j}") * float(np.sqrt(scale[j])) for j in range(dim)]
    vectors = write_table(block.select("word", F.array(*stretched).alias("embedding")), folder, "vectors")
    for name in ("matrix", f"block-{steps}"):
        drop_table(spark, folder, name)
    return vectors


def text_vectors(rows: DataFrame, vectors: DataFrame, dim: int, row_id: str = "id", text: str = "text") -> DataFrame:
    """``(id, embedding)``: the mean vector of each text's known words, counted with repetition; a text without
    any has a zero vector. Words are counted per text before they meet their vectors, and sums move as
    one row per text and task. The counts are written for as long as the sums read them."""
    spark, folder = rows.sparkSession, scratch_path(rows.sparkSession, "text-vectors")
    counts = rows.select(row_id, F.explode(word_tokens(text)).alias("word")).groupBy(row_id, "word").agg(F.count(F.lit(1)).alias("n"))
    counts = write_table(counts, folder, "counts")
    found = lookup_join(counts, vectors, "word", row_id=row_id).filter(F.col("embedding").isNotNull())
    sums = [F.sum(F.col("embedding")[j] * F.col("n")).alias(f"s{j}") for j in range(dim)]
    pooled = found.groupBy(row_id).agg(F.sum("n").alias("n"), *sums)
    pooled = pooled.select(row_id, F.array(*[(F.col(f"s{j}") / F.col("n")).cast("float") for j in range(dim)]).alias("embedding"))
    pooled = write_table(pooled, folder, "pooled")
    drop_table(spark, folder, "counts")
    zeros = F.array_repeat(F.lit(0.0).cast("float"), dim)
    return rows.select(row_id).join(pooled, row_id, "left").select(row_id, F.coalesce("embedding", zeros).alias("embedding"))
