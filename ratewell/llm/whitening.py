"""Embedding whitening: covariances from exact variances of sums of two dimensions."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewell.llm.common import saved

#: Steps of the grid that entries are rounded down to, per unit.
SCALE = 256
#: Vectors that a task sums up at a time.
BLOCK = 4096
#: Bits of the low part of a large sum; both parts are summed as decimals.
LOW = 60
#: An eigenvalue below this share of the largest, per dimension, is rounding only and no component.
RANK = 1e-12


@dataclass
class Whitening:
    """What whitening a vector x needs: ``n``, the integer sums, eigenvalues and unit eigenvectors by falling
    eigenvalue, and the trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float


def gridded(rows: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(vec_id, x)`` with the entries as integers on the grid. Out are vectors that are null, empty or hold
    a null or non-finite entry, and those of another width than most; entries beyond 64 bits are put
    at the bound. Null and repeated ids stay."""
    values = F.col(vector).cast("array<double>")
    rows = rows.select(F.col(key).alias("vec_id"), values.alias("embedding"))
    finite = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = rows.where(finite & (F.size("embedding") > 0))
    most = rows.groupBy(F.size("embedding").alias("width")).count().orderBy(F.desc("count"), "width").first()
    rows = rows.where(F.size("embedding") == (most.width if most else 0))
    return rows.select("vec_id", F.transform("embedding", lambda c: F.floor(c * SCALE)).alias("x"))


def matrix_of(column):
    """The rows of an Arrow list column of equal widths as a matrix."""
    width = len(column.values) // len(column) if len(column) else 0
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width) if width else np.zeros((0, 0), np.int64)


def split_sum(number: int) -> tuple:
    """High and low part of an integer of any size as decimals, whose sums are exact."""
    from decimal import Decimal

    return Decimal(number >> LOW), Decimal(number & ((1 << LOW) - 1))


def exact_sums(frame: DataFrame, partial) -> dict[tuple[int, int], int]:
    """``{(i, j): sum}`` of the integers that ``partial`` makes of each block of vectors, added up by Spark."""

    def run(batches):
        import pyarrow as pa

        total: dict[tuple[int, int], int] = {}
        for batch in batches:
            x = matrix_of(batch.column("x"))
            for at in range(0, len(x), BLOCK):
                for place, number in partial(x[at : at + BLOCK]).items():
                    total[place] = total.get(place, 0) + number
        parts = [(i, j, *split_sum(number)) for (i, j), number in total.items()]
        kinds = (pa.int32(), pa.int32(), pa.decimal128(38, 0), pa.decimal128(38, 0))
        columns = [pa.array([row[k] for row in parts], kind) for k, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(columns, ["i", "j", "high", "low"])

    parts = frame.select("x").mapInArrow(run, "i int, j int, high decimal(38,0), low decimal(38,0)")
    rows = parts.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    return {(row.i, row.j): (int(row.high) << LOW) + int(row.low) for row in rows}


def whole_sum(x, axis=0):
    """Sums of integers along an axis as Python integers, by 64-bit arithmetic where that can't overflow."""
    most = int(np.abs(x.astype(np.float64)).max(initial=0)) + 1
    if most * max(x.shape[axis], 1) < 1 << 62:
        return x.sum(axis).tolist()
    return x.astype(object).sum(axis).tolist()


def dimension_sums(x) -> dict[tuple[int, int], int]:
    """Entries per dimension, and under (-1, -1) the number of vectors."""
    return {(-1, -1): len(x)} | {(i, i): total for i, total in enumerate(whole_sum(x))}


def centred_squares(n: int, sums: list[int]):
    """A function from a block of vectors to the sums of ``(n x_i - S_i)^2`` under (i, i) and of
    ``(n x_i - S_i + n x_j - S_j)^2`` under (i, j).

    With the rounded mean m taken off first, ``n x - S`` is ``n z - r`` for small z, so the block adds up z
    and its squares in 64 bits and puts n and r in afterwards, in integers of any size.
    """
    middle = [round(total / n) for total in sums]
    rest = [total - n * m for total, m in zip(sums, middle)]

    def squares(z, r: list[int]) -> list[int]:
        """Of the columns of z with the offsets r."""
        large = int(np.abs(z.astype(np.float64)).max(initial=0)) >= 1 << 24
        wide = z.astype(object) if large else z
        once, twice = wide.sum(0).tolist(), (wide * wide).sum(0).tolist()
        return [n * n * q - 2 * n * r_i * s + len(z) * r_i * r_i for q, s, r_i in zip(twice, once, r)]

    def partial(x) -> dict[tuple[int, int], int]:
        large = max(map(abs, middle)) >= 1 << 61 or int(np.abs(x.astype(np.float64)).max(initial=0)) >= 1 << 61
        z = (x.astype(object) if large else x) - np.array(middle, object if large else np.int64)
        out = {}
        for i in range(z.shape[1]):
            out |= {(i, j): q for j, q in zip([i], squares(z[:, i : i + 1], rest[i : i + 1]))}
            pairs = z[:, i : i + 1] + z[:, i + 1 :]
            both = [rest[i] + r for r in rest[i + 1 :]]
            out |= {(i, j): q for j, q in enumerate(squares(pairs, both), i + 1)}
        return out

    return partial


def fitted(distinct: DataFrame) -> Whitening | None:
    """The whitening of the vectors in ``distinct``, none for an empty table.

    Two passes: sums, then squares of centred dimensions and of sums of two of them. The variance of
    a sum is the sum of the variances and twice the covariance, so differences give the covariances,
    exactly. d x (d + 1) / 2 numbers reach the driver, whatever the number of vectors.
    """
    found = exact_sums(distinct, dimension_sums)
    n = found.pop((-1, -1), 0)
    if not n:
        return None
    sums = [found[i, i] for i in range(len(found))]
    squares = exact_sums(distinct, centred_squares(n, sums))
    width = len(sums)
    covariance = np.zeros((width, width))
    for (i, j), q in squares.items():
        double = 2 * q if i == j else q - squares[i, i] - squares[j, j]
        covariance[i, j] = covariance[j, i] = double / (2 * n**3)
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")
    return Whitening(n, sums, values[order], vectors[:, order], float(np.trace(covariance)))


def whitened(x, model: Whitening, components: int):
    """The vectors' places along the first components, each with unit variance."""
    middle = np.array([round(total / model.n) for total in model.sums], np.float64)
    rest = np.array([total - model.n * round(total / model.n) for total in model.sums], np.float64) / model.n
    return (x.astype(np.float64) - middle - rest) @ (model.vectors[:, :components] / np.sqrt(model.values[:components]))


def identity_error(distinct: DataFrame, model: Whitening, components: int) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity, measured on all of them.
    Their means are 0 up to rounding; what is left of it is taken off."""

    def run(batches):
        import pandas as pd

        total = np.zeros((components + 1, components + 1))
        for batch in batches:
            w = whitened(matrix_of(batch.column("x")), model, components)
            w = np.column_stack([w, np.ones(len(w))])
            total += w.T @ w
        i, j = np.indices(total.shape)
        import pyarrow as pa

        yield pa.RecordBatch.from_pandas(
            pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "v": total.ravel()}), pa.schema([("i", pa.int64()), ("j", pa.int64()), ("v", pa.float64())]), preserve_index=False
        )

    rows = distinct.select("x").mapInArrow(run, "i bigint, j bigint, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    moments = np.zeros((components + 1, components + 1))
    for row in rows:
        moments[row.i, row.j] = row.v / model.n
    mean = moments[:-1, -1]
    return float(np.abs(moments[:-1, :-1] - np.outer(mean, mean) - np.eye(components)).max(initial=0))


def whiten(rows: DataFrame, components: int = 4, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)`` for every row that
    ``gridded`` keeps and each of the first ``components`` components.

    The whitening is fitted to the distinct vectors, so that copies don't weigh. Components whose
    eigenvalue is 0 up to rounding don't exist, so rows of a table with fewer independent dimensions have
    fewer components and those of one distinct vector none. A ``deviation`` beyond 64 bits is null.
    An empty table gives no rows; other columns are ignored.
    """
    points = gridded(rows, key, vector)
    distinct = saved(points.select("x").distinct(), "distinct-vectors")
    model = fitted(distinct)
    kind = dict(points.dtypes)["vec_id"]
    schema = f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    real = int((model.values > RANK * len(model.values) * max(model.values[0], 0)).sum())
    components = min(components, real) if model.values[0] > 0 else 0
    error = identity_error(distinct, model, components)

    def deviations(x) -> list:
        n, sums = model.n, model.sums
        largest = max(n * (int(np.abs(x.astype(np.float64)).max(initial=0)) + 1) + abs(s) for s in sums)
        if largest * largest * len(sums) < 1 << 62:
            return ((n * x - np.array(sums, np.int64)) ** 2).sum(1).tolist()
        exact = ((n * x.astype(object) - np.array(sums, object)) ** 2).sum(1).tolist()
        return [d if d < 1 << 63 else None for d in exact]

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            x = matrix_of(batch.column("x"))
            count, places = len(x), np.repeat(np.arange(len(x)), components)
            ids = batch.column("vec_id").take(pa.array(places))
            numbers = np.tile(np.arange(1, components + 1, dtype=np.int32), count)
            far = pa.array(deviations(x), pa.int64()).take(pa.array(places)) if count else pa.array([], pa.int64())
            values = whitened(x, model, components).ravel() if count else np.zeros(0)
            share = np.tile(model.values[:components] / model.trace, count)
            columns = [ids, pa.array(numbers), pa.array(np.full(len(places), model.n)), far, pa.array(values), pa.array(share)]
            names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.full(len(places), error))], names)

    return points.mapInArrow(run, schema) if components else rows.sparkSession.createDataFrame([], schema)
