"""Whitening of vectors by a covariance made of variances alone.

By polarisation, twice the covariance of two dimensions is the variance of their sum
less their own variances. So one aggregate of squares, for every dimension and for the
sum of every pair, gives the whole matrix. All of it is in whole numbers: components are
quantised, centred by the whole part of their mean, squared and added up exactly; what
the mean has beyond its whole part is settled exactly at the end.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.tables import Workspace

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
# Rows of which squares are taken at once.
ROWS_AT_ONCE = 2048
# Eigenvalues of no more than this share of the largest are taken for zero.
NO_SPREAD = 1e-12


class Whitener(NamedTuple):
    """What is fitted: plain values, so that it can travel to any worker."""

    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    # A component to a column, the largest eigenvalue first.
    components: np.ndarray
    trace: float


def quantised(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """Replaces ``vector`` by whole numbers x = floor(64 * c) + 1000000, c as double.

    Rows drop out of which the vector is null or holds null or non-finite entries. An
    entry that is too large for a long is an error.
    """
    sound = F.forall(vector, lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)))
    rows = vectors.where(F.col(vector).isNotNull() & sound)
    beyond = F.lit(float(1 << 62))
    fits = F.forall(vector, lambda c: F.abs(c.cast("double") * SCALE) < beyond)
    whole = F.transform(
        vector, lambda c: F.floor(c.cast("double") * SCALE).cast("bigint") + F.lit(SHIFT)
    )
    error = F.raise_error(F.lit("an entry of a vector is too large")).cast("array<bigint>")
    return rows.withColumn(vector, F.when(fits, whole).otherwise(error))


def matrices(batches, vector: str, width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of the batches and their vectors as rows; shorter ones end in zeros before
    quantising, that is in SHIFT."""
    for batch in batches:
        for first in range(0, len(batch), ROWS_AT_ONCE):
            part = batch.slice(first, ROWS_AT_ONCE)
            lists = part.column(vector)
            lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            values = lists.flatten().to_numpy(zero_copy_only=False)
            if (lengths == width).all():
                yield part, values.reshape(len(part), width)
            else:
                rows = np.full((len(part), width), SHIFT, np.int64)
                rows[np.arange(width) < lengths[:, None]] = values
                yield part, rows


def squares(centred: np.ndarray) -> np.ndarray:
    """Sums of squares of all columns and of all sums of two columns, as Python integers:
    entry i, i for a column and i, j for a pair."""
    width = centred.shape[1]
    found = np.zeros((width, width), object)
    if not centred.size:
        return found
    # Small numbers, which is what vectors have, are added up by the machine.
    if 4 * int(np.abs(centred).max()) ** 2 * len(centred) >= 1 << 62:
        centred = centred.astype(object)
    for i in range(width):
        found[i, i] = int((centred[:, i] ** 2).sum())
        sums = centred[:, i : i + 1] + centred[:, i + 1 :]
        found[i, i + 1 :] = (sums**2).sum(axis=0).tolist()
    return found


def first_moments(vectors: DataFrame, vector: str) -> tuple[int, list[int]]:
    """Number of vectors, and the sum of every dimension. A row per dimension reaches the
    driver, not one per vector."""
    width = vectors.agg(F.max(F.size(vector))).first()[0] or 0
    if not width:
        return vectors.count(), []

    def add(batches) -> Iterator[pa.RecordBatch]:
        count, total = 0, np.zeros(width, object)
        for part, rows in matrices(batches, vector, width):
            count += len(part)
            # Half of each number at a time: their sums cannot overflow.
            total += (rows >> 31).sum(0).astype(object) * (1 << 31)
            total += (rows & ((1 << 31) - 1)).sum(0).astype(object)
        yield _numbers(range(-1, width), [count, *total])

    found = _added(vectors.select(vector).mapInArrow(add, "place int, total decimal(38,0)"))
    return found[-1], [found[i] for i in range(width)]


def _numbers(places, totals) -> pa.RecordBatch:
    from decimal import Decimal

    whole = pa.array([Decimal(int(x)) for x in totals], pa.decimal128(38, 0))
    return pa.RecordBatch.from_arrays([pa.array(places, pa.int32()), whole], ["place", "total"])


def _added(rows: DataFrame) -> dict[int, int]:
    totals = rows.groupBy("place").agg(F.sum("total").alias("total"))
    return {row.place: int(row.total) for row in totals.collect()}


def covariance(vectors: DataFrame, vector: str, n: int, sums: list[int]) -> np.ndarray:
    """The covariance matrix, divisor n, every entry the double nearest to the exact one.

    With m the whole part of a mean and r = S - n * m, the squares of n * x - S add up
    to n * n * sum((x - m)^2) - n * r * r, for a pair with the sums of both.
    """
    width = len(sums)
    centres = np.array([s // n for s in sums], np.int64)

    def square(batches) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width), object)
        for _, rows in matrices(batches, vector, width):
            total += squares(rows - centres)
        pairs = np.triu_indices(width)
        yield _numbers(pairs[0] * width + pairs[1], total[pairs])

    found = _added(vectors.select(vector).mapInArrow(square, "place int, total decimal(38,0)"))
    rest = [s - n * (s // n) for s in sums]

    def variance(i: int, j: int) -> int:
        """n^3 times the variance of a dimension, or of the sum of two."""
        r = rest[i] if i == j else rest[i] + rest[j]
        return n * n * found[i * width + j] - n * r * r

    result = np.zeros((width, width))
    for i in range(width):
        result[i, i] = variance(i, i) / n**3
        for j in range(i + 1, width):
            twice = variance(i, j) - variance(i, i) - variance(j, j)
            result[i, j] = result[j, i] = twice / (2 * n**3)
    return result


def fit(vectors: DataFrame, vector: str = "embedding") -> Whitener:
    """Fits to all quantised vectors; two passes, of which the driver sees a number per
    dimension and then one per pair of dimensions."""
    n, sums = first_moments(vectors, vector)
    if not sums:
        return Whitener(n, sums, np.zeros(0), np.zeros((0, 0)), 0.0)
    matrix = covariance(vectors, vector, n, sums)
    values, directions = np.linalg.eigh(matrix)
    return Whitener(n, sums, values[::-1], directions[:, ::-1], float(np.trace(matrix)))


def whiten(
    vectors: DataFrame, fitted: Whitener, vector: str = "embedding", name: str = "vec_id",
    components: int = COMPONENTS,
) -> DataFrame:
    """``name``, deviation (sum of squares of n * x - S, exact) and whitened (an array, null
    where a component has no spread) of all quantised vectors. A deviation that is too
    large for a long is an error."""
    n, width = fitted.n, len(fitted.sums)
    kept = min(components, width)
    largest = float(fitted.eigenvalues[0]) if width else 0.0
    spread = fitted.eigenvalues[:kept] > NO_SPREAD * max(largest, 0.0)
    scale = 1 / np.sqrt(np.where(spread, fitted.eigenvalues[:kept], 1.0))
    axes = fitted.components[:, :kept] * scale
    sums, silent = [int(s) for s in fitted.sums], (~spread).nonzero()[0].tolist()
    centres = [s // n for s in sums] if n else []
    rest = [s - n * m for s, m in zip(sums, centres)]

    def run(batches) -> Iterator[pa.RecordBatch]:
        whole, fraction = np.array(centres, np.int64), np.array(rest, np.int64)
        for part, rows in matrices(batches, vector, width):
            centred = rows - whole
            scaled = centred.astype(object) * n - fraction
            if width and float(np.abs(centred).max() + 1) ** 2 * n * n * width < 1 << 62:
                scaled = centred * n - fraction
            deviation = (scaled * scaled).sum(axis=1) if width else np.zeros(len(part), np.int64)
            found = (centred - fraction / max(n, 1)) @ axes
            lists = found.astype(object)
            lists[:, silent] = None
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(name),
                    pa.array(deviation.tolist(), pa.int64()),
                    pa.array(lists.tolist() if silent else list(found), pa.list_(pa.float64())),
                ],
                [name, "deviation", "whitened"],
            )

    read = vectors.select(F.col(name).cast("bigint"), vector)
    return read.mapInArrow(run, f"{name} bigint, deviation bigint, whitened array<double>")


def identity_error(whitened: DataFrame) -> float | None:
    """The largest entry, without its sign, of the whitened vectors' covariance less the
    identity; components without spread are left out. Null without any."""
    row = whitened.select("whitened").limit(1).collect()
    known = [i for i, x in enumerate(row[0].whitened) if x is not None] if row else []
    if not known:
        return None
    size = len(known)

    def moments(batches) -> Iterator[pa.RecordBatch]:
        count, total, products = 0, np.zeros(size), np.zeros((size, size))
        for batch in batches:
            lists = batch.column("whitened")
            rows = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)[:, known]
            rows = rows.astype(float)
            count += len(rows)
            total += rows.sum(0)
            products += rows.T @ rows
        values = np.concatenate([[count], total, products.ravel()])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values)], ["place", "total"]
        )

    found = whitened.select("whitened").mapInArrow(moments, "place int, total double")
    rows = found.groupBy("place").agg(F.sum("total").alias("total")).collect()
    values = np.zeros(1 + size + size * size)
    values[[row.place for row in rows]] = [row.total for row in rows]
    means = values[1 : size + 1] / values[0]
    matrix = values[size + 1 :].reshape(size, size) / values[0] - np.outer(means, means)
    return float(np.abs(matrix - np.eye(size)).max())


def whitened_components(
    vectors: DataFrame, workspace: Workspace, vector: str = "embedding", name: str = "vec_id",
    components: int = COMPONENTS,
) -> DataFrame:
    """A row per vector and component: name, component (from 1), n, deviation, whitened,
    explained and identity_error, fitted to all vectors.

    Rows without a usable vector drop out (see ``quantised``); repeated rows and null
    names stay and count each time. Shorter vectors count as ending in zeros. Where a
    component has no spread, as with equal vectors, whitened is null, and so are
    explained without any spread at all and identity_error without any known component.
    No rows give no rows. Other columns are not read.
    """
    usable = workspace.keep(quantised(vectors.select(name, vector), vector), "quantised")
    fitted = fit(usable, vector)
    found = workspace.keep(whiten(usable, fitted, vector, name, components), "whitened")
    error = identity_error(found)
    shares = [float(x) / fitted.trace if fitted.trace > 0 else None for x in fitted.eigenvalues]
    explained = F.array(*[F.lit(x).cast("double") for x in shares[:components]])
    listed = found.select(
        name, "deviation", F.posexplode("whitened").alias("place", "whitened")
    )
    return listed.select(
        name,
        (F.col("place") + 1).alias("component"),
        F.lit(fitted.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("place")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
