"""Whitened principal components of embeddings, without ever forming their covariance.

Entries become integers first, so counts, sums and distances to the mean are exact. The vectors are written once as
packed blocks; every product with the covariance is a pass over these blocks in which each task adds up
centred' (centred Y) for a narrow Y, and the sums of the tasks are added in two levels. `jacobi_davidson` asks for the
products; driver and closures hold a few vectors of one embedding's length, whatever the number of rows.

Rows whose vector is null, empty or has null or non-finite entries are dropped, and so are vectors of another length than
most (of equally frequent lengths the longest stays). Null or repeated ids are rows like others. There are as many
components as entries, if those are fewer than asked for. A component without variance has null `whitened`, and
`explained` is null if nothing varies. Integers beyond 2^53 saturate; a deviation beyond a BIGINT is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wardenlake.functions.storage import materialize
from wardenlake.llm.jacobi_davidson import largest_eigenpairs

COMPONENTS = 8
UNITS, SHIFT = 1024, 100_000
MOST_UNITS = 1 << 53
LIMB = 24
SUMS_AT_ONCE = 64


class Center(NamedTuple):
    """Number of vectors, sum of each entry, and bounds on the entries."""

    n: int
    sums: list[int]
    low: int
    high: int

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact: 64-bit integers where they suffice, else Python's."""
        if self.n * max(abs(self.low), abs(self.high), 1) >= 1 << 62:
            return x.astype(object) * self.n - np.array(self.sums, object)
        return x * np.int64(self.n) - np.array(self.sums, np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.deviations(x).astype(np.float64) / self.n


class Whitening(NamedTuple):
    center: Center
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    @property
    def scales(self) -> np.ndarray:
        """1 / sqrt(eigenvalue); NaN where nothing varies."""
        least = len(self.vectors) * np.finfo(float).eps * max(self.values.max(initial=0.0), np.finfo(float).tiny)
        return np.where(self.values > least, 1 / np.sqrt(np.maximum(self.values, least)), np.nan)


def integer_vectors(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, integer vectors) of the usable vectors of every length."""
    lengths = np.diff(column.offsets.to_numpy())
    starts = column.offsets.to_numpy()[:-1]
    values = column.values.cast(pa.float64()).to_numpy(zero_copy_only=False)
    usable = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False) & (lengths > 0))
    for length in np.unique(lengths[usable]).tolist():
        rows = usable[lengths[usable] == length]
        taken = values[starts[rows][:, None] + np.arange(length)]  # a null entry is NaN here
        good = np.isfinite(taken).all(axis=1)
        with np.errstate(over="ignore"):
            units = np.floor(UNITS * taken[good])
        yield rows[good], np.clip(units, -MOST_UNITS, MOST_UNITS).astype(np.int64) + SHIFT


# ---------------------------------------------------------------------------------------------
# passes


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For every length and entry: how many vectors, and their sum in two limbs, smallest and largest integer."""
    for batch in batches:
        for _, x in integer_vectors(batch.column("vec")):
            if not len(x):
                continue
            d = x.shape[1]
            columns = [np.full(d, d), np.arange(d), np.full(d, len(x)), (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0), x.min(axis=0), x.max(axis=0)]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["length", "entry", "n", "upper", "lower", "low", "high"])


def center(rows: DataFrame) -> Center | None:
    kinds = ", ".join(f"{c} long" for c in ("length", "entry", "n", "upper", "lower", "low", "high"))
    exact = [F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("upper", "lower")]
    found = rows.select("vec").mapInArrow(_statistics, kinds).groupBy("length", "entry")
    found = materialize(found.agg(F.sum("n").alias("n"), *exact, F.min("low").alias("low"), F.max("high").alias("high")))
    most = found.where("entry = 0").orderBy(F.desc("n"), F.desc("length")).first()
    if most is None:
        return None
    entries = found.where(F.col("length") == most["length"]).orderBy("entry").collect()
    sums = [(int(e["upper"]) << 32) + int(e["lower"]) for e in entries]
    return Center(most["n"], sums, min(e["low"] for e in entries), max(e["high"] for e in entries))


def _blocks(batches: Iterator[pa.RecordBatch], length: int, kind: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, x in integer_vectors(batch.column("vec")):
            if x.shape[1] == length and len(x):
                yield pa.RecordBatch.from_arrays([pa.array([x.astype(kind).tobytes()], pa.binary())], ["block"])


def packed_blocks(rows: DataFrame, at: Center) -> tuple[DataFrame, str]:
    """A table of blocks of vectors, and their numpy type."""
    kind = "<i4" if max(abs(at.low), abs(at.high)) < 1 << 31 else "<i8"
    length = len(at.sums)
    return materialize(rows.select("vec").mapInArrow(lambda batches: _blocks(batches, length, kind), "block binary")), kind


def _summed(batches: Iterator[pa.RecordBatch], terms, shape: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """One row: the sum of terms(value) over all values, as the double and what it lacks."""
    total = np.zeros(shape, np.longdouble)
    seen = False
    for batch in batches:
        for value in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
            total += terms(*value)
            seen = True
    if seen:
        near = total.astype(np.float64)
        rest = (total - near).astype(np.float64)
        yield pa.RecordBatch.from_arrays([pa.array([near.tobytes()], pa.binary()), pa.array([rest.tobytes()], pa.binary())], ["near", "rest"])


def sum_over(blocks: DataFrame, terms, shape: tuple[int, int]) -> np.ndarray:
    """The sum of terms(block bytes), an array of that shape, over all blocks."""
    kinds = "near binary, rest binary"

    def both(near: bytes, rest: bytes) -> np.ndarray:
        return (np.frombuffer(near).astype(np.longdouble) + np.frombuffer(rest)).reshape(shape)

    parts = blocks.mapInArrow(lambda batches: _summed(batches, terms, shape), kinds)
    tasks = blocks.rdd.getNumPartitions()
    if tasks > SUMS_AT_ONCE:
        parts = parts.repartition(int(tasks**0.5)).mapInArrow(lambda batches: _summed(batches, both, shape), kinds)
    total = np.zeros(shape, np.longdouble)
    for row in parts.collect():
        total += both(row["near"], row["rest"])
    return total.astype(np.float64)


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the column `vec` of all rows; None if no vector is left."""
    at = center(rows)
    if at is None:
        return None
    blocks, kind = packed_blocks(rows, at)
    d = len(at.sums)

    def centred(block: bytes) -> np.ndarray:
        return at.centred(np.frombuffer(block, kind).reshape(-1, d).astype(np.int64))

    def product(y: np.ndarray) -> np.ndarray:
        def terms(block: bytes) -> np.ndarray:
            c = centred(block)
            return c.T @ (c @ y)

        return sum_over(blocks, terms, y.shape) / at.n

    trace = float(sum_over(blocks, lambda block: np.array([[(centred(block) ** 2).sum()]]), (1, 1))[0, 0]) / at.n
    values, vectors = largest_eigenpairs(product, d, components)
    model = Whitening(at, values, vectors, trace, 0.0)
    turn = vectors * model.scales

    def moments(block: bytes) -> np.ndarray:
        z = np.nan_to_num(centred(block) @ turn)
        return np.column_stack([z.T @ z, z.sum(axis=0)])

    sums = sum_over(blocks, moments, (len(values), len(values) + 1)) / at.n
    apart = sums[:, :-1] - np.outer(sums[:, -1], sums[:, -1]) - np.eye(len(values))
    some = np.isfinite(model.scales)
    return model._replace(identity_error=float(np.abs(apart[np.ix_(some, some)]).max(initial=0.0)))


# ---------------------------------------------------------------------------------------------
# results


def squared_lengths(deviations: np.ndarray) -> list[int | None]:
    """Exact sum of squares of each row; None beyond 64 bits."""
    if deviations.dtype == object or max(deviations.max(initial=0), -deviations.min(initial=0)) >= 1 << 50 or deviations.shape[1] > 1 << 10:
        sums = [sum(int(v) ** 2 for v in row) for row in deviations]
    else:
        upper = deviations >> LIMB
        lower = deviations & ((1 << LIMB) - 1)
        parts = [(a * b).sum(axis=1).tolist() for a, b in ((upper, upper), (upper, lower), (lower, lower))]
        sums = [(a << 2 * LIMB) + (b << LIMB + 1) + c for a, b, c in zip(*parts)]
    return [s if s < 1 << 63 else None for s in sums]


def _whitened(batches: Iterator[pa.RecordBatch], model: Whitening) -> Iterator[pa.RecordBatch]:
    turn, scales, k, d = model.vectors, model.scales, len(model.values), len(model.vectors)
    shares = model.values / model.trace if model.trace > 0 else np.full(k, np.nan)
    for batch in batches:
        for rows, x in integer_vectors(batch.column("vec")):
            if x.shape[1] != d or not len(x):
                continue
            deviations = model.center.deviations(x)
            projected = (deviations.astype(np.float64) / model.center.n) @ turn * scales
            squares = np.array(squared_lengths(deviations), object)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(np.repeat(rows, k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                    pa.array(np.repeat(squares, k), pa.int64()),
                    pa.array(projected.ravel(), from_pandas=True),
                    pa.array(np.tile(shares, len(rows)), from_pandas=True),
                ],
                ["vec_id", "component", "deviation", "whitened", "explained"],
            )


def whiten(rows: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, component, deviation, whitened, explained: a row for every usable row of (vec_id, vec) and component."""
    kinds = "vec_id long, component int, deviation long, whitened double, explained double"
    return rows.mapInArrow(lambda batches: _whitened(batches, model), kinds)


def whitened_components(vectors: DataFrame, vec: str = "embedding", vec_id: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """The rows of `whiten`, fitted on the same table, with the number of vectors and the fit's error."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vec).alias("vec"))
    model = fit(rows, components)
    if model is None:
        model = Whitening(Center(0, [], 0, 0), np.empty(0), np.empty((0, 0)), 0.0, 0.0)
    return whiten(rows, model).select(
        "vec_id",
        "component",
        F.lit(model.center.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        "explained",
        F.lit(model.identity_error).alias("identity_error"),
    )
