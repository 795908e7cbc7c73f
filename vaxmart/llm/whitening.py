"""Embedding whitening with a bit-sliced scatter matrix.

An entry c becomes the whole number x = floor(SCALE * c) + OFFSET.  The distinct x vectors are the fit list.  Their
entries, shifted by the table's least one, are cut into bit planes; the bits of one plane and dimension are packed
across rows into 64-bit words, so that the cross-product of two dimensions is the sum over pairs of planes (i, j) of
2^(i+j) * popcount(plane_i AND plane_j).  A task adds these counts up for its rows and passes on one row for each pair
of dimensions and power of two, whatever its number of vectors.  The driver holds sums of dimension x dimension whole
numbers: n * sum(xy) - sum(x) * sum(y) is exact, and only then becomes a double for the eigenvectors.

Cases: a vector that is null or holds a null, NaN or infinite entry is left out, and so is one with an entry whose x is
not a long.  Vectors are compared at one length, the most frequent one (the shorter of two equally frequent); others,
and empty vectors, are left out.  Rows that repeat, and null ids, are rows of their own; their vector is fitted once.
Components whose eigenvalue is zero to double precision (fewer distinct vectors than dimensions, constant dimensions)
have no direction and are left out; without any, or without a vector, the result is empty.  ``deviation`` is null where
the exact sum is no long; ``deviation_digits`` then holds it.  Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaxmart.llm.common import cut, prepare

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
ROWS = 8192  # vectors packed at once
_LONG = 1 << 62


class Space(NamedTuple):
    """What every task has to know of the table: length of the vectors, least x and greatest x."""

    dim: int
    low: int
    high: int

    @property
    def bits(self) -> int:
        return max(1, (self.high - self.low).bit_length())

    @property
    def kind(self) -> np.dtype:
        return np.dtype(next(f"<u{w}" for w in (1, 2, 4, 8) if self.bits <= 8 * w))


class Model(NamedTuple):
    space: Space
    n: int
    sums: list[int]  # of x - low
    covariance: np.ndarray
    eigenvalues: np.ndarray
    vectors: np.ndarray  # a column for each component


def matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, x as a matrix) of the usable vectors of a column, one matrix for each length."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    starts = np.asarray(column.offsets, dtype=np.int64)
    sizes = np.diff(starts)
    sizes[np.asarray(column.is_null())] = 0
    flat = column.values.to_numpy(zero_copy_only=False).astype(np.float64)  # nulls become NaN
    for dim in np.unique(sizes[sizes > 0]):
        at = np.flatnonzero(sizes == dim)
        c = flat[starts[at][:, None] + np.arange(dim)] if len(at) * dim != len(flat) else flat.reshape(-1, dim)
        with np.errstate(over="ignore", invalid="ignore"):
            x = np.floor(c * SCALE)
            good = (np.abs(x) < _LONG).all(axis=1)
        yield at[good], x[good].astype(np.int64) + OFFSET


def measure(vectors: DataFrame) -> Space | None:
    """Length and extent of the vectors; one row for each task and length is summed up."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, tuple[int, int, int]] = {}
        for batch in batches:
            for _, x in matrices(batch.column(1)):
                if len(x):
                    n, low, high = seen.get(x.shape[1], (0, _LONG, -_LONG))
                    seen[x.shape[1]] = (n + len(x), min(low, int(x.min())), max(high, int(x.max())))
        if seen:
            yield pa.RecordBatch.from_pydict({
                "dim": pa.array(list(seen), pa.int32()),
                **{name: pa.array([v[i] for v in seen.values()], pa.int64()) for i, name in enumerate(("n", "low", "high"))}})

    found = (vectors.mapInArrow(run, "dim int, n long, low long, high long").groupBy("dim")
             .agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
             .orderBy(F.desc("n"), "dim").select("dim", "low", "high").first())
    return Space(*found) if found else None


def fit_list(vectors: DataFrame, space: Space) -> DataFrame:
    """Each distinct vector once, packed: ``x - low`` in as few bytes as the extent needs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = space.dim * space.kind.itemsize
        for batch in batches:
            for _, x in matrices(batch.column(1)):
                if len(x) and x.shape[1] == space.dim:
                    data = np.ascontiguousarray((x - space.low).astype(space.kind))
                    ends = pa.py_buffer(np.arange(len(x) + 1, dtype=np.int32) * np.int32(width))
                    yield pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.binary(), len(x), [None, ends, pa.py_buffer(data)])], ["x"])

    return cut(vectors.mapInArrow(run, "x binary").distinct(), "vectors")


def unpack(column: pa.Array, space: Space) -> np.ndarray:
    """The matrix of ``x - low`` of packed vectors."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=space.kind).reshape(-1, space.dim)


def planes(x: np.ndarray, bits: int) -> np.ndarray:
    """Bit planes of a matrix, packed across its rows: (plane, dimension, word)."""
    rows = -(-len(x) // 64) * 64
    x = np.concatenate([x, np.zeros((rows - len(x), x.shape[1]), x.dtype)]) if rows > len(x) else x
    out = np.empty((bits, x.shape[1], rows // 64), dtype=np.uint64)
    one = x.dtype.type(1)
    for i in range(bits):
        packed = np.packbits(((x >> x.dtype.type(i)) & one).astype(np.uint8), axis=0, bitorder="little")
        out[i] = np.ascontiguousarray(packed.T).view(np.uint64)
    return out


def cross_counts(p: np.ndarray) -> np.ndarray:
    """(k, a, b), a <= b: popcounts of plane_i(a) AND plane_j(b), added up over i + j = k."""
    bits, dim, _ = p.shape
    out = np.zeros((2 * bits - 1, dim, dim), dtype=np.int64)
    for a in range(dim):
        others = p[:, a:, :]
        for i in range(bits):
            out[i:i + bits, a, a:] += np.bitwise_count(p[i, a] & others).sum(axis=2, dtype=np.int64)
    return out


def _scatter(space: Space):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crossed, single, n = None, np.zeros((space.bits, space.dim), dtype=np.int64), 0
        for batch in batches:
            x = unpack(batch.column(0), space)
            for at in range(0, len(x), ROWS):
                p = planes(x[at:at + ROWS], space.bits)
                more = cross_counts(p)
                crossed = more if crossed is None else crossed + more
                single += np.bitwise_count(p).sum(axis=2, dtype=np.int64)
            n += len(x)
        if n:
            k, a, b = np.nonzero(crossed)
            i, s = np.nonzero(single)
            ones = np.full(len(i), -1)
            yield pa.RecordBatch.from_pydict({
                "a": pa.array(np.concatenate([a, s, [-1]]), pa.int32()), "b": pa.array(np.concatenate([b, ones, [-1]]), pa.int32()),
                "k": pa.array(np.concatenate([k, i, [0]]), pa.int32()),
                "n": pa.array(np.concatenate([crossed[k, a, b], single[i, s], [n]]), pa.int64())})
    return run


def fit(fitted: DataFrame, space: Space) -> Model:
    """Exact sums over the fit list, then the eigenvectors of the covariance."""
    counts = fitted.mapInArrow(_scatter(space), "a int, b int, k int, n long").groupBy("a", "b", "k").agg(F.sum("n").alias("n")).toArrow()
    cross: dict[tuple[int, int], int] = {}
    for a, b, k, n in zip(*(counts[c].to_pylist() for c in ("a", "b", "k", "n"))):
        cross[a, b] = cross.get((a, b), 0) + (n << k)
    n, dim = cross[-1, -1], space.dim
    sums = [cross.get((a, -1), 0) for a in range(dim)]
    covariance = np.array([[(n * cross.get((min(a, b), max(a, b)), 0) - sums[a] * sums[b]) / (n * n) for b in range(dim)] for a in range(dim)])
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    some = int((values > max(values[0], 0) * dim * np.finfo(float).eps).sum())
    some = min(some, COMPONENTS)
    return Model(space, n, sums, covariance, values[:some].copy(), vectors[:, :some].copy())


def project(x: np.ndarray, model: Model) -> np.ndarray:
    """Whitened coordinates of the rows of ``x - low``."""
    if model.n * (model.space.high - model.space.low) < _LONG:
        centred = (x.astype(np.int64) * model.n - np.array(model.sums, dtype=np.int64)) / model.n
    else:
        centred = ((x.astype(object) * model.n - np.array(model.sums, dtype=object)) / model.n).astype(np.float64)
    return centred @ (model.vectors / np.sqrt(model.eigenvalues))


def deviations(x: np.ndarray, model: Model) -> list[int]:
    """Exact sum over the dimensions of (n * x - S)^2."""
    n, extent = model.n, model.space.high - model.space.low
    if (n * extent) ** 2 * model.space.dim < _LONG:
        d = x.astype(np.int64) * n - np.array(model.sums, dtype=np.int64)
        return (d * d).sum(axis=1).tolist()
    x, s = (x.astype(np.int64), np.array(model.sums, np.int64)) if model.space.dim * extent * max(extent, *model.sums, 1) < _LONG else (
        x.astype(object), np.array(model.sums, object))
    last = sum(v * v for v in model.sums)
    return [n * n * int(q) - 2 * n * int(r) + last for q, r in zip((x * x).sum(axis=1), (x * s).sum(axis=1))]


def identity_error(fitted: DataFrame, model: Model) -> float:
    """Largest absolute entry of the covariance of the whitened fit list minus the identity; one row a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                y = project(unpack(batch.column(0)[at:at + ROWS], model.space), model)
                more = np.vstack([y.T @ y, y.sum(axis=0)])
                total = more if total is None else total + more
        if total is not None:
            i, j = np.indices(total.shape)
            yield pa.RecordBatch.from_pydict({"i": pa.array(i.ravel(), pa.int32()), "j": pa.array(j.ravel(), pa.int32()), "v": pa.array(total.ravel())})

    size = len(model.eigenvalues)
    found = np.zeros((size + 1, size))
    for r in fitted.mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        found[r["i"], r["j"]] = r["v"]
    mean = found[-1] / model.n
    return float(np.abs(found[:-1] / model.n - np.outer(mean, mean) - np.eye(size)).max())


SCHEMA = ("vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, "
          "deviation_digits string")


def whiten(rows: DataFrame, vector: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """One row for each usable vector and component: SCHEMA."""
    spark = rows.sparkSession
    prepare(spark)
    vectors = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    space = measure(vectors)
    if space is None:
        return spark.createDataFrame([], SCHEMA)
    fitted = fit_list(vectors, space)
    model = fit(fitted, space)
    if not len(model.eigenvalues):
        return spark.createDataFrame([], SCHEMA)
    error = identity_error(fitted, model)
    trace = float(np.trace(model.covariance))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(model.eigenvalues)
        for batch in batches:
            for at, x in matrices(batch.column(1)):
                if not len(x) or x.shape[1] != space.dim:
                    continue
                x = x - space.low
                whole = deviations(x, model)
                fits = [d if d < 1 << 63 else None for d in whole]
                ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * np.int32(size))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(at)), pa.array(fits, pa.int64()),
                    pa.array([None if f is not None else str(d) for f, d in zip(fits, whole)], pa.string()),
                    pa.ListArray.from_arrays(ends, pa.array(project(x, model).ravel()))], ["vec_id", "deviation", "deviation_digits", "y"])

    made = vectors.mapInArrow(run, "vec_id long, deviation long, deviation_digits string, y array<double>")
    shares = F.array(*[F.lit(float(e / trace)) for e in model.eigenvalues])
    return (made.select("vec_id", "deviation", "deviation_digits", F.posexplode("y").alias("at", "whitened"))
            .select("vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
                    F.get(shares, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"), "deviation_digits"))
