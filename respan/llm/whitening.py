"""Whitening of embeddings: principal components of all vectors, kept up to date row by row.

Entries are counted as the integers ``floor(1024 * c) + 100000``.  Every task follows the spectrum of its rows
through centred rank-one changes (``eigen``); equal rows of a batch are one change.  Tasks' spectra are combined
in groups of a fixed size, again by rank-one changes, until one is left.  Its directions, made orthogonal
again, span the space in which a Rayleigh-Ritz step over all rows gives the components; a last pass measures the
covariance of the whitened rows.  The driver and any one task hold some dim x dim matrices, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from respan.lineage import scratch_path
from respan.llm import eigen
from respan.llm.eigen import Spectrum

SCALE, SHIFT = 1024, 100_000
LARGEST = float(1 << 40)  # entries this large count as not finite
FAN_IN = 16  # matrices that one task combines
_BATCH = 1 << 21  # entries unpacked at a time


class Whitening(NamedTuple):
    n: int
    total: np.ndarray  # sums of the integer vectors less SHIFT, int64
    values: np.ndarray  # variances of the components, falling
    components: np.ndarray  # one unit vector in each column
    trace: float
    identity_error: float  # of the whitened rows' covariance; of components with some variance


def sound(column: Column, dim: int | None = None) -> Column:
    """Vectors that are used: not null or empty, no null, non-finite or huge entry, and of the table's length."""
    entries = F.forall(column, lambda x: F.coalesce(F.abs(x.cast("double")) < LARGEST, F.lit(False)))
    length = F.size(column) > 0 if dim is None else F.size(column) == dim
    return F.coalesce(column.isNotNull() & length & entries, F.lit(False))


def vector_length(vectors: DataFrame, column: str) -> int | None:
    """The most frequent length of sound vectors, the larger one of equally frequent ones."""
    c = F.col(f"`{column}`")
    sizes = vectors.where(sound(c)).groupBy(F.size(c).alias("dim")).count()
    top = sizes.orderBy(F.desc("count"), F.desc("dim")).first()
    return top.dim if top else None


def _codes(batch: pa.RecordBatch, name: str, dim: int) -> np.ndarray:
    """floor(1024 c) of every row, without the shift, which changes neither deviations nor covariances."""
    column = batch.column(name)
    entries = column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dim)
    return np.floor(SCALE * entries).astype(np.int64)


def _pieces(batch: pa.RecordBatch, dim: int):
    step = max(1, _BATCH // dim)
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def _centred(y: np.ndarray, n: int, total: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
    """y less its mean, and n * y - total where that is within 64 bits."""
    reach = n * int(np.abs(y).max(initial=0)) + int(np.abs(total).max(initial=0))
    if reach < 1 << 62:
        exact = n * y - total
        return exact / n, exact
    return y - total / n, None


def _deviation(y: np.ndarray, n: int, total: np.ndarray, exact: np.ndarray | None) -> pa.Array:
    if exact is not None and y.shape[1] * int(np.abs(exact).max(initial=0)) ** 2 < 1 << 62:
        return pa.array((exact * exact).sum(1))
    wide = n * y.astype(object) - total.astype(object)
    sums = (wide * wide).sum(1)
    return pa.array([int(s) if s < 1 << 63 else None for s in sums], pa.int64())


_FIELDS = "n long, total binary, size long, `values` binary, vectors binary"


def _pack(s: Spectrum) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {"n": pa.array([s.n], pa.int64()), "total": [s.total.tobytes()], "size": pa.array([len(s.values)], pa.int64()), "values": [s.values.tobytes()], "vectors": [np.ascontiguousarray(s.vectors).tobytes()]}
    )


def _unpack(row: dict) -> Spectrum:
    m = row["size"]
    of = lambda name, kind=float: np.frombuffer(row[name], kind)
    return Spectrum(row["n"], of("total", np.int64), of("values"), of("vectors").reshape(m, m))


def _merge_tree(parts: DataFrame, merge: Callable[[Spectrum, Spectrum], Spectrum]) -> Spectrum | None:
    """One row from one row a task: FAN_IN rows meet in a task, then FAN_IN of the results, until one is left."""
    spark = parts.sparkSession
    path = scratch_path(spark, "spectra")
    parts.withColumn("part", F.spark_partition_id().cast("long")).write.parquet(path)
    parts = spark.read.parquet(path)
    last = parts.agg(F.max("part")).first()[0]
    if last is None:
        return None
    left = last + 1

    def run(table: pa.Table) -> pa.Table:
        rows = table.sort_by("part").to_pylist()
        merged = _unpack(rows[0])
        for row in rows[1:]:
            merged = merge(merged, _unpack(row))
        out = pa.Table.from_batches([_pack(merged)])
        return out.append_column("part", pa.array([rows[0]["part"] // FAN_IN], pa.int64()))

    while True:
        parts = parts.groupBy(F.floor(F.col("part") / FAN_IN).alias("g")).applyInArrow(run, f"{_FIELDS}, part long")
        if left <= FAN_IN:
            return _unpack(parts.collect()[0].asDict())
        left = -(-left // FAN_IN)


def _each_task(vectors: DataFrame, column: str, dim: int, start: Callable[[], Spectrum], step: Callable[[Spectrum, np.ndarray], Spectrum]) -> DataFrame:
    """One packed row for every task with rows."""

    def run(batches):
        s = start()
        for batch in batches:
            for piece in _pieces(batch, dim):
                s = step(s, _codes(piece, "v", dim))
        if s.n:
            yield _pack(s)

    c = F.col(f"`{column}`")
    return vectors.where(sound(c, dim)).select(c.cast("array<double>").alias("v")).mapInArrow(run, _FIELDS)


def _follow(s: Spectrum, y: np.ndarray) -> Spectrum:
    whole = np.ascontiguousarray(y).view(np.dtype((np.void, y.itemsize * y.shape[1]))).ravel()
    _, first, times = np.unique(whole, return_index=True, return_counts=True)
    for i, t in sorted(zip(first.tolist(), times.tolist())):
        s = eigen.add(s, y[i], t)
    return s


def _sum(a: Spectrum, b: Spectrum) -> Spectrum:
    return Spectrum(a.n + b.n, a.total, a.values + b.values, a.vectors + b.vectors)


def _products(vectors: DataFrame, column: str, n: int, total: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Covariance of the rows' coordinates in ``basis``, by one pass over them."""
    dim, m = basis.shape

    def start() -> Spectrum:
        return Spectrum(0, np.zeros(dim, np.int64), np.zeros(m), np.zeros((m, m)))

    def step(s: Spectrum, y: np.ndarray) -> Spectrum:
        p = _centred(y, n, total)[0] @ basis
        return Spectrum(s.n + len(y), s.total, s.values, s.vectors + p.T @ p)

    return _merge_tree(_each_task(vectors, column, dim, start, step), _sum).vectors / n


def fit_whitening(vectors: DataFrame, column: str = "embedding", components: int = 8) -> Whitening | None:
    """The first ``components`` components of all sound vectors; None if there are none.  Runs jobs.

    Vectors that are null or empty, or hold a null, non-finite or huge (2^40) entry, and vectors of another length than
    the most frequent one, count as missing.  Repeated rows count as often as they occur.  Of components with equal
    variance any turn of them may come out.  A component counts as without variance below dim * 2^-50 of the trace.
    """
    dim = vector_length(vectors, column)
    if dim is None:
        return None
    found = _merge_tree(_each_task(vectors, column, dim, lambda: eigen.empty(dim), _follow), eigen.combine)
    basis = np.linalg.qr(found.vectors[:, ::-1])[0]
    inside = _products(vectors, column, found.n, found.total, basis)  # Rayleigh-Ritz in the space found
    ritz, turn = np.linalg.eigh((inside + inside.T) / 2)
    trace = float(np.trace(inside))
    values, directions = ritz[::-1], (basis @ turn)[:, ::-1]
    k = min(components, dim)
    values, directions = np.where(values > dim * 2.0**-50 * trace, values, 0.0)[:k], directions[:, :k]
    directions = directions * np.where(directions[np.abs(directions).argmax(0), np.arange(k)] < 0, -1.0, 1.0)
    live = values > 0
    error = 0.0
    if live.any():
        white = directions[:, live] / np.sqrt(values[live])
        error = float(np.abs(_products(vectors, column, found.n, found.total, white) - np.eye(int(live.sum()))).max())
    return Whitening(found.n, found.total, values, directions, trace, error)


def whiten(vectors: DataFrame, model: Whitening | None, column: str = "embedding", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns if None), ``deviation`` and ``whitened`` (an array) of every sound vector of the model's length.

    ``deviation`` is the exact sum over dimensions of (n x - sum)^2, null where that is beyond 64 bits.  Entries of
    ``whitened`` for components without variance are null.  A column named like a new one is replaced.
    Without a model (nothing to fit on) there are no rows.
    """
    keep = [c for c in (vectors.columns if keep is None else keep) if c not in ("deviation", "whitened")]
    schema = T.StructType([vectors.schema[c] for c in keep] + [T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    dim, k = model.components.shape
    n, total, live = model.n, model.total, model.values > 0
    white = model.components / np.sqrt(np.where(live, model.values, 1.0))

    def run(batches):
        for batch in batches:
            for piece in _pieces(batch, dim):
                y = _codes(piece, "__v", dim)
                centred, exact = _centred(y, n, total)
                out = pa.array((centred @ white).ravel(), mask=np.tile(~live, len(y)))
                rows = pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1, dtype=np.int32) * k), out)
                yield pa.RecordBatch.from_arrays([*(piece.column(i) for i in range(len(keep))), _deviation(y, n, total, exact), rows], [*keep, "deviation", "whitened"])

    c = F.col(f"`{column}`")
    chosen = [F.col(f"`{x}`") for x in keep] + [c.cast("array<double>").alias("__v")]
    return vectors.where(sound(c, dim)).select(*chosen).mapInArrow(run, schema)
