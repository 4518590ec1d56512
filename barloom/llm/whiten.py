"""Whitening of embeddings by the singular values of their centred rows.

The covariance is never formed. Entries become whole numbers, so sums are exact and rows
are centred exactly before anything is rounded. Each task reduces its centred rows to one
triangular factor, block by block (QR of the factor so far on top of the next block); the
factors are joined as a tree. The last factor has the singular values and right vectors of
all centred rows: `bidiagonal` finds them, and they give the whitening directions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm import bidiagonal
from barloom.llm.common import Scratch
from barloom.llm.trees import FAN, folded

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
RANK = 1e-12  # singular values below this share of the largest are rounding, not variance
FACTOR_BYTES = 64 << 20  # of the factors joined at once
LONG = 2**63
FACTOR = "part int, factor binary"
MOMENTS = "part int, n bigint, mean binary, square binary"
MADE = T.StructType([T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))])


@dataclass(frozen=True)
class Whitening:
    """What a fit found: rows, sums, squared singular values, directions over spreads."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    directions: np.ndarray  # one column per component, unit length
    scales: np.ndarray  # square roots of the components' variances

    @property
    def explained(self) -> list[float]:
        total = float(self.values.sum())
        return [float(v) / total for v in self.values[: len(self.scales)]]


def usable(vector: str) -> Column:
    """Whether a vector has entries and all of them are numbers that fit BIGINT as x."""
    entry = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(2.0**52))
    col = F.col(f"`{vector}`")
    return F.coalesce(col.isNotNull() & (F.size(col) > 0) & F.forall(col, entry), F.lit(False))


def whole(vectors: pa.Array) -> np.ndarray:
    """Entries as whole numbers, one row per vector; all vectors have one length."""
    entries = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(SCALE * entries).astype(np.int64).reshape(len(vectors), -1) + OFFSET


def deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """n x - sums, exactly: in 64 bits where they fit, else in Python's integers."""
    if n * int(np.abs(x).max(initial=0)) < LONG // 4 and max(map(abs, sums)) < LONG // 4:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def squares(deviation: np.ndarray) -> list[int | None]:
    """The sum of squares of each row; null where BIGINT cannot hold it."""
    most = int(np.abs(deviation).max(initial=0))
    exact = deviation if deviation.shape[1] * most * most < LONG else deviation.astype(object)
    return [s if s < LONG else None for s in map(int, (exact * exact).sum(axis=1))]


def _sums(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * dims
        for batch in batches:
            x = whole(batch.column(0))
            wide = x if int(np.abs(x).max(initial=0)) * max(1, len(x)) < LONG else x.astype(object)
            n, total = n + len(x), [t + int(s) for t, s in zip(total, wide.sum(axis=0))]
        if n:
            columns = [pa.array(range(dims), pa.int32()), pa.array([n] * dims, pa.int64()), pa.array(map(Decimal, total), pa.decimal128(38, 0))]
            yield pa.RecordBatch.from_arrays(columns, ["place", "n", "total"])

    return run


def _factor(n: int, sums: tuple[int, ...]):
    """Arrow function: the triangular factor of a task's centred rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factor, block, rows = np.empty((0, len(sums))), [], 0
        for batch in batches:
            block.append(centred(whole(batch.column(0)), n, sums))
            rows += len(block[-1])
            if rows >= max(1024, 4 * len(sums)):
                factor, block, rows = np.linalg.qr(np.vstack([factor, *block]), mode="r"), [], 0
        if rows or len(factor):
            factor = np.linalg.qr(np.vstack([factor, *block]), mode="r")
            columns = [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([factor.tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["part", "factor"])

    return run


def centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """x - sums / n, rounded once."""
    return deviations(x, n, sums).astype(np.float64) / n


def _joined(dims: int):
    def fold(group: pa.Table) -> pa.Table:
        factors = [np.frombuffer(f.as_buffer(), np.float64).reshape(-1, dims) for f in group.column("factor")]
        factor = np.linalg.qr(np.vstack(factors), mode="r")
        return pa.table([group.column("part")[:1], pa.array([factor.tobytes()], pa.binary())], ["part", "factor"])

    return fold


def fit(docs: DataFrame, vector: str, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of all usable vectors of the commonest length; None without any.

    Only one line per dimension and the last factor come to the driver. A component is
    there if its singular value is more than `RANK` of the largest.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "whiten")
    good = docs.where(usable(vector)).select(F.col(f"`{vector}`").alias("vector"))
    sizes = good.groupBy(F.size("vector").alias("dims")).agg(F.count("*").alias("n"))
    commonest = sizes.orderBy(F.col("n").desc(), F.col("dims").desc()).first()
    if commonest is None:
        return None
    dims, n = commonest["dims"], commonest["n"]
    good = good.where(F.size("vector") == dims)
    sums = good.mapInArrow(_sums(dims), "place int, n bigint, total decimal(38,0)")
    lines = sums.groupBy("place").agg(F.sum("total").alias("total")).orderBy("place").collect()  # one per dimension
    total = tuple(int(r["total"]) for r in lines)

    fan = max(2, min(FAN, FACTOR_BYTES // (8 * dims * dims)))
    factors = good.mapInArrow(_factor(n, total), FACTOR)
    last = folded(factors, _joined(dims), scratch, "factor", fan=fan).first()
    factor = np.zeros((dims, dims))
    found = np.frombuffer(last["factor"], np.float64).reshape(-1, dims)
    factor[: len(found)] = found
    values, directions = bidiagonal.leading(factor, components)
    there = int(np.sum(values[: directions.shape[1]] > (RANK**2) * values[0])) if values[0] > 0 else 0
    scales = np.sqrt(values[:there] / n)
    return Whitening(n, total, values, np.ascontiguousarray(directions[:, :there]), scales)


def _whitener(fitted: Whitening):
    @F.arrow_udf(MADE)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for vectors in batches:
            deviation = deviations(whole(vectors), fitted.n, fitted.sums) if len(vectors) else np.empty((0, len(fitted.sums)))
            made = deviation.astype(np.float64) / fitted.n @ fitted.directions / fitted.scales
            offsets = np.arange(len(vectors) + 1, dtype=np.int32) * len(fitted.scales)
            lists = pa.ListArray.from_arrays(offsets, pa.array(made.ravel(), pa.float64()))
            yield pa.StructArray.from_arrays([pa.array(squares(deviation), pa.int64()), lists], ["deviation", "whitened"])

    return run


def whitened(docs: DataFrame, vector: str, fitted: Whitening | None) -> DataFrame:
    """The rows with a usable vector of the fitted length, with `deviation` and `whitened`.

    deviation is the sum over dimensions of (n x - sums)^2, exact, or null where BIGINT
    cannot hold it; whitened has one number per component, none if all rows are alike.
    Columns of `docs` with these names are replaced, all others stay. Rows whose vector is
    null, empty, of another length, or has a null, non-finite or far too large entry (2^52
    and more) are left out; rows that are repeated count and come back as often as they
    are there, null ids too. An empty table gives no rows.
    """
    names = [c for c in docs.columns if c not in MADE.names]
    good = docs.where(usable(vector) & (F.size(F.col(f"`{vector}`")) == (len(fitted.sums) if fitted else -1)))
    if fitted is None:
        empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in MADE]
        return good.select(*[F.col(f"`{c}`") for c in names], *empty)
    rows = good.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), _whitener(fitted)(F.col(f"`{vector}`")).alias("made"))
    return rows.select("row.*", "made.*")


def _moments(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, square = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
            if len(w):
                middle = w.mean(axis=0)
                n, mean, square = merged((n, mean, square), (len(w), middle, (w - middle).T @ (w - middle)))
        if n:
            columns = [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([n], pa.int64())]
            columns += [pa.array([x.tobytes()], pa.binary()) for x in (mean, square)]
            yield pa.RecordBatch.from_arrays(columns, ["part", "n", "mean", "square"])

    return run


def merged(a: tuple, b: tuple) -> tuple:
    """Count, mean and centred products of two sets of rows together."""
    n = a[0] + b[0]
    apart = b[1] - a[1]
    return n, a[1] + apart * (b[0] / n), a[2] + b[2] + np.outer(apart, apart) * (a[0] * b[0] / n)


def _of(row: dict, k: int) -> tuple:
    return row["n"], np.frombuffer(row["mean"], np.float64), np.frombuffer(row["square"], np.float64).reshape(k, k)


def identity_error(rows: DataFrame, fitted: Whitening | None) -> float | None:
    """Largest entry of the whitened rows' covariance minus the identity; null without any."""
    if fitted is None or not len(fitted.scales):
        return None
    k, scratch = len(fitted.scales), Scratch(rows.sparkSession, "moments")

    def fold(group: pa.Table) -> pa.Table:
        lines = group.to_pylist()
        out = _of(lines[0], k)
        for line in lines[1:]:
            out = merged(out, _of(line, k))
        return pa.table([group.column("part")[:1], pa.array([out[0]], pa.int64()), *[pa.array([x.tobytes()], pa.binary()) for x in out[1:]]], ["part", "n", "mean", "square"])

    last = folded(rows.select("whitened").mapInArrow(_moments(k), MOMENTS), fold, scratch, "moments").first()
    n, _, square = _of(last.asDict(), k)
    return float(np.abs(square / n - np.eye(k)).max())
