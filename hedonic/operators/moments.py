"""Means and covariances of columns, computed on the executors in one pass."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Groups in which the partial moments of tasks are merged before the driver merges those.
MERGED = 64
PARTIAL = "half int, bucket int, n long, gaps array<long>, mean array<double>, square array<double>"


@dataclass(frozen=True)
class Moments:
    """Row count, means and population covariance of some columns."""

    n: int
    mean: np.ndarray
    cov: np.ndarray


#: Rows, missing values per column, means, and centred sums of products.
Partial = tuple[int, np.ndarray, np.ndarray, np.ndarray]


def _partial(x: np.ndarray) -> Partial:
    """Sums of rows, taken from the first one on, so that a constant column has none."""
    gaps = np.isnan(x).sum(axis=0)
    first = x[0]
    with np.errstate(all="ignore"):  # what overflows or is missing is told from the result
        off = x - first
        total = off.sum(axis=0)
        return len(x), gaps, first + total / len(x), off.T @ off - np.outer(total, total) / len(x)


def _merged(a: Partial, b: Partial) -> Partial:
    n = a[0] + b[0]
    with np.errstate(all="ignore"):
        apart = b[2] - a[2]
        square = a[3] + b[3] + np.outer(apart, apart) * (a[0] * b[0] / n)
        return n, a[1] + b[1], a[2] + apart * (b[0] / n), square


def _rows(found: Sequence[tuple[int, int, Partial]]) -> pa.RecordBatch:
    columns = [
        pa.array([h for h, _, _ in found], pa.int32()), pa.array([b for _, b, _ in found], pa.int32()),
        pa.array([p[0] for *_, p in found], pa.int64()), pa.array([p[1] for *_, p in found], pa.list_(pa.int64())),
        pa.array([p[2] for *_, p in found], pa.list_(pa.float64())),
        pa.array([p[3].ravel() for *_, p in found], pa.list_(pa.float64())),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["half", "bucket", "n", "gaps", "mean", "square"])


def _read(n, gaps, mean, square) -> Partial:
    mean = np.array(mean, dtype=float)
    return n, np.array(gaps), mean, np.array(square, dtype=float).reshape(len(mean), len(mean))


def moments_of(df: DataFrame, cols: Sequence[str], half: Column) -> dict[int, Moments]:
    """Moments of ``cols`` for each value of ``half``, a small whole number; a missing value raises.

    Every task sums its rows as one features-by-features matrix per half, groups of tasks
    merge theirs, and what meets in the driver are ``MERGED`` of them at most.
    """
    values = [F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(cols)]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Partial] = {}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            halves = np.asarray(batch.column(0))
            # A missing value comes as NaN.
            x = np.column_stack([batch.column(i + 1).to_numpy(zero_copy_only=False) for i in range(len(cols))]).astype(float)
            for h in np.unique(halves).tolist():
                new = _partial(x[halves == h])
                held[h] = _merged(held[h], new) if h in held else new
        yield _rows([(h, TaskContext.get().partitionId() % MERGED, p) for h, p in held.items()])

    def merge(got: pa.Table) -> pa.Table:
        rows = got.to_pylist()
        parts = [_read(r["n"], r["gaps"], r["mean"], r["square"]) for r in rows]
        return pa.Table.from_batches([_rows([(rows[0]["half"], rows[0]["bucket"], reduce(_merged, parts))])])

    parts = df.select(half.cast("int").alias("half"), *values).mapInArrow(partial, PARTIAL)
    found: dict[int, Partial] = {}
    for r in parts.groupBy("half", "bucket").applyInArrow(merge, PARTIAL).collect():
        new = _read(r.n, r.gaps, r.mean, r.square)
        found[r.half] = _merged(found[r.half], new) if r.half in found else new
    out = {}
    for h, (n, gaps, mean, square) in found.items():
        missing = [c for c, g in zip(cols, gaps) if g]
        if missing:
            raise ValueError(f"missing values in {', '.join(missing)}")
        if not np.isfinite(square).all():
            raise ValueError("a covariance is undefined: values too large or infinite")
        out[h] = Moments(n, mean, square / n)
    return out


def moments(df: DataFrame, cols: Sequence[str]) -> Moments:
    """Moments of ``cols``; no rows or a missing value raise."""
    found = moments_of(df, cols, F.lit(0))
    if not found:
        raise ValueError("no rows")
    return found[0]
