"""Scaling by column statistics and projection on principal components.

Statistics enter as one-row scalar subqueries or literals, so no join is involved.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hedonic.operators.moments import moments


def standardize(df: DataFrame, cols: list[str]) -> DataFrame:
    """``(x - mean) / sample deviation`` of each column; a constant column turns NULL."""
    stats = df.agg(
        F.struct(
            *[F.avg(c).alias(f"mean_{i}") for i, c in enumerate(cols)],
            *[F.stddev_samp(c).alias(f"std_{i}") for i, c in enumerate(cols)],
        )
    ).scalar()
    joined = df.withColumn("_s", stats)
    scaled = {
        c: F.try_divide(F.col(c) - F.col(f"_s.mean_{i}"), F.col(f"_s.std_{i}")) for i, c in enumerate(cols)
    }
    return joined.withColumns(scaled).drop("_s")


def target_stats(df: DataFrame, col: str) -> Column:
    """Mean and population deviation of ``col`` as a scalar-subquery struct."""
    return df.agg(F.struct(F.avg(col).alias("mean"), F.stddev_pop(col).alias("std"))).scalar()


def transform_target(df: DataFrame, col: str, stats: Column | None = None, out: str | None = None) -> DataFrame:
    """``log(z + 1 + 1)`` of the z-score of ``col``; NULL for z at or under -2.

    By default the statistics are those of ``df`` itself, so train and test are
    each scaled by their own; pass ``target_stats(train, col)`` to share them.
    """
    joined = df.withColumn("_s", target_stats(df, col) if stats is None else stats)
    z = F.try_divide(F.col(col) - F.col("_s.mean"), F.col("_s.std"))
    return joined.withColumn(out or col, F.log1p(z + 1)).drop("_s")


def pca_features(df: DataFrame, cols: list[str], k: int = 3, prefix: str = "View") -> DataFrame:
    """Add ``<prefix>_1..k``, the centred projections on the first ``k`` components.

    The components are the leading axes of the columns' covariance.  Missing input
    raises.  A component's sign is free; here its largest loading is made positive.
    """
    m = moments(df, cols)
    _, axes = np.linalg.eigh(m.cov)
    parts = {}
    for j in range(k):
        loading = axes[:, -1 - j]
        if loading[abs(loading).argmax()] < 0:
            loading = -loading
        parts[f"{prefix}_{j + 1}"] = sum(
            ((F.col(c) - float(m.mean[i])) * float(loading[i]) for i, c in enumerate(cols)), F.lit(0.0)
        )
    return df.withColumns(parts)
