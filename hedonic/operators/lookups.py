"""Joins that add columns to a property table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hedonic.operators.skew import join_lookups


def attach_location(df: DataFrame, addr: DataFrame, key: str = "pin") -> DataFrame:
    """Inner join of properties to their address rows."""
    return join_lookups(df, [addr], [key], "inner")


def left_lookup_chain(df: DataFrame, lookups: list[DataFrame], key: str = "pin") -> DataFrame:
    """Left join each lookup in turn; a key missing from a lookup yields NULLs.

    Row order and row multiplicity follow SQL: several lookup rows for one key
    repeat the property row.
    """
    return join_lookups(df, lookups, [key], "left")


def aligned_divide(
    a: DataFrame, b: DataFrame, key: str, num: str, den: str, mode: str = "rows", out: str = "ratio"
) -> DataFrame:
    """``a.num / b.den`` aligned on ``key``; division by zero gives NULL.

    ``mode="rows"`` divides inside each row of ``a``, which then holds both
    columns (``b`` is not read).  ``mode="index"`` aligns two tables the way
    index arithmetic does: every row of ``a`` meets every row of ``b`` under the
    same key, and unmatched keys of both sides stay with a NULL ratio.  Its
    result is as large as the product of a key's rows, so prefer ``rows`` where
    keys repeat.
    """
    if mode == "rows":
        return a.select(key, ratio(F.col(num), F.col(den)).alias(out))
    if mode != "index":
        raise ValueError(f"mode must be 'index' or 'rows', not {mode!r}")
    left = a.select(key, F.col(num).alias("_num"))
    right = b.select(key, F.col(den).alias("_den"))
    return left.join(right, key, "full").select(key, ratio(F.col("_num"), F.col("_den")).alias(out))


def ratio(num: Column, den: Column) -> Column:
    return F.try_divide(num.cast("double"), den.cast("double"))
