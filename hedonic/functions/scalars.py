"""Small column rewrites used while preparing features."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clean_dates(df: DataFrame, cols: list[str]) -> DataFrame:
    """Text or timestamp columns to zone-free timestamps cut to midnight."""
    return df.withColumns({c: F.col(c).cast("date").cast("timestamp_ntz") for c in cols})


def nan_to_null(df: DataFrame) -> DataFrame:
    """NULL for NaN in the floating-point columns, so that one kind of missing value is left."""
    floats = [c for c, t in df.dtypes if t in ("float", "double")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def year_of(col: Column | str) -> Column:
    return F.year(col)


def log1p_cols(df: DataFrame, cols: list[str], prefix: str = "") -> DataFrame:
    """``log(x + 1)`` of each column, in place or under ``prefix``."""
    return df.withColumns({prefix + c: F.log1p(c) for c in cols})


def map_values(df: DataFrame, col: str, mapping: Mapping, out: str | None = None) -> DataFrame:
    """Replace values by lookup in ``mapping``; anything else becomes NULL."""
    expr = F.lit(None)
    for key, value in mapping.items():
        expr = F.when(F.col(col) == F.lit(key), F.lit(value)).otherwise(expr)
    return df.withColumn(out or col, expr)


def replace_where(df: DataFrame, col: str, cond: Column, value) -> DataFrame:
    """Overwrite ``col`` where ``cond`` holds."""
    return df.withColumn(col, F.when(cond, F.lit(value)).otherwise(F.col(col)))
