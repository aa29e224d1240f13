"""Coordinates written as text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parse_point(df: DataFrame, col: str = "Shape", lat: str = "lat", long: str = "long") -> DataFrame:
    """Split ``"(lat, long)"`` text into two doubles; no such column leaves ``df`` as it is."""
    if col not in df.columns:
        return df
    text = F.col(col)
    parts = F.split(F.substring(text, F.lit(2), F.length(text) - 2), ", ")
    return df.withColumns(
        {lat: F.get(parts, 0).cast("double"), long: F.get(parts, 1).cast("double")}
    )
