"""Row predicates.  All are plain columns, so filters reach the scan."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sale-reason codes that do not describe a market sale.
BAD_SALE_REASONS = (10, 8, 13, 11, 18)

# Limits of a usable sale.
RECENT_YEAR = 2013
PRICE_FLOOR = 80000
PRICE_CEILING = 4000000
GOOD_SHARE = 0.2


def exclude_codes(df: DataFrame, col: str, codes: Iterable = BAD_SALE_REASONS) -> DataFrame:
    """Drop rows with one of ``codes``; a NULL code is kept (``NOT IN`` alone drops it)."""
    return df.where(~F.coalesce(F.col(col).isin(list(codes)), F.lit(False)))


def between_open(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """Rows strictly inside ``(lo, hi)``."""
    return df.where((F.col(col) > lo) & (F.col(col) < hi))


def below(df: DataFrame, col: str, upper) -> DataFrame:
    """Rows strictly under ``upper``."""
    return df.where(F.col(col) < upper)


def sale_filters(
    date: str = "sale_date",
    price: str = "sale_price",
    value: str = "appr_tot_val",
    recent_year: int = RECENT_YEAR,
    lo: float = PRICE_FLOOR,
    hi: float = PRICE_CEILING,
    good: str = "ratio",
) -> dict[str, Column]:
    """The four sale-quality predicates; combine them with ``&``.

    ``good="ratio"`` compares ``|price / value|`` with a fifth of the value, as
    the original analysis does; ``good="band"`` asks for a price within a fifth
    of the value.  Missing input and a zero value count as not good.
    """
    p, v = F.col(price).cast("double"), F.col(value).cast("double")
    if good == "ratio":
        test = F.abs(F.try_divide(p, v)) < v * GOOD_SHARE
    elif good == "band":
        test = (v != 0) & (F.abs(p - v) < v * GOOD_SHARE)
    else:
        raise ValueError(f"good must be 'ratio' or 'band', not {good!r}")
    false = F.lit(False)
    return {
        "recent": F.coalesce(F.year(date) >= recent_year, false),
        "under": F.coalesce(F.col(price) <= hi, false),
        "nonzero": F.coalesce(F.col(price) > lo, false),
        "good": F.coalesce(test, false),
    }
