"""Parcel keys: cleaning the two-part id and composing the ten-digit pin."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Widths of the two parts of a pin.
MAJOR_WIDTH = 6
MINOR_WIDTH = 4

# The characters Python's ``str.strip`` removes.
WHITESPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0" + "".join(
    map(chr, (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
)


def strip(col: Column) -> Column:
    """Remove leading and trailing whitespace of every kind (``trim`` only knows spaces)."""
    return F.btrim(col, F.lit(WHITESPACE))


def to_int(col: Column, strict: bool = True) -> Column:
    """Text to integer; bad text raises, or becomes NULL when not ``strict``."""
    number = col.try_cast("double").try_cast("int")
    if not strict:
        return number
    message = F.concat(F.lit("not a number: "), col)
    return F.when(col.isNull() | number.isNotNull(), number).otherwise(
        F.raise_error(message).cast("int")
    )


def clean_keys(df: DataFrame, cols: list[str], strict: bool = True) -> DataFrame:
    """Strip the id columns, drop rows where any is NULL or blank, cast to integer.

    ``strict`` raises on text that is no number; otherwise such rows are dropped too.
    """
    stripped = df.withColumns({c: strip(F.col(c).cast("string")) for c in cols})
    kept = stripped
    for c in cols:
        kept = kept.where(F.col(c).isNotNull() & (F.col(c) != ""))
    numbers = kept.withColumns({c: to_int(F.col(c), strict) for c in cols})
    return numbers if strict else numbers.dropna(subset=cols)


def zfill(col: Column, width: int) -> Column:
    """Left-pad with zeros; longer text stays whole (``lpad`` alone would cut it)."""
    text = col.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def add_pin(df: DataFrame, major: str = "Major", minor: str = "Minor") -> DataFrame:
    """Add ``major_str``, ``minor_str`` and their concatenation ``pin``."""
    major_str = zfill(F.col(major), MAJOR_WIDTH)
    minor_str = zfill(F.col(minor), MINOR_WIDTH)
    return df.withColumns(
        {"major_str": major_str, "minor_str": minor_str, "pin": F.concat(major_str, minor_str)}
    )
