"""Row counts, frequency tables, summaries and missing-value reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hedonic.operators.quantiles import approx_quantiles, exact_quantiles

QUARTILES = [0.25, 0.5, 0.75]


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def shape(df: DataFrame) -> DataFrame:
    """One row with the numbers of rows and columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def column_types(df: DataFrame) -> dict[str, str]:
    return dict(df.dtypes)


def count_by_year(df: DataFrame, col: str) -> DataFrame:
    """Rows per calendar year of ``col``; missing dates form no group."""
    return df.where(F.col(col).isNotNull()).groupBy(F.year(col).alias("year")).agg(F.count(col).alias("n"))


def value_counts(df: DataFrame, col: str, n: int | None = None) -> DataFrame:
    """Frequency of each non-NULL value, most frequent first, ties by value."""
    counts = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    ordered = counts.orderBy(F.desc("n"), F.asc("value"))
    return ordered if n is None else ordered.limit(n)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def unpivot(df: DataFrame, cols: list[str], as_type: str = "double") -> DataFrame:
    """Long form: one row per input row and column, ``(column, value)``."""
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast(as_type).alias("value")) for c in cols]
    return df.select(F.inline(F.array(*pairs)))


def describe(df: DataFrame, cols: list[str] | None = None, approx: bool = False) -> DataFrame:
    """Count, mean, sample deviation, extremes and quartiles of numeric columns, also of wholly missing ones."""
    cols = cols or numeric_columns(df)
    known = [F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in cols]
    rules = (("count", F.count), ("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))
    one = df.select(*[v.alias(f"v{i}") for i, v in enumerate(known)]).agg(
        *[rule(f"v{i}").alias(f"{name}{i}") for i in range(len(cols)) for name, rule in rules]
    )
    lines = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"{name}{i}").alias(name) for name, _ in rules]) for i, c in enumerate(cols)
    ]
    moments = one.select(F.inline(F.array(*lines)))
    present = unpivot(df, cols).where(F.col("value").isNotNull() & ~F.isnan("value"))
    if approx:
        marks = approx_quantiles(present, "value", ["column"], QUARTILES)
    else:
        marks = exact_quantiles(present, "value", ["column"], QUARTILES)
    return moments.join(marks, "column", "left").select(
        "column", "count", "mean", "std", "min",
        F.col("q0").alias("q25"), F.col("q1").alias("q50"), F.col("q2").alias("q75"), "max",
    )


def is_missing(df: DataFrame, col: str) -> Column:
    """NULL, or NaN in a floating-point column."""
    if isinstance(df.schema[col].dataType, (T.DoubleType, T.FloatType)):
        return F.col(col).isNull() | F.isnan(col)
    return F.col(col).isNull()


def missing_report(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Number and percentage of missing values per column, in one aggregate."""
    cols = cols or df.columns
    sums = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(is_missing(df, c)).alias(f"_m{i}") for i, c in enumerate(cols)],
    )
    pairs = [F.struct(F.lit(c).alias("column"), F.col(f"_m{i}").alias("missing")) for i, c in enumerate(cols)]
    return sums.select("_rows", F.inline(F.array(*pairs))).select(
        "column", "missing", (F.try_divide(F.col("missing") * F.lit(100.0), F.col("_rows"))).alias("percent")
    )


def profile_columns(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Distinct values, with counts, of the text and integer columns as one long table."""
    kinds = (T.StringType, T.IntegralType)
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]
    types = dict(df.dtypes)
    named = F.create_map(*[F.lit(x) for c in cols for x in (c, types[c])])
    counts = unpivot(df, cols, "string").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("column", named[F.col("column")].alias("type"), "value", "n")


def head(df: DataFrame, n: int, *order) -> DataFrame:
    """First ``n`` rows, ordered when an order is given."""
    return (df.orderBy(*order) if order else df).limit(n)


def extremes(df: DataFrame, col: str, k: int = 13, tie: list[str] | None = None) -> DataFrame:
    """The ``k`` smallest and ``k`` largest rows by ``col``, ties broken by ``tie``.

    With fewer than ``2 k`` rows the two ends overlap and rows repeat.
    """
    tie = tie or []
    low = df.orderBy(F.asc(col), *map(F.asc, tie)).limit(k)
    high = df.orderBy(F.desc(col), *map(F.desc, tie)).limit(k)
    return low.unionByName(high)
