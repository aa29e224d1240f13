"""Binned and dummy-coded columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hedonic.operators.skew import join_lookups
from hedonic.session import settle

# Bin edges and labels.
BEDROOM_EDGES = (-0.5, 0.5, 1.5, 2.5, 3.5, 4.5, 5.5, 6.5, 100)
BEDROOM_LABELS = (0, 1, 2, 3, 4, 5, 6, 7)
YEAR_EDGES = (1700, 1800, 1900, 1910, 1920, 1930, 1940, 1950, 1960, 1970, 1980, 1990, 2000, 2010, 2020)
YEAR_LABELS = (1700, 1800, 1900, 1910, 1920, 1930, 1940, 1950, 1960, 1970, 1980, 1990, 2000, 2010)


def bin_column(df: DataFrame, col: str, edges: Sequence, labels: Sequence, out: str | None = None) -> DataFrame:
    """Add ``bin_<col>``: the label of the interval ``(a, b]`` holding the value.

    Values outside all intervals, and missing ones, get NULL.
    """
    if len(labels) != len(edges) - 1:
        raise ValueError("one label per interval is needed")
    value = F.col(col)
    label = F.lit(None)
    for a, b, name in zip(edges[:-1], edges[1:], labels):
        label = F.when((value > a) & (value <= b), F.lit(name)).otherwise(label)
    return df.withColumn(out or f"bin_{col}", label)


def categories(df: DataFrame, col: str) -> list:
    """Sorted distinct values of ``col``: as many as the columns that dummies of it make."""
    return sorted(row[0] for row in df.select(col).where(F.col(col).isNotNull()).distinct().collect())


def numbered(values: DataFrame, col: str, out: str, tasks: int) -> DataFrame:
    """Distinct non-missing values of ``col`` with their place in order, ``out``, from 0 on.

    Values are cut into ranges, which are counted; a value's place is its range's start and
    its rank inside.  Only the ranges' counts, one a task, meet in one place.
    """
    ranges = values.select(col).where(F.col(col).isNotNull()).distinct().repartitionByRange(tasks, col)
    ranges = settle(ranges.withColumn("_range", F.spark_partition_id()))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    starts = starts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(col)) - 1
    placed = ranges.withColumn("_rank", inside).join(starts, "_range")
    return placed.select(col, (F.col("_start") + F.col("_rank")).alias(out))


#: Categories that one task orders.
CATEGORIES_EACH = 200_000


def dummy_vectors(df: DataFrame, col: str, out: str, drop_first: bool = False) -> DataFrame:
    """``df`` with one sparse 0/1 vector per row instead of a column per category, for wide lists.

    Categories are in order of their text; a missing value is 0 everywhere.  They are
    numbered where they are, and rows look their number up, so no list of categories meets
    in one place; a category with very many rows is cut into pieces.
    """
    text, place = "_text", "_place"
    rows = df.withColumn(text, F.col(col).cast("string"))
    distinct = rows.agg(F.approx_count_distinct(text)).head()[0]
    places = settle(numbered(rows, text, place, max(1, -(-distinct // CATEGORIES_EACH))))
    width = max(places.count() - drop_first, 0)
    # What has no place of its own gets the last one, which the encoder leaves out.
    shown = F.col(place) - int(drop_first)
    index = F.when(shown >= 0, shown).otherwise(F.lit(width)).cast("double")
    spread = OneHotEncoder(inputCol="_index", outputCol=out, dropLast=True)
    model = spread.fit(df.sparkSession.createDataFrame([(float(width),)], "_index double"))
    found = join_lookups(rows, [places], [text], "left").withColumn("_index", F.coalesce(index, F.lit(float(width))))
    return model.transform(found).drop(text, place, "_index")


def dummies(
    df: DataFrame,
    col: str,
    prefix: str,
    drop_first: bool = True,
    values: Sequence | None = None,
) -> DataFrame:
    """Add one 0/1 column ``<prefix>_<value>`` per category, by default without the first.

    A missing value is 0 everywhere.  ``values`` fixes the categories, for use on
    rows other than those they were learned from.
    """
    values = categories(df, col) if values is None else list(values)
    shown = values[1:] if drop_first else values
    return df.withColumns(
        {f"{prefix}_{v}": F.coalesce((F.col(col) == F.lit(v)).cast("int"), F.lit(0)) for v in shown}
    )


def proximity_features(df: DataFrame, groups: Mapping[str, Sequence[str]]) -> DataFrame:
    """Add the last two count columns of each group as ``<group>_1`` and ``<group>_2``."""
    added = {}
    for name, cols in groups.items():
        for i, c in enumerate(list(cols)[-2:], start=1):
            added[f"{name}_{i}"] = F.col(c)
    return df.withColumns(added)
