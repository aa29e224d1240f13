"""Input and naming helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: name -> query over the tables of a directory
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: name -> DuckDB SQL, where SQL can state the result
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name``."""

    def add(run):
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tasks_for(rows: int, each: int) -> int:
    """Partitions for ``rows`` rows of about ``each`` per task; grows with the rows, without a cap."""
    return max(1, -(-rows // each))


def unsigned_crc32(text: str):
    """CRC-32 of a text's UTF-8 bytes, a missing text counting as empty."""
    return F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary"))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` computed once."""
    return F.transform(F.array(value), use)[0]


def unused(stem: str, *frames: DataFrame) -> str:
    """``stem``, with underscores added until no frame has such a column."""
    taken = {c.lower() for df in frames for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def _own(df: DataFrame) -> list[str]:
    return [f"`{c}`" for c in df.columns]


def _marked(df: DataFrame, keys: DataFrame, column: str, bits: int) -> tuple[DataFrame, DataFrame, str]:
    """``df`` with the hash bucket of ``column``, the distinct buckets of ``keys``, and that column's name."""
    name = unused("_bucket", df)
    bucket = F.pmod(F.xxhash64(F.col(column)), F.lit(1 << bits)).cast("int")
    return df.withColumn(name, bucket), keys.select(bucket.alias(name)).distinct(), name


def rows_near(df: DataFrame, keys: DataFrame, column: str, bits: int = 18) -> DataFrame:
    """The rows of ``df`` whose ``column`` falls into a hash bucket of some row of ``keys``.

    A cheap sieve before a join on ``column``: it loses no partner, and what it broadcasts
    has at most ``2 ** bits`` whole numbers, however many keys there are.
    """
    rows, marks, name = _marked(df, keys, column, bits)
    return rows.join(F.broadcast(marks), name, "left_semi").select(*_own(df))


def rows_outside(df: DataFrame, keys: DataFrame, column: str, bits: int = 18) -> DataFrame:
    """The other rows: what :func:`rows_near` leaves out."""
    rows, marks, name = _marked(df, keys, column, bits)
    return rows.join(F.broadcast(marks), name, "left_anti").select(*_own(df))


def rows_without(df: DataFrame, keys: DataFrame, column: str, bits: int = 18) -> DataFrame:
    """The rows of ``df`` whose ``column`` is in no row of ``keys``; only rows behind the same sieve are shuffled."""
    near = rows_near(df, keys, column, bits).join(keys, column, "left_anti")
    return rows_outside(df, keys, column, bits).union(near.select(*_own(df)))


def running_before(df: DataFrame, order: str, value: str, name: str, each: int = 4096) -> DataFrame:
    """``order`` and the sum ``name`` of ``value`` over all smaller ``order`` (a small whole number).

    Sums stretches of ``each`` numbers first, so the one ordered pass over everything sees
    a row per stretch.
    """
    stretch = F.floor(F.col(order) / each).cast("long")
    rows = df.select(order, value, stretch.alias("_stretch"))
    sums = rows.groupBy("_stretch").agg(F.sum(value).alias("_sum"))
    before = Window.orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    ahead = sums.select("_stretch", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_ahead"))
    inside = Window.partitionBy("_stretch").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    local = rows.select(order, "_stretch", F.coalesce(F.sum(value).over(inside), F.lit(0)).alias("_local"))
    return local.join(ahead, "_stretch").select(order, (F.col("_local") + F.col("_ahead")).alias(name))
