"""Named tables and snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed value: rows per INSERT when writing to a database.
BATCH_ROWS = 1000


def write_table(df: DataFrame, name: str, mode: str = "errorifexists") -> None:
    """Save as a catalog table.  ``mode="ignore"`` skips a table that exists."""
    df.write.mode(mode).format("parquet").saveAsTable(name)


def write_jdbc(df: DataFrame, url: str, name: str, mode: str = "errorifexists", batch: int = BATCH_ROWS, **options) -> None:
    """Insert into a database table, ``batch`` rows at a time from every partition."""
    df.write.mode(mode).format("jdbc").options(url=url, dbtable=name, batchsize=batch, **options).save()


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_jdbc(spark: SparkSession, url: str, name: str, column: str, lower: int, upper: int, partitions: int, **options) -> DataFrame:
    """Read a database table in ``partitions`` ranges of a numeric ``column``."""
    split = {"partitionColumn": column, "lowerBound": lower, "upperBound": upper, "numPartitions": partitions}
    return spark.read.format("jdbc").options(url=url, dbtable=name, **split, **options).load()


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Drop and rebuild the table ``name`` from ``df``, and continue from the stored rows.

    ``df`` must not read the table it replaces.
    """
    df.write.mode("overwrite").format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def save_snapshot(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def load_snapshot(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
