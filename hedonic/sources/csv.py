"""Directories of CSV files to tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from pathlib import PurePosixPath
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from hedonic.functions.points import parse_point
from hedonic.functions.scalars import nan_to_null
from hedonic.sources.tables import write_table

# File naming and text encoding of the assessor extracts.
PREFIX = "EXTR_"
SUFFIX = ".csv"
LATIN1 = "ISO-8859-1"


def table_name(path: str) -> str:
    """File name without the extract prefix and the ``.csv`` suffix."""
    name = PurePosixPath(path).name
    return name.removeprefix(PREFIX).removesuffix(SUFFIX)


def list_csv(spark: SparkSession, directory: str) -> list[str]:
    """Paths of the CSV files in ``directory``, on any file system Spark can read."""
    files = spark.read.option("pathGlobFilter", f"*{SUFFIX}").text(directory).inputFiles()
    return sorted(unquote(f) for f in files)


def read_csv(
    spark: SparkSession, path: str, schema: StructType | str | None = None, encoding: str = "UTF-8",
    line_breaks: bool = False,
) -> DataFrame:
    """One CSV file with a header line and doubled quotes inside quoted text.

    A known table should come with its ``schema``; types are inferred otherwise.
    With ``line_breaks`` quoted text may hold line breaks; such a file is read by one task.
    """
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("encoding", encoding)
    reader = reader.option("multiLine", line_breaks)
    if schema is None:
        return nan_to_null(reader.option("inferSchema", True).csv(path))
    return nan_to_null(reader.schema(schema).csv(path))


def ingest_csv_dir(
    spark: SparkSession,
    directory: str,
    db: str,
    schemas: Mapping[str, StructType | str] | None = None,
    encoding: str = LATIN1,
    name_rule: Callable[[str], str] = table_name,
    mode: str = "errorifexists",
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
    line_breaks: bool = False,
) -> list[str]:
    """Load every CSV file of ``directory`` as a table of ``db``; returns the table names."""
    schemas = schemas or {}
    names = []
    for path in list_csv(spark, directory):
        name = name_rule(path)
        write_table(prepare(read_csv(spark, path, schemas.get(name), encoding, line_breaks)), f"{db}.{name}", mode)
        names.append(name)
    return names


def ingest_open_data(
    spark: SparkSession,
    directory: str,
    db: str,
    schemas: Mapping[str, StructType | str] | None = None,
    name_rule: Callable[[str], str] = table_name,
) -> list[str]:
    """Load open-data CSV files, adding ``lat`` and ``long`` where a ``Shape`` column exists.

    Tables already present are left alone.
    """
    return ingest_csv_dir(spark, directory, db, schemas, "UTF-8", name_rule, "ignore", parse_point)
