"""Registry of queries and the input views both engines derive from the tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}

# Input views as plain expressions that Spark and DuckDB read alike.
VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {
    "props": (
        "customer",
        (
            "CAST(c_custkey AS STRING) AS pin",
            "CAST((c_custkey * 7919) % 100003 AS DOUBLE) AS x",
            "CAST((c_custkey * 104729) % 99991 AS DOUBLE) AS y",
        ),
    ),
    "pois": (
        "part",
        (
            "CASE p_partkey % 5 WHEN 0 THEN 'landmarks' WHEN 1 THEN 'light_rail' WHEN 2 THEN 'parks' "
            "WHEN 3 THEN 'priv_school' ELSE 'pub_school' END AS layer",
            "CAST((p_partkey * 6151 + 50021) % 100003 AS DOUBLE) AS x",
            "CAST((p_partkey * 15487 + 30011) % 99991 AS DOUBLE) AS y",
        ),
    ),
    # One property row per order: a customer has several, some without a place.
    "visits": (
        "orders",
        (
            "CAST(o_custkey AS STRING) AS pin",
            "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST((o_custkey * 7919) % 100003 AS DOUBLE) END AS x",
            "CAST((o_custkey * 104729) % 99991 AS DOUBLE) AS y",
        ),
    ),
    "sales": (
        "orders",
        (
            "o_orderkey",
            "o_custkey",
            "o_orderdate + INTERVAL '15' YEAR AS sale_date",
            "CAST(floor(o_totalprice) AS BIGINT) AS sale_price",
            "CASE WHEN o_orderkey % 9 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN CAST(0 AS BIGINT) "
            "ELSE CAST((o_orderkey * 31) % 900 AS BIGINT) * 1000 END AS appr_tot_val",
            "NULLIF(CAST(o_orderkey % 20 AS INT), 3) AS sale_reason",
            "o_orderpriority",
        ),
    ),
}


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    table, columns = VIEWS[name]
    return load(spark, sf_dir, table).selectExpr(*columns)


def cte(*names: str) -> str:
    """The ``WITH`` clause giving DuckDB the same views."""
    parts = [f"{n} AS (SELECT {', '.join(VIEWS[n][1])} FROM {VIEWS[n][0]})" for n in names]
    return "WITH " + ",\n".join(parts)


def query(name: str, sql: str | None = None):
    """Register a query under ``name`` with its oracle."""

    def add(run):
        REGISTRY[name] = Query(run, sql)
        return run

    return add


def r6(col: Column | str, name: str | None = None) -> Column:
    """Round for comparison between engines."""
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c, 6).alias(name or col)
