"""Bins, dummies, proximity features, scaling and components."""

from pyspark.sql import functions as F

from hedonic.operators.encode import (
    BEDROOM_EDGES, BEDROOM_LABELS, YEAR_EDGES, YEAR_LABELS, bin_column, dummies, dummy_vectors, proximity_features,
)
from hedonic.operators.proximity import proximity_counts
from hedonic.operators.scale import pca_features, standardize, target_stats, transform_target
from workload.common import VIEWS, cte, load, query, r6, view
from workload.spatial import CIRCLE, LAYERS, OFFSETS, RADII, count_columns

VIEWS["rooms"] = (
    "part",
    (
        "p_partkey",
        "CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE p_size % 9 END AS bedroom_count",
        "CAST(CASE WHEN p_partkey % 23 = 0 THEN 0 ELSE 1690 + (p_partkey * 7) % 340 END AS INT) AS year_built",
    ),
)


def case(col, edges, labels):
    whens = " ".join(f"WHEN {col} > {a} AND {col} <= {b} THEN {n}" for a, b, n in zip(edges, edges[1:], labels))
    return f"CASE {whens} END"


@query(
    "bin_column",
    cte("rooms")
    + f"""
SELECT *, {case('bedroom_count', BEDROOM_EDGES, BEDROOM_LABELS)} AS bin_bedroom_count,
  CAST({case('year_built', YEAR_EDGES, YEAR_LABELS)} AS DOUBLE) AS bin_year_built FROM rooms
""",
)
def bins(spark, sf):
    out = bin_column(view(spark, sf, "rooms"), "bedroom_count", BEDROOM_EDGES, BEDROOM_LABELS)
    out = bin_column(out, "year_built", YEAR_EDGES, YEAR_LABELS)
    return out.withColumn("bin_year_built", F.col("bin_year_built").cast("double"))


VIEWS["segments"] = ("customer", ("c_custkey", "NULLIF(c_mktsegment, 'HOUSEHOLD') AS c_mktsegment"))


@query(
    "dummies",
    cte("segments")
    + """
SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS seg_BUILDING,
  CASE WHEN c_mktsegment = 'FURNITURE' THEN 1 ELSE 0 END AS seg_FURNITURE,
  CASE WHEN c_mktsegment = 'MACHINERY' THEN 1 ELSE 0 END AS seg_MACHINERY FROM segments
""",
)
def segment_dummies(spark, sf):
    return dummies(view(spark, sf, "segments"), "c_mktsegment", "seg").drop("c_mktsegment")


@query(
    "proximity_features",
    cte("props", "pois")
    + f"""
SELECT pin, {", ".join(f"{layer}_counts{r} AS {layer}_prox_{i}" for layer in LAYERS for i, r in ((1, 5000), (2, 20000)))}
FROM (SELECT pin, {count_columns(CIRCLE)}
      FROM (SELECT a.pin, b.layer, {OFFSETS} FROM props AS a LEFT JOIN pois AS b ON true) GROUP BY pin)
""",
)
def prox(spark, sf):
    counts = proximity_counts(view(spark, sf, "props"), view(spark, sf, "pois"), LAYERS)
    out = proximity_features(counts, {f"{layer}_prox": [f"{layer}_counts{r}" for r in RADII] for layer in LAYERS})
    return out.select("pin", *[f"{layer}_prox_{i}" for layer in LAYERS for i in (1, 2)])


@query(
    "dummies_many",
    """
SELECT c_custkey, CAST(row_number() OVER (ORDER BY c_name) - 1 AS INT) AS place, count(*) OVER () AS width FROM customer
""",
)
def dummies_many(spark, sf):
    """A category per customer: sparse vectors, the place of whose single one is shown."""
    names = load(spark, sf, "customer").select("c_custkey", "c_name")
    sparse = F.unwrap_udt(F.col("v"))
    out = dummy_vectors(names, "c_name", "v")
    return out.select("c_custkey", sparse["indices"][0].alias("place"), sparse["size"].cast("long").alias("width"))


@query(
    "standardize",
    """
SELECT o_orderkey, round((o_totalprice - m1) / s1, 6) AS o_totalprice, round((o_custkey - m2) / s2, 6) AS o_custkey
FROM orders, (SELECT avg(o_totalprice) AS m1, stddev_samp(o_totalprice) AS s1, avg(o_custkey) AS m2,
  stddev_samp(o_custkey) AS s2 FROM orders)
""",
)
def scaled(spark, sf):
    orders = load(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_custkey")
    out = standardize(orders, ["o_totalprice", "o_custkey"])
    return out.select("o_orderkey", r6("o_totalprice"), r6("o_custkey"))


TARGET_SQL = """
SELECT o_orderkey, round(CASE WHEN (o_totalprice - m) / s > -2 THEN ln((o_totalprice - m) / s + 2) END, 6) AS target
FROM orders, (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS s FROM orders {where})
"""


@query("transform_target", TARGET_SQL.format(where=""))
def target(spark, sf):
    orders = load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return transform_target(orders, "o_totalprice", out="target").select("o_orderkey", r6("target"))


@query("transform_target_shared", TARGET_SQL.format(where="WHERE o_orderpriority <> '1-URGENT'"))
def target_shared(spark, sf):
    orders = load(spark, sf, "orders")
    stats = target_stats(orders.where(F.col("o_orderpriority") != "1-URGENT"), "o_totalprice")
    return transform_target(orders, "o_totalprice", stats, "target").select("o_orderkey", r6("target"))


def axes_sql(table: str, cols, k: int) -> str:
    """CTEs ``axis0, axis1, ...`` (``v``, a unit vector; ``m``, the means) of the ``k`` leading principal axes of ``table``.

    Repeated squaring of the covariance matrix, kept as one list, leaves its leading
    direction; taking that out of the matrix gives way to the next.
    """
    d = len(cols)
    at = f"range({d * d})"
    pairs = ", ".join(f"covar_pop(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))" for a in cols for b in cols)
    means = ", ".join(f"avg(CAST({c} AS DOUBLE))" for c in cols)
    out = [f"cov0 AS (SELECT [{pairs}] AS m, [{means}] AS mean FROM {table})"]
    for n in range(k):
        squared = (
            f"list_transform({at}, lambda i: list_sum(list_transform(range({d}), lambda l: m[(i // {d}) * {d} + l + 1] * m[l * {d} + i % {d} + 1])))"
        )
        widest = f"list_position(list_transform(range({d}), lambda i: p[i * {d} + i + 1]), list_max(list_transform(range({d}), lambda i: p[i * {d} + i + 1])))"
        out += [
            f"power{n} AS (SELECT 0 AS step, m AS p FROM cov{n} UNION ALL SELECT step + 1, {squared.replace('m[', 'q[')} AS p FROM "
            f"(SELECT step, list_transform(p, lambda x: x / list_max(list_transform(p, lambda y: abs(y)))) AS q FROM power{n} WHERE step < 60))",
            f"raw{n} AS (SELECT list_transform(range({d}), lambda i: p[i * {d} + ({widest})]) AS u FROM power{n} WHERE step = 60)",
            f"unit{n} AS (SELECT list_transform(u, lambda x: x / sqrt(list_dot_product(u, u)) * sign(u[list_position("
            f"list_transform(u, lambda y: abs(y)), list_max(list_transform(u, lambda y: abs(y))))])) AS v FROM raw{n})",
            f"axis{n} AS (SELECT v, mean FROM unit{n}, cov{n})",
            f"value{n} AS (SELECT list_sum(list_transform({at}, lambda i: m[i + 1] * v[i // {d} + 1] * v[i % {d} + 1])) AS e FROM cov{n}, unit{n})",
            f"cov{n + 1} AS (SELECT list_transform({at}, lambda i: m[i + 1] - e * v[i // {d} + 1] * v[i % {d} + 1]) AS m, mean FROM cov{n}, unit{n}, value{n})",
        ]
    return ",\n".join(out)


def part_sql(n: int, cols) -> str:
    """A row's place along an axis."""
    return " + ".join(f"(CAST({c} AS DOUBLE) - axis{n}.mean[{i}]) * axis{n}.v[{i}]" for i, c in enumerate(cols, 1))


GRADES = ("q", "p", "d", "t", "r", "s")
VIEWS["viewed"] = (
    "lineitem",
    (
        "l_orderkey", "l_linenumber", "l_quantity AS q", "l_extendedprice / 1000 AS p", "l_discount * 300 AS d", "l_tax * 100 AS t",
        "CAST(l_partkey % 11 AS DOUBLE) + l_quantity / 10 AS r", "CAST(l_suppkey % 3 AS DOUBLE) AS s",
    ),
)


@query(
    "pca_features",
    cte("viewed").replace("WITH ", "WITH RECURSIVE ", 1)
    + ",\n"
    + axes_sql("viewed", GRADES, 3)
    + f"""
SELECT l_orderkey, l_linenumber, {', '.join(f'round({part_sql(n, GRADES)}, 4) + 0.0 AS part_{n + 1}' for n in range(3))}
FROM viewed, axis0, axis1, axis2
""",
)
def components(spark, sf):
    """Six columns to three components."""
    out = pca_features(view(spark, sf, "viewed"), list(GRADES), 3, "part")
    return out.select("l_orderkey", "l_linenumber", *[(F.round(c, 4) + 0.0).alias(c) for c in ("part_1", "part_2", "part_3")])
