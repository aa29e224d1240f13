"""The complete property table and the feature table, end to end."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hedonic.functions.geo import PLANAR_SRID
from hedonic.functions.keys import add_pin
from hedonic.operators.encode import BEDROOM_EDGES, BEDROOM_LABELS
from hedonic.operators.layers import LayerSpec, stack_layers
from hedonic.operators.lookups import attach_location
from hedonic.operators.proximity import RADII, proximity_counts
from hedonic.operators.regress import feature_columns
from hedonic.plans.base import complete, residential_base
from hedonic.plans.features import PROXIMITY_GROUPS, VIEW_GRADES, build_features
from hedonic.plans.valuation import located_counts
from hedonic.session import cut
from workload.common import VIEWS, cte, query, view
from workload.features import axes_sql, case, part_sql
from workload.joins import ASSESSOR, BASE_SQL
from workload.roundtrips import frame
from workload.spatial import CIRCLE, LAYERS, OFFSETS, count_columns

SPECS = tuple(LayerSpec(name, name, "x", "y", PLANAR_SRID) for name in LAYERS)


def complete_table(spark, sf) -> DataFrame:
    parts = {name: view(spark, sf, name) for name in ASSESSOR}
    addresses = view(spark, sf, "addresses")
    base = cut(add_pin(residential_base(*parts.values())))
    located = cut(attach_location(base, addresses.drop("lat", "lon")))
    pois = view(spark, sf, "pois")
    layered = stack_layers(lambda name: pois.where(F.col("layer") == name), SPECS)
    props = located.select("pin", F.col("point_x").alias("x"), F.col("point_y").alias("y"))
    return complete(located, addresses, proximity_counts(props, layered, LAYERS), LAYERS)


def outlined_table(spark, sf) -> DataFrame:
    """The same with parcels as frames: a square with a hole, and a part beside it."""
    parts = {name: view(spark, sf, name) for name in ASSESSOR}
    addresses = view(spark, sf, "addresses")
    base = cut(add_pin(residential_base(*parts.values())))
    rings = frame(F.col("point_x"), F.col("point_y"))
    located = cut(attach_location(base, addresses.drop("lat", "lon").withColumn("rings", rings)))
    counts = located_counts(located, view(spark, sf, "pois"), LAYERS, geometry="outline")
    return complete(located.drop("rings"), addresses, counts, LAYERS)


PIN_SQL = "concat(lpad(CAST(Major AS STRING), 6, '0'), lpad(CAST(Minor AS STRING), 4, '0'))"
COMPLETE_SQL = (
    cte(*ASSESSOR, "addresses", "pois")
    + ",\n"
    + BASE_SQL
    + f""",
located AS (SELECT base.*, lpad(CAST(Major AS STRING), 6, '0') AS major_str, lpad(CAST(Minor AS STRING), 4, '0') AS minor_str,
  a.pin, a.addr_full, a.point_x AS x, a.point_y AS y FROM base JOIN addresses AS a ON a.pin = {PIN_SQL}),
places AS (SELECT pin, x, y, count(*) AS m FROM located GROUP BY pin, x, y),
tests AS (SELECT a.pin, a.m, b.layer, {OFFSETS} FROM places AS a LEFT JOIN pois AS b ON true),
counts AS (SELECT pin, any_value(m) AS m, {count_columns(CIRCLE)} FROM tests GROUP BY pin),
complete AS (SELECT l.* EXCLUDE (x, y), p.lat, p.lon,
  {', '.join(f'CAST(m * {layer}_counts{r} AS BIGINT) AS {layer}_counts{r}' for layer in LAYERS for r in RADII)}
  FROM located AS l LEFT JOIN addresses AS p ON p.pin = l.pin LEFT JOIN counts AS c ON c.pin = l.pin)
"""
)


def square(cx: str, w: float) -> str:
    """Squared distance to a filled square."""
    return f"(pow(greatest(abs(dx - {cx}) - {w}, 0.0), 2) + pow(greatest(abs(dy) - {w}, 0.0), 2))"


# Inside the hole the nearest side of the inner square counts.
HOLE = "CASE WHEN greatest(abs(dx), abs(dy)) < 60.0 THEN pow(60.0 - greatest(abs(dx), abs(dy)), 2) ELSE " + square("0.0", 100.0) + " END"
FRAME = f"sqrt(least({HOLE}, {square('400.0', 50.0)})) <= {{r}}"


@query("complete_table_outline", COMPLETE_SQL.replace(count_columns(CIRCLE), count_columns(FRAME)) + "SELECT * FROM complete")
def whole_outline(spark, sf):
    return outlined_table(spark, sf)


@query("complete_table", COMPLETE_SQL + "SELECT * FROM complete")
def whole(spark, sf):
    return complete_table(spark, sf)


def feature_sql() -> str:
    prox = ", ".join(
        f"{layer}_counts{r} AS {group}_{i}"
        for group, layer in PROXIMITY_GROUPS.items()
        for i, r in enumerate(RADII[-2:], start=1)
    )
    dists = ", ".join(
        f"CASE WHEN DistrictName = '{d}' THEN 1 ELSE 0 END AS dist_{d}" for d in ("BUILDING", "FURNITURE", "HOUSEHOLD")
    )
    return COMPLETE_SQL + f"""
SELECT pin, {dists}, Topography, CASE WHEN StreetSurface = 1 THEN 1 ELSE 0 END AS str_surf_1,
  CASE WHEN StreetSurface = 2 THEN 1 ELSE 0 END AS str_surf_2,
  CASE PowerLines WHEN 'Y' THEN 1 WHEN 'N' THEN 0 END AS PowerLines, HistoricSite, no_stories, bath_count,
  CAST({case('bedroom_count', BEDROOM_EDGES, BEDROOM_LABELS)} AS DOUBLE) AS bin_bedroom_count,
  CASE WHEN year_renovated = 0 THEN 2000 ELSE year_renovated END AS year_renovated, year_built, ParcSqFtLot,
  SqFtTotLiving, sq_ft_upper_floor, {prox}, lat, lon, appr_tot_val, appr_date, sale_date, sale_price
FROM complete
WHERE year(sale_date) >= 2013 AND sale_price > 80000 AND sale_price <= 4000000
  AND abs(CAST(sale_price AS DOUBLE) / NULLIF(appr_tot_val, 0)) < appr_tot_val * 2e-1
"""


@query("feature_table", feature_sql())
def features(spark, sf):
    return build_features(cut(complete_table(spark, sf))).drop("View_1", "View_2", "View_3")


def viewed_sql() -> str:
    """The feature table with three components of the view grades."""
    plain = feature_sql()
    head, tail = plain.rsplit("\nSELECT pin,", 1)
    where = tail[tail.index("\nWHERE"):]
    parts = ", ".join(f"round({part_sql(n, VIEW_GRADES)}, 6) + 0.0 AS View_{n + 1}" for n in range(3))
    body = tail[: tail.index("\nFROM complete")]
    axes = axes_sql("kept", VIEW_GRADES, 3)
    return (
        head.replace("WITH ", "WITH RECURSIVE ", 1).rstrip()
        + f",\nkept AS (SELECT * FROM complete {where}),\n{axes}\nSELECT pin, {parts}, {body}\nFROM kept, axis0, axis1, axis2"
    )


@query("build_features", viewed_sql())
def full_features(spark, sf):
    out = build_features(cut(complete_table(spark, sf)))
    return out.withColumns({f"View_{n}": F.round(f"View_{n}", 6) + 0.0 for n in (1, 2, 3)})


VIEWS["leaky"] = (
    "orders",
    (
        "o_orderkey", "o_totalprice AS sale_price", "o_custkey", "o_orderdate AS sale_date", "o_custkey AS appr_tot_val",
        "o_orderpriority", "o_orderdate AS appr_date",
    ),
)


@query("feature_columns", "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders")
def without_leaks(spark, sf) -> DataFrame:
    orders = view(spark, sf, "leaky")
    return orders.select(*feature_columns(orders))
