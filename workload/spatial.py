"""Projection, layers, buffers and proximity counts."""

import math

from pyspark.sql import functions as F

from hedonic.functions.geo import project_2926, ring_distance
from hedonic.operators.layers import LayerSpec, poi_layer
from hedonic.operators.proximity import RADII, outline_counts, proximity_counts
from workload.common import VIEWS, cte, load, query, view

LAYERS = ("landmarks", "light_rail", "parks", "priv_school", "pub_school")
OFFSETS = "(b.x - a.x) AS dx, (b.y - a.y) AS dy"


def count_columns(test: str, layers=LAYERS, radii=RADII) -> str:
    """One conditional count per layer and radius; ``test`` speaks of ``{r}``."""
    return ",\n".join(
        f"count(CASE WHEN layer = '{layer}' AND {test.format(r=f'{r}e0')} THEN 1 END) AS {layer}_counts{r}"
        for layer in layers
        for r in radii
    )


CIRCLE = "dx * dx + dy * dy <= {r} * {r}"


def matrix_sql(props: str, test: str = CIRCLE, layers=LAYERS) -> str:
    return f"""
SELECT pin, {count_columns(test, layers)}
FROM (SELECT a.pin, b.layer, {OFFSETS} FROM {props} AS a LEFT JOIN pois AS b ON true) GROUP BY pin
"""


@query("proximity_one", cte("props", "pois") + matrix_sql("props", layers=("parks",)))
def one(spark, sf):
    return proximity_counts(view(spark, sf, "props"), view(spark, sf, "pois"), ["parks"])


@query("proximity_matrix", cte("props", "pois") + matrix_sql("props"))
def matrix(spark, sf):
    return proximity_counts(view(spark, sf, "props"), view(spark, sf, "pois"), LAYERS)


@query("proximity_matrix_rows", cte("visits", "pois") + matrix_sql("visits"))
def matrix_rows(spark, sf):
    return proximity_counts(view(spark, sf, "visits"), view(spark, sf, "pois"), LAYERS, mode="rows")


@query("proximity_matrix_distinct", cte("visits", "pois") + matrix_sql("(SELECT DISTINCT * FROM visits)"))
def matrix_distinct(spark, sf):
    return proximity_counts(view(spark, sf, "visits"), view(spark, sf, "pois"), LAYERS, mode="distinct")


# A sixteenth of pi is the angle of one side of the 32-sided buffer.
STEP = math.pi / 16
ANGLE = f"(atan2(dy, dx) - {STEP}e0 * floor(atan2(dy, dx) / {STEP}e0) - {STEP / 2}e0)"
POLYGON = f"sqrt(dx * dx + dy * dy) * cos({ANGLE}) <= {{r}} * {math.cos(STEP / 2)}e0"


@query("proximity_polygon", cte("props", "pois") + matrix_sql("props", POLYGON))
def polygon(spark, sf):
    return proximity_counts(view(spark, sf, "props"), view(spark, sf, "pois"), LAYERS, quad_segs=8)


# A rectangle around each customer's point, wider than high.
def rectangle(x, y):
    corners = ((-300.0, -150.0), (300.0, -150.0), (300.0, 150.0), (-300.0, 150.0))
    return F.array(*[F.struct((x + dx).alias("x"), (y + dy).alias("y")) for dx, dy in corners])


BOX = (
    "pow(greatest(abs(b.x - a.x) - 300.0, 0.0), 2) + pow(greatest(abs(b.y - a.y) - 150.0, 0.0), 2)"
)


@query(
    "outline_counts",
    cte("props", "pois")
    + f"""
SELECT pin, {count_columns('sqrt(d2) <= {r}')}
FROM (SELECT a.pin, b.layer, {BOX} AS d2 FROM props AS a LEFT JOIN pois AS b ON true) GROUP BY pin
""",
)
def outlines(spark, sf):
    props = view(spark, sf, "props").select("pin", rectangle(F.col("x"), F.col("y")).alias("ring"))
    return outline_counts(props, view(spark, sf, "pois"), LAYERS)


# Places far from the origin next to a small radius, one of them at no finite place.
FAR = 1_000_000_000_000
VIEWS["far_props"] = (
    "customer",
    (
        "CAST(c_custkey AS STRING) AS pin",
        f"CASE WHEN c_custkey = 7 THEN CAST('Infinity' AS DOUBLE) ELSE CAST({FAR} + c_custkey % 37 AS DOUBLE) END AS x",
        f"CAST(c_custkey % 41 - {FAR} AS DOUBLE) AS y",
    ),
)
VIEWS["far_pois"] = (
    "part",
    ("'parks' AS layer", f"CAST({FAR} + p_partkey % 43 AS DOUBLE) AS x", f"CAST(p_partkey % 47 - {FAR} AS DOUBLE) AS y"),
)


@query(
    "proximity_far_coordinates",
    cte("far_props", "far_pois")
    + """
SELECT pin, count(CASE WHEN dx * dx + dy * dy <= 1 THEN 1 END) AS parks_counts1
FROM (SELECT a.pin, b.x - a.x AS dx, b.y - a.y AS dy FROM far_props AS a LEFT JOIN far_pois AS b ON true) GROUP BY pin
""",
)
def far_away(spark, sf):
    return proximity_counts(view(spark, sf, "far_props"), view(spark, sf, "far_pois"), ["parks"], [1])


@query(
    "outline_distance",
    """
SELECT c_custkey, round(sqrt(pow(greatest(abs(px - x) - 300.0, 0.0), 2) + pow(greatest(abs(py - y) - 150.0, 0.0), 2)), 6)
  AS distance
FROM (SELECT c_custkey, CAST((c_custkey * 7919) % 100003 AS DOUBLE) AS x, CAST((c_custkey * 104729) % 99991 AS DOUBLE) AS y,
  CAST((c_custkey * 7919) % 100003 + c_nationkey * 40 - 400 AS DOUBLE) AS px,
  CAST((c_custkey * 104729) % 99991 + c_custkey % 700 - 350 AS DOUBLE) AS py FROM customer)
""",
)
def outline(spark, sf):
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    x, y = ((k * 7919) % 100003).cast("double"), ((k * 104729) % 99991).cast("double")
    distance = ring_distance(x + n * 40 - 400, y + k % 700 - 350, rectangle(x, y))
    return load(spark, sf, "customer").select("c_custkey", F.round(distance, 6).alias("distance"))


VIEWS["lonlat"] = (
    "customer",
    (
        "c_custkey",
        "CASE WHEN c_custkey % 50 = 7 THEN NULL ELSE -122.5 + CAST(c_custkey % 997 AS DOUBLE) / 997 END AS Longitude",
        "47.1 + CAST(c_custkey % 773 AS DOUBLE) / 773 AS Latitude",
    ),
)

# Ellipsoid and cone constants, worked out by hand for the oracle.
E = 0.0818191910428158
N = 0.744520326553006
AF = 11670409.555905715
RHO0 = 5853778.603831483


def project_sql(extra: str) -> str:
    return f"""
SELECT {extra}, round((500000.0001016001 + rho * sin(theta)) / 0.3048006096012192, 2) AS x,
  round(({RHO0}e0 - rho * cos(theta)) / 0.3048006096012192, 2) AS y
FROM (SELECT *, {AF}e0 * pow(tan(pi() / 4 - radians(Latitude) / 2)
    / pow((1 - {E}e0 * sin(radians(Latitude))) / (1 + {E}e0 * sin(radians(Latitude))), {E}e0 / 2), {N}e0) AS rho,
    {N}e0 * radians(Longitude + 120 + 50e0 / 60) AS theta FROM lonlat)
"""


@query("project_point", cte("lonlat") + project_sql("c_custkey"))
def project(spark, sf):
    x, y = project_2926(F.col("Longitude"), F.col("Latitude"))
    points = view(spark, sf, "lonlat").select("c_custkey", x.alias("x"), y.alias("y"))
    return points.select("c_custkey", F.round("x", 2).alias("x"), F.round("y", 2).alias("y"))


@query(
    "poi_layer",
    cte("lonlat")
    + project_sql("'parks' AS layer, Longitude AS long, Latitude AS lat, CAST(NULL AS INT) AS gid"),
)
def layer(spark, sf):
    spec = LayerSpec("Parks_Map", "parks", "Longitude", "Latitude")
    points = poi_layer(view(spark, sf, "lonlat"), spec, gid="null")
    return points.select("layer", "long", "lat", "gid", F.round("x", 2).alias("x"), F.round("y", 2).alias("y"))

