"""Latest rows, star joins and lookups."""

from pyspark.sql import functions as F

from hedonic.functions.keys import add_pin
from hedonic.operators.latest import latest_per_key
from hedonic.operators.lookups import aligned_divide, attach_location, left_lookup_chain
from hedonic.operators.proximity import proximity_counts
from hedonic.operators.skew import join_lookups
from hedonic.plans.base import (
    APPRAISAL_COLUMNS, BUILDING_COLUMNS, PARCEL_COLUMNS, RESIDENTIAL, SALE_COLUMNS, pairs_of, residential_base,
)
from workload.common import VIEWS, cte, load, query, view

def latest_sql(t: str, keys: tuple[str, ...], at: str) -> str:
    """Rows at their key's largest date, and those without a date or a whole key."""
    names = ", ".join(keys)
    unknown = " OR ".join(f"{t}.{k} IS NULL" for k in (*keys, at))
    return f"""SELECT {t}.* FROM {t} LEFT JOIN (SELECT {names}, max({at}) AS top FROM {t} GROUP BY {names}) AS tops
  USING ({names}) WHERE {at} = top OR {unknown}"""


@query("latest_per_key", latest_sql("orders", ("o_custkey",), "o_orderdate"))
def latest(spark, sf):
    return latest_per_key(load(spark, sf, "orders"), ["o_custkey"], "o_orderdate")


VIEWS["gappy_orders"] = (
    "orders",
    (
        "o_orderkey",
        "NULLIF(o_custkey, 5) AS o_custkey",
        "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderdate END AS o_orderdate",
    ),
)


@query("latest_per_key_nulls", cte("gappy_orders") + "\n" + latest_sql("gappy_orders", ("o_custkey",), "o_orderdate"))
def latest_nulls(spark, sf):
    return latest_per_key(view(spark, sf, "gappy_orders"), ["o_custkey"], "o_orderdate")


# Assessor tables played by customers (parcels), parts (buildings) and orders
# (sales and appraisals).
VIEWS["parcel"] = (
    "customer",
    (
        "CAST(c_custkey AS INT) AS Major",
        "CAST(c_custkey % 7 AS INT) AS Minor",
        "CASE WHEN c_mktsegment = 'MACHINERY' THEN 'C' ELSE 'R' END AS PropType",
        "c_nationkey AS Area",
        "c_mktsegment AS DistrictName",
        "CAST(1000 + (c_custkey * 37) % 9000 AS BIGINT) AS SqFtLot",
        "concat('Z', CAST(c_custkey % 5 AS STRING)) AS CurrentZoning",
        "CAST(c_custkey % 2 AS INT) AS Topography",
        "CAST(c_custkey % 3 AS INT) AS StreetSurface",
        "CAST(c_custkey % 4 AS INT) AS InadequateParking",
        "CAST(c_custkey % 11 AS INT) AS PcntUnusable",
        "CAST((c_custkey * 23) % 4 AS INT) AS MtRainier",
        "CAST((c_custkey * 3) % 5 AS INT) AS Olympics",
        "CAST((c_custkey * 7) % 6 AS INT) AS Cascades",
        "CAST((c_custkey * 11) % 7 AS INT) AS SeattleSkyline",
        "CAST((c_custkey * 13) % 8 AS INT) AS PugetSound",
        "CAST((c_custkey * 17) % 9 AS INT) AS LakeWashington",
        "CAST((c_custkey * 19) % 10 AS INT) AS LakeSammamish",
        "CAST(c_custkey % 101 AS INT) AS LotDepthFactor",
        "CAST((c_custkey * 29) % 3 AS INT) AS TrafficNoise",
        "CASE WHEN c_custkey % 4 = 0 THEN 'Y' ELSE 'N' END AS AirportNoise",
        "CASE c_custkey % 6 WHEN 0 THEN 'Y' WHEN 1 THEN NULL ELSE 'N' END AS PowerLines",
        "CAST((c_custkey * 31) % 2 AS INT) AS HistoricSite",
        "CASE WHEN c_custkey % 8 = 0 THEN 'Y' ELSE 'N' END AS SteepSlopeHazard",
        "CASE WHEN c_custkey % 9 = 0 THEN 'Y' ELSE 'N' END AS WaterProblems",
    ),
)
VIEWS["building"] = (
    "part",
    (
        "CAST(p_partkey AS INT) AS Major",
        "CAST(p_partkey % 7 AS INT) AS Minor",
        "CAST(p_size * 100 AS INT) AS SqFtTotLiving",
        "CAST(1 + p_size % 3 AS DOUBLE) AS Stories",
        "CAST(p_size % 4 AS INT) AS BathFullCount",
        "CAST(p_size % 9 AS INT) AS Bedrooms",
        "CAST(1890 + (p_partkey * 7) % 130 AS INT) AS YrBuilt",
        "CAST(CASE WHEN p_partkey % 3 = 0 THEN 1950 + p_size ELSE 0 END AS INT) AS YrRenovated",
        "CAST(p_size % 5 AS INT) AS HeatSystem",
        "CAST(p_size % 2 AS INT) AS BrickStone",
        "CAST(p_size * 40 AS INT) AS SqFtUpperFloor",
    ),
)
VIEWS["sale"] = (
    "orders",
    (
        "CAST(o_custkey AS INT) AS Major",
        "CAST(o_custkey % 7 AS INT) AS Minor",
        "o_orderdate + INTERVAL '15' YEAR AS DocumentDate",
        "CAST(floor(o_totalprice) AS BIGINT) AS SalePrice",
        "CAST(o_orderkey % 20 AS INT) AS SaleReason",
    ),
)
VIEWS["appraisal"] = (
    "orders",
    (
        "CAST(o_custkey AS INT) AS Major",
        "CAST(o_custkey % 7 AS INT) AS Minor",
        "o_orderdate + INTERVAL '15' YEAR AS UpdateDate",
        "CAST(floor(o_totalprice * 3e-1) AS BIGINT) AS LandVal",
        "CAST(floor(o_totalprice * 6e-1) AS BIGINT) AS ImpsVal",
    ),
)
VIEWS["addresses"] = (
    "customer",
    (
        "concat(lpad(CAST(c_custkey AS STRING), 6, '0'), lpad(CAST(c_custkey % 7 AS STRING), 4, '0')) AS pin",
        "c_name AS addr_full",
        "CAST(NULL AS INT) AS gid",
        "CAST((c_custkey * 7919) % 100003 AS DOUBLE) AS point_x",
        "CAST((c_custkey * 104729) % 99991 AS DOUBLE) AS point_y",
        "47 + CAST(c_custkey % 1000 AS DOUBLE) / 1000 AS lat",
        "-122 - CAST(c_custkey % 777 AS DOUBLE) / 1000 AS lon",
    ),
)

ASSESSOR = ("parcel", "building", "sale", "appraisal")


def picked(table: str, columns) -> list[str]:
    """The columns of a source table under their names in the base table."""
    return [f"{table}.{a} AS {b}" for a, b in pairs_of(columns)]


BASE_LIST = [
    "Major", "Minor", *picked("parcel", PARCEL_COLUMNS), *picked("building", BUILDING_COLUMNS),
    *picked("sale", SALE_COLUMNS), *picked("newest", APPRAISAL_COLUMNS), "newest.LandVal + newest.ImpsVal AS appr_tot_val",
]
BASE_SQL = f"""newest AS ({latest_sql('appraisal', ('Major', 'Minor'), 'UpdateDate')}),
base AS (SELECT {', '.join(BASE_LIST)}
  FROM newest JOIN sale USING (Major, Minor) JOIN parcel USING (Major, Minor) JOIN building USING (Major, Minor)
  WHERE parcel.PropType IN ('{RESIDENTIAL}'))"""


@query("residential_base", cte(*ASSESSOR) + ",\n" + BASE_SQL + "\nSELECT * FROM base")
def base(spark, sf):
    return residential_base(*[view(spark, sf, name) for name in ASSESSOR])


@query(
    "base_join",
    """
SELECT c_custkey, o_orderkey, l_linenumber, h.h_date,
       CAST(floor(l_extendedprice) AS BIGINT) + CAST(floor(l_tax * 100) AS BIGINT) AS total
FROM customer JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey
JOIN (SELECT o_custkey AS h_key, max(o_orderdate) AS h_date FROM orders GROUP BY 1) AS h ON h_key = c_custkey
WHERE c_mktsegment = 'BUILDING'
""",
)
def base_join(spark, sf):
    orders = load(spark, sf, "orders")
    newest = latest_per_key(orders.select("o_custkey", "o_orderdate"), ["o_custkey"], "o_orderdate").distinct()
    star = (
        load(spark, sf, "customer").where(F.col("c_mktsegment") == "BUILDING")
        .join(orders.select("o_orderkey", "o_custkey"), F.col("c_custkey") == F.col("o_custkey"))
        .join(load(spark, sf, "lineitem"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(newest.select(F.col("o_custkey").alias("h_key"), F.col("o_orderdate").alias("h_date")),
              F.col("h_key") == F.col("c_custkey"))
    )
    total = F.floor("l_extendedprice").cast("long") + F.floor(F.col("l_tax") * 100).cast("long")
    return star.select("c_custkey", "o_orderkey", "l_linenumber", "h_date", total.alias("total"))


@query(
    "attach_location",
    cte("sales", "addresses")
    + """
SELECT a.pin, o_orderkey, addr_full, gid, point_x, point_y FROM sales JOIN addresses AS a
ON a.pin = concat(lpad(CAST(o_custkey AS STRING), 6, '0'), lpad(CAST(o_custkey % 7 AS STRING), 4, '0'))
""",
)
def located(spark, sf):
    sales = view(spark, sf, "sales").withColumn("Minor", F.col("o_custkey") % 7)
    rows = attach_location(add_pin(sales, "o_custkey", "Minor"), view(spark, sf, "addresses"))
    return rows.select("pin", "o_orderkey", "addr_full", "gid", "point_x", "point_y")


@query(
    "lookup_chain",
    """
SELECT c_custkey AS key, n_orders, CAST(floor(p_retailprice) AS BIGINT) AS price, s_name
FROM customer
LEFT JOIN (SELECT o_custkey AS key, count(*) AS n_orders FROM orders GROUP BY 1) AS o ON o.key = c_custkey
LEFT JOIN part ON p_partkey = c_custkey
LEFT JOIN supplier ON s_suppkey = c_custkey
""",
)
def chain(spark, sf):
    orders = load(spark, sf, "orders").groupBy(F.col("o_custkey").alias("key")).agg(F.count("*").alias("n_orders"))
    part = load(spark, sf, "part").select(
        F.col("p_partkey").alias("key"), F.floor("p_retailprice").cast("long").alias("price")
    )
    supplier = load(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"), "s_name")
    props = load(spark, sf, "customer").select(F.col("c_custkey").alias("key"))
    return left_lookup_chain(props, [orders, part, supplier], "key")


# A third of the lines under one key, and a lookup with a crowded key; "hot" is set low enough for both to be cut.
VIEWS["hot_lines"] = ("lineitem", ("CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_suppkey END AS key", "l_quantity"))
VIEWS["hot_parts"] = ("part", ("CASE WHEN p_partkey % 4 = 0 THEN 2 ELSE p_partkey END AS key", "p_name", "p_size"))


@query(
    "lookup_chain_hot",
    cte("hot_lines") + """
SELECT key, l_quantity, s_name, upper(s_phone) AS phone FROM hot_lines LEFT JOIN (SELECT s_suppkey AS key, s_name, s_name AS s_phone FROM supplier) USING (key)
""",
)
def chain_hot(spark, sf):
    lines = view(spark, sf, "hot_lines").withColumn("carried", F.create_map(F.lit("q"), "l_quantity"))
    names = load(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"), "s_name")
    out = join_lookups(lines, [names], ["key"], rows=500)
    return out.select("key", F.col("carried")["q"].alias("l_quantity"), "s_name", F.upper("s_name").alias("phone"))


@query(
    "lookup_chain_crowded",
    cte("hot_parts") + """
SELECT s_suppkey AS key, s_name, p_name, p_size FROM supplier LEFT JOIN hot_parts ON hot_parts.key = s_suppkey
""",
)
def chain_crowded(spark, sf):
    names = load(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"), "s_name")
    return join_lookups(names, [view(spark, sf, "hot_parts")], ["key"], rows=20)


@query(
    "aligned_divide_index",
    cte("sales")
    + """
SELECT coalesce(a.o_custkey, b.o_custkey) AS o_custkey,
       CAST(a.sale_price AS DOUBLE) / NULLIF(b.appr_tot_val, 0) AS ratio
FROM sales AS a FULL JOIN (SELECT * FROM sales WHERE appr_tot_val > 0) AS b ON a.o_custkey = b.o_custkey
""",
)
def divide_index(spark, sf):
    sales = view(spark, sf, "sales")
    positive = sales.where(F.col("appr_tot_val") > 0)
    return aligned_divide(sales, positive, "o_custkey", "sale_price", "appr_tot_val", mode="index")


@query(
    "aligned_divide_rows",
    cte("sales")
    + "\nSELECT o_orderkey, CAST(sale_price AS DOUBLE) / NULLIF(appr_tot_val, 0) AS ratio FROM sales",
)
def divide_rows(spark, sf):
    sales = view(spark, sf, "sales")
    return aligned_divide(sales, sales, "o_orderkey", "sale_price", "appr_tot_val", mode="rows")


@query(
    "valuation_slice",
    cte("props", "pois")
    + """, near AS (
  SELECT p.pin,
    count(CASE WHEN d2 <= 1000.0 * 1000 THEN 1 END) AS parks_counts1000,
    count(CASE WHEN d2 <= 5000.0 * 5000 THEN 1 END) AS parks_counts5000,
    count(CASE WHEN d2 <= 20000.0 * 20000 THEN 1 END) AS parks_counts20000
  FROM (SELECT a.pin, (b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y) AS d2
        FROM props AS a LEFT JOIN (SELECT * FROM pois WHERE layer = 'parks') AS b ON true) AS p GROUP BY p.pin)
SELECT c_custkey, o_orderkey, o_orderdate, parks_counts1000, parks_counts5000, parks_counts20000
FROM customer
JOIN (""" + latest_sql("orders", ("o_custkey",), "o_orderdate") + """) AS l ON l.o_custkey = c_custkey
LEFT JOIN near ON near.pin = CAST(c_custkey AS STRING)
WHERE c_mktsegment = 'BUILDING'
""",
)
def slice_(spark, sf):
    segment = load(spark, sf, "customer").where(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    newest = latest_per_key(
        load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate"), ["o_custkey"], "o_orderdate"
    ).withColumnRenamed("o_custkey", "c_custkey")
    wanted = view(spark, sf, "props").join(segment.select(F.col("c_custkey").cast("string").alias("pin")), "pin", "left_semi")
    counts = proximity_counts(wanted, view(spark, sf, "pois"), ["parks"])
    rows = segment.join(newest, "c_custkey").withColumn("pin", F.col("c_custkey").cast("string"))
    return left_lookup_chain(rows, [counts]).drop("pin")
