"""Keys, points, dates, filters and column rewrites."""

from functools import reduce

from pyspark.sql import functions as F

from hedonic.functions.keys import add_pin, clean_keys
from hedonic.functions.points import parse_point
from hedonic.functions.predicates import below, between_open, exclude_codes, sale_filters
from hedonic.functions.scalars import clean_dates, log1p_cols, map_values, replace_where, year_of
from workload.common import VIEWS, cte, load, query, r6, view

VIEWS["raw_keys"] = (
    "customer",
    (
        "c_custkey",
        "CASE c_custkey % 5 WHEN 0 THEN concat('  ', CAST(c_custkey AS STRING), ' ') WHEN 1 THEN '   ' "
        "WHEN 2 THEN NULL ELSE concat(CAST(c_custkey AS STRING), chr(9)) END AS Major",
        "CASE WHEN c_nationkey = 3 THEN '' ELSE concat('0', CAST(c_nationkey AS STRING), ' ') END AS Minor",
    ),
)


@query(
    "clean_keys",
    cte("raw_keys")
    + """
SELECT c_custkey, CAST(regexp_replace(Major, '\\s', '', 'g') AS INT) AS Major, CAST(trim(Minor) AS INT) AS Minor
FROM raw_keys
WHERE Major IS NOT NULL AND Minor IS NOT NULL AND regexp_replace(Major, '\\s', '', 'g') <> '' AND trim(Minor) <> ''
""",
)
def keys(spark, sf):
    return clean_keys(view(spark, sf, "raw_keys"), ["Major", "Minor"])


@query(
    "pin_key",
    """
SELECT Major, Minor,
  CASE WHEN length(Major) >= 6 THEN Major ELSE lpad(Major, 6, '0') END AS major_str,
  CASE WHEN length(Minor) >= 4 THEN Minor ELSE lpad(Minor, 4, '0') END AS minor_str,
  CASE WHEN length(Major) >= 6 THEN Major ELSE lpad(Major, 6, '0') END
  || CASE WHEN length(Minor) >= 4 THEN Minor ELSE lpad(Minor, 4, '0') END AS pin
FROM (SELECT CAST(c_custkey * 997 AS STRING) AS Major, CAST(c_nationkey AS STRING) AS Minor FROM customer)
""",
)
def pin(spark, sf):
    ids = load(spark, sf, "customer").select(
        (F.col("c_custkey") * 997).cast("string").alias("Major"), F.col("c_nationkey").cast("string").alias("Minor")
    )
    return add_pin(ids)


VIEWS["shapes"] = (
    "customer",
    (
        "c_custkey",
        "CASE WHEN c_custkey % 10 = 4 THEN NULL ELSE concat('(47.', CAST(c_custkey AS STRING), ', -122.', "
        "CAST(c_nationkey AS STRING), ')') END AS Shape",
    ),
)


@query(
    "parse_point",
    cte("shapes")
    + """
SELECT c_custkey, Shape, CAST('47.' || CAST(c_custkey AS STRING) AS DOUBLE) + CASE WHEN Shape IS NULL THEN NULL ELSE 0 END AS lat,
  CAST('-122.' || split_part(split_part(Shape, '-122.', 2), ')', 1) AS DOUBLE) AS long
FROM shapes
""",
)
def point(spark, sf):
    return parse_point(view(spark, sf, "shapes"))


@query(
    "day_and_year",
    """
SELECT event_id, date_trunc('day', ts) AS ts, CAST(year(ts) AS INT) AS year FROM events
""",
)
def day(spark, sf):
    events = load(spark, sf, "events").select("event_id", F.col("ts").cast("string").alias("ts"))
    return clean_dates(events, ["ts"]).withColumn("year", year_of("ts"))


@query(
    "exclude_codes",
    cte("sales") + "\nSELECT o_orderkey, sale_reason FROM sales WHERE NOT coalesce(sale_reason IN (10, 8, 13, 11, 18), false)",
)
def codes(spark, sf):
    return exclude_codes(view(spark, sf, "sales"), "sale_reason").select("o_orderkey", "sale_reason")


@query(
    "open_range",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 20000 AND o_totalprice < 300000 AND o_totalprice < 250000",
)
def open_range(spark, sf):
    orders = load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return below(between_open(orders, "o_totalprice", 20000, 300000), "o_totalprice", 250000)


FILTER_SQL = """
SELECT o_orderkey, year(sale_date) >= 2013 AS recent, sale_price <= 4000000 AS under, sale_price > 80000 AS nonzero,
  coalesce({good}, false) AS good,
  coalesce(year(sale_date) >= 2013 AND sale_price > 80000 AND sale_price <= 4000000 AND {good}, false) AS kept
FROM sales
"""


def filters(spark, sf, good):
    f = sale_filters(good=good)
    f["kept"] = reduce(lambda a, b: a & b, list(f.values()))
    return view(spark, sf, "sales").select("o_orderkey", *[c.alias(n) for n, c in f.items()])


@query(
    "sale_filters",
    cte("sales")
    + FILTER_SQL.format(good="abs(CAST(sale_price AS DOUBLE) / NULLIF(appr_tot_val, 0)) < appr_tot_val * 2e-1"),
)
def ratio_filters(spark, sf):
    return filters(spark, sf, "ratio")


@query(
    "sale_filters_band",
    cte("sales")
    + FILTER_SQL.format(good="(appr_tot_val <> 0 AND abs(sale_price - appr_tot_val) < appr_tot_val * 2e-1)"),
)
def band_filters(spark, sf):
    return filters(spark, sf, "band")


@query(
    "map_values",
    "SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'R' THEN 1 WHEN 'N' THEN 0 END AS flag FROM lineitem",
)
def mapped(spark, sf):
    lines = load(spark, sf, "lineitem")
    return map_values(lines, "l_returnflag", {"R": 1, "N": 0}, "flag").select("l_orderkey", "l_linenumber", "flag")


@query(
    "replace_where",
    "SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN 2000 ELSE p_size END AS p_size FROM part",
)
def replaced(spark, sf):
    part = load(spark, sf, "part").select("p_partkey", "p_size")
    return replace_where(part, "p_size", F.col("p_size") % 5 == 0, 2000)


@query(
    "log1p_cols",
    """
SELECT l_orderkey, l_linenumber, round(ln(1 + l_quantity), 6) AS l_quantity,
  round(CASE WHEN l_extendedprice - 2000 > -1 THEN ln(1 + (l_extendedprice - 2000)) END, 6) AS shifted
FROM lineitem
""",
)
def logs(spark, sf):
    lines = load(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", (F.col("l_extendedprice") - 2000).alias("shifted")
    )
    out = log1p_cols(lines, ["l_quantity", "shifted"])
    return out.select("l_orderkey", "l_linenumber", r6("l_quantity"), r6("shifted"))
