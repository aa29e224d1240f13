"""Counts, frequency tables, histograms, quantiles and missing values."""

from pyspark.sql import functions as F

from hedonic.operators.distributions import box_stats, density_grid, histogram, ratio_histogram
from hedonic.operators.profile import (
    count_by_year, describe, extremes, head, missing_report, profile_columns, row_count, shape, value_counts,
)
from hedonic.operators.quantiles import median_where
from workload.common import VIEWS, cte, load, query, r6, view


@query("row_count", "SELECT count(*) AS n FROM lineitem")
def rows(spark, sf):
    return row_count(load(spark, sf, "lineitem"))


@query("shape", "SELECT count(*) AS n_rows, CAST(6 AS INT) AS n_cols FROM orders")
def dims(spark, sf):
    return shape(load(spark, sf, "orders"))


VIEWS["dated"] = ("orders", ("CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderdate END AS sale_date",))


@query(
    "count_by_year",
    cte("dated") + "\nSELECT CAST(year(sale_date) AS INT) AS year, count(sale_date) AS n FROM dated WHERE sale_date IS NOT NULL GROUP BY 1",
)
def by_year(spark, sf):
    return count_by_year(view(spark, sf, "dated"), "sale_date")


@query("value_counts", "SELECT p_brand AS value, count(*) AS n FROM part WHERE p_brand IS NOT NULL GROUP BY 1")
def brands(spark, sf):
    return value_counts(load(spark, sf, "part"), "p_brand")


@query("value_counts_top", "SELECT p_type AS value, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, value LIMIT 12")
def types(spark, sf):
    return value_counts(load(spark, sf, "part"), "p_type", 12)


HISTOGRAM_SQL = """
v AS (SELECT CAST({col} AS DOUBLE) AS v FROM {src}),
s AS (SELECT min(v) AS lo, max(v) AS hi, (max(v) - min(v)) / {bins} AS w FROM v),
e AS (SELECT CAST(i AS INT) AS bin, lo + i * w AS "left", CASE WHEN i + 1 = {bins} THEN hi ELSE lo + (i + 1) * w END AS "right"
      FROM s, generate_series(0, {bins} - 1) AS g(i))
SELECT bin, round("left", 6) AS "left", round("right", 6) AS "right", count(v) AS n
FROM e LEFT JOIN v ON v >= "left" AND (v < "right" OR (bin = {bins} - 1 AND v = "right"))
GROUP BY 1, 2, 3
"""


def rounded(df):
    return df.select("bin", r6("left"), r6("right"), "n")


@query("histogram", "WITH " + HISTOGRAM_SQL.format(col="o_totalprice", src="orders", bins=20))
def prices(spark, sf):
    return rounded(histogram(load(spark, sf, "orders"), "o_totalprice", 20))


@query("histogram_upper", "WITH " + HISTOGRAM_SQL.format(col="p_size", src="part WHERE p_size < 30", bins=25))
def sizes(spark, sf):
    return rounded(histogram(load(spark, sf, "part"), "p_size", 25, upper=30))


@query(
    "ratio_histogram",
    cte("sales")
    + ", "
    + HISTOGRAM_SQL.format(
        col="sale_price / CAST(appr_tot_val AS DOUBLE)", src="sales WHERE appr_tot_val > 0", bins=400
    ),
)
def ratios(spark, sf):
    return rounded(ratio_histogram(view(spark, sf, "sales"), "sale_price", "appr_tot_val", 400))


@query(
    "ratio_histogram_by_key",
    cte("sales")
    + """, pairs AS (SELECT a.sale_price / CAST(b.appr_tot_val AS DOUBLE) AS ratio
FROM sales AS a JOIN sales AS b ON a.o_custkey = b.o_custkey WHERE b.appr_tot_val > 0), """
    + HISTOGRAM_SQL.format(col="ratio", src="pairs", bins=400),
)
def ratios_by_key(spark, sf):
    sales = view(spark, sf, "sales")
    return rounded(ratio_histogram(sales, "sale_price", "appr_tot_val", 400, key="o_custkey"))


def describe_sql(pairs) -> str:
    return "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS "column", count({c}) AS "count", round(avg({c}), 4) AS mean,
  round(stddev_samp({c}), 4) AS std, CAST(min({c}) AS DOUBLE) AS "min",
  round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 4) AS q25, round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 4) AS q50,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 4) AS q75, CAST(max({c}) AS DOUBLE) AS "max" FROM {t}"""
        for c, t in pairs
    )


def r4(*names):
    return [F.round(n, 4).alias(n) for n in names]


NUMBERS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
VIEWS["lines_and_gap"] = ("lineitem", (*NUMBERS, "CAST(NULL AS DOUBLE) AS gap"))


@query(
    "describe_exact",
    cte("lines_and_gap") + describe_sql((c, "lines_and_gap") for c in (*NUMBERS, "gap")),
)
def summary(spark, sf):
    out = describe(view(spark, sf, "lines_and_gap"))
    return out.select("column", "count", *r4("mean", "std"), "min", *r4("q25", "q50", "q75"), "max")


VIEWS["graded"] = (
    "orders",
    ("o_totalprice", "NULLIF(o_orderpriority, '3-MEDIUM') AS grade"),
)


@query(
    "box_stats",
    cte("graded")
    + """, b AS (SELECT grade, count(*) AS n, quantile_cont(o_totalprice, 0.25) AS q1,
  quantile_cont(o_totalprice, 0.5) AS median, quantile_cont(o_totalprice, 0.75) AS q3
  FROM graded WHERE grade IS NOT NULL GROUP BY grade)
SELECT b.grade AS category, n, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
  min(CASE WHEN o_totalprice >= q1 - 1.5 * (q3 - q1) THEN o_totalprice END) AS whisker_low,
  max(CASE WHEN o_totalprice <= q3 + 1.5 * (q3 - q1) THEN o_totalprice END) AS whisker_high,
  count(CASE WHEN o_totalprice < q1 - 1.5 * (q3 - q1) OR o_totalprice > q3 + 1.5 * (q3 - q1) THEN 1 END) AS outliers
FROM b JOIN graded AS g ON g.grade = b.grade GROUP BY b.grade, n, q1, median, q3
""",
)
def boxes(spark, sf):
    out = box_stats(view(spark, sf, "graded"), "o_totalprice", "grade")
    return out.select("category", "n", *r4("q1", "median", "q3"), "whisker_low", "whisker_high", "outliers")


VIEWS["holed"] = (
    "orders",
    (
        "NULLIF(o_orderpriority, '1-URGENT') AS o_orderpriority",
        "NULLIF(o_orderstatus, 'F') AS o_orderstatus",
        "CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice",
        "o_custkey",
    ),
)


@query(
    "missing_report",
    cte("holed")
    + "\n"
    + "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing, "
        f"round(100.0 * (count(*) - count({c})) / count(*), 6) AS percent FROM holed"
        for c in ("o_orderpriority", "o_orderstatus", "o_totalprice", "o_custkey")
    ),
)
def missing(spark, sf):
    return missing_report(view(spark, sf, "holed")).select("column", "missing", r6("percent"))


@query(
    "profile_columns",
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{t}' AS type, CAST({c} AS STRING) AS value, count(*) AS n FROM customer GROUP BY {c}"
        for c, t in (("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_mktsegment", "string"))
    ),
)
def profile(spark, sf):
    return profile_columns(load(spark, sf, "customer"))


@query(
    "median_where",
    "SELECT round(quantile_cont(l_extendedprice, 0.5), 4) AS median FROM lineitem WHERE l_discount <> 0",
)
def median(spark, sf):
    out = median_where(load(spark, sf, "lineitem"), "l_extendedprice", F.col("l_discount") != 0)
    return out.select(F.round("median", 4).alias("median"))


@query(
    "density_grid",
    cte("props")
    + """
SELECT CAST(least(floor(x * 10 / 100000), 9) AS INT) AS ix, CAST(least(floor((y - 20000) * 8 / 60000), 7) AS INT) AS iy,
  count(*) AS n FROM props WHERE x BETWEEN 0 AND 100000 AND y BETWEEN 20000 AND 80000 GROUP BY 1, 2
""",
)
def density(spark, sf):
    return density_grid(view(spark, sf, "props"), "x", "y", 10, 8, (0.0, 100000.0), (20000.0, 80000.0))


@query(
    "extremes",
    """
(SELECT s_suppkey, s_acctbal FROM supplier ORDER BY s_acctbal, s_suppkey LIMIT 13)
UNION ALL (SELECT s_suppkey, s_acctbal FROM supplier ORDER BY s_acctbal DESC, s_suppkey DESC LIMIT 13)
""",
)
def ends(spark, sf):
    return extremes(load(spark, sf, "supplier").select("s_suppkey", "s_acctbal"), "s_acctbal", 13, ["s_suppkey"])


@query("head", "SELECT * FROM supplier ORDER BY s_acctbal DESC, s_suppkey LIMIT 5")
def first(spark, sf):
    return head(load(spark, sf, "supplier"), 5, F.desc("s_acctbal"), "s_suppkey")
