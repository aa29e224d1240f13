"""Splits, regressions and their reports."""

from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from hedonic.operators.forest import forest_sweep
from hedonic.operators.regress import (
    LASSO_ALPHAS, REPORT_ALPHA, RIDGE_ALPHAS, best_of, coefficient_report, lasso_sweep, model_pipeline, null_rmse,
    regression_metrics, ridge_sweep,
)
from hedonic.operators.split import split, with_folds
from workload.common import VIEWS, cte, load, query, r6, view

HASH = "CAST(('0x' || substr(md5('123:' || CAST({key} AS STRING)), 1, 8)) AS BIGINT)"


def bucket_sql(key: str, n: int) -> str:
    return f"CAST({HASH.format(key=key)} % {n} AS INT)"


@query("split", f"SELECT o_orderkey, {bucket_sql('o_orderkey', 1000)} < 200 AS in_test FROM orders")
def parts(spark, sf):
    train, test = split(load(spark, sf, "orders"), "o_orderkey")
    marked = [p.select("o_orderkey", F.lit(flag).alias("in_test")) for p, flag in ((train, False), (test, True))]
    return marked[0].unionByName(marked[1])


@query("folds", f"SELECT o_orderkey, {bucket_sql('o_orderkey', 5)} AS fold FROM orders")
def folds(spark, sf):
    return with_folds(load(spark, sf, "orders").select("o_orderkey"), "o_orderkey")


LINE_SQL = """
WITH f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS w, regr_intercept(l_extendedprice, l_quantity) AS b FROM lineitem)
SELECT round(avg(pow(l_extendedprice - b - w * l_quantity, 2)) / 1e6, 4) AS mse,
  round(sqrt(avg(pow(l_extendedprice - b - w * l_quantity, 2))), 4) AS rmse FROM lineitem, f
"""


@query("regression_metrics", LINE_SQL)
def metrics(spark, sf):
    lines = load(spark, sf, "lineitem").select("l_quantity", "l_extendedprice")
    line = lines.agg(
        F.struct(
            F.regr_slope("l_extendedprice", "l_quantity").alias("w"),
            F.regr_intercept("l_extendedprice", "l_quantity").alias("b"),
        )
    ).scalar()
    predicted = lines.withColumn("_l", line).withColumn("p", F.col("_l.b") + F.col("_l.w") * F.col("l_quantity"))
    out = regression_metrics(predicted, "l_extendedprice", "p")
    return out.select(F.round(F.col("mse") / 1e6, 4).alias("mse"), F.round("rmse", 4).alias("rmse"))


@query("model_pipeline", LINE_SQL)
def fitted_line(spark, sf):
    lines = load(spark, sf, "lineitem").select("l_quantity", "l_extendedprice")
    estimator = LinearRegression(labelCol="l_extendedprice", solver="normal", regParam=0.0)
    model = model_pipeline(["l_quantity"], estimator).fit(lines)
    out = regression_metrics(model.transform(lines), "l_extendedprice", "prediction")
    return out.select(F.round(F.col("mse") / 1e6, 4).alias("mse"), F.round("rmse", 4).alias("rmse"))


@query("null_rmse", "SELECT round(stddev_pop(l_extendedprice), 4) AS rmse FROM lineitem")
def baseline(spark, sf):
    return null_rmse(load(spark, sf, "lineitem"), "l_extendedprice").select(F.round("rmse", 4).alias("rmse"))


# Two features and a label, halved by the portable rule of ``split``.
VIEWS["lines"] = (
    "lineitem",
    ("l_orderkey", "l_quantity AS q", "l_discount * 100 AS d", "l_extendedprice AS sale_price"),
)
TARGETS = f"""
, h AS (SELECT *, {bucket_sql('l_orderkey', 1000)} < 200 AS in_test FROM lines),
z AS (SELECT *, ln((sale_price - avg(sale_price) OVER (PARTITION BY in_test))
    / stddev_pop(sale_price) OVER (PARTITION BY in_test) + 2) AS y FROM h),
m AS (SELECT count(*) AS n, avg(q) AS mq, avg(d) AS md, avg(y) AS my, stddev_pop(q) AS sq, stddev_pop(d) AS sd,
    corr(q, d) AS r, covar_pop(q, y) / stddev_pop(q) AS cq, covar_pop(d, y) / stddev_pop(d) AS cd FROM z WHERE NOT in_test)
"""


def alphas_sql(alphas) -> str:
    rows = ", ".join(f"({i}, CAST({a!r} AS DOUBLE))" for i, a in enumerate(alphas))
    return f", g AS (SELECT * FROM (VALUES {rows}) AS v(position, alpha))"


RIDGE_SQL = (
    cte("lines")
    + TARGETS
    + alphas_sql(RIDGE_ALPHAS)
    + """
, w AS (SELECT position, alpha, (cq * (1 + alpha / n) - r * cd) / (pow(1 + alpha / n, 2) - r * r) AS wq,
    (cd * (1 + alpha / n) - r * cq) / (pow(1 + alpha / n, 2) - r * r) AS wd FROM g, m),
sweep AS (SELECT position, alpha, avg(pow(y - my - wq * (q - mq) / sq - wd * (d - md) / sd, 2)) AS mse
  FROM w, m, z WHERE in_test GROUP BY position, alpha)
"""
)
ROUNDED_SWEEP = "SELECT position, alpha, round(mse, 8) AS mse FROM sweep"


def halves(spark, sf):
    return split(view(spark, sf, "lines"), "l_orderkey")


@query("ridge_sweep", RIDGE_SQL + ROUNDED_SWEEP)
def ridge(spark, sf):
    train, test = halves(spark, sf)
    return ridge_sweep(train, test, ["q", "d"]).select("position", "alpha", F.round("mse", 8).alias("mse"))


# With one feature the lasso is a soft threshold.
LASSO_SQL = (
    cte("lines")
    + TARGETS
    + alphas_sql((0.5, *LASSO_ALPHAS))
    + """
, w AS (SELECT position, alpha, sign(cq) * greatest(abs(cq) - alpha, 0.0) AS wq FROM g, m),
sweep AS (SELECT position, alpha, avg(pow(y - my - wq * (q - mq) / sq, 2)) AS mse
  FROM w, m, z WHERE in_test GROUP BY position, alpha)
"""
)


@query("lasso_sweep", LASSO_SQL + ROUNDED_SWEEP)
def lasso(spark, sf):
    train, test = halves(spark, sf)
    out = lasso_sweep(train, test, ["q"], alphas=(0.5, *LASSO_ALPHAS))
    return out.select("position", "alpha", F.round("mse", 8).alias("mse"))


@query(
    "best_of",
    LASSO_SQL + "SELECT alpha, round(mse, 8) AS mse, round(sqrt(mse), 8) AS rmse FROM sweep ORDER BY sweep.mse, position LIMIT 1",
)
def best(spark, sf):
    train, test = halves(spark, sf)
    out = best_of(lasso_sweep(train, test, ["q"], alphas=(0.5, *LASSO_ALPHAS)))
    return out.select("alpha", F.round("mse", 8).alias("mse"), F.round("rmse", 8).alias("rmse"))


def embedded(spark, sf):
    """All embedding coordinates as features of the label."""
    dims = 64
    return load(spark, sf, "embeddings").select(
        "vec_id", *[F.get("embedding", i).cast("double").alias(f"e{i}") for i in range(dims)],
        F.col("label").cast("double").alias("sale_price"),
    ), [f"e{i}" for i in range(dims)]


# The same models by another method: proximal gradient steps on the matrix of covariances, from zero on, to a fixed
# point.  ``g`` and ``c`` are the features' covariances among themselves and with the label.
DIMS = 64
STEPS = 700


def wide_sql(scaled: bool, alphas, ridge: bool, halves: bool) -> str:
    each = f"range(1, {DIMS + 1})"
    shrink, pull = ("0.0", "alpha / n") if ridge else ("alpha", "0.0")
    step = f"w[i] + (c[i] - list_dot_product(g[i], w) - {pull} * w[i]) / top"
    in_test = f"{bucket_sql('vec_id', 1000)} < 200" if halves else "false"
    return f"""
WITH RECURSIVE e AS (
  SELECT vec_id, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS x, CAST(label AS DOUBLE) AS p, {in_test} AS in_test FROM embeddings
), z AS (
  SELECT *, ln((p - avg(p) OVER (PARTITION BY in_test)) / stddev_pop(p) OVER (PARTITION BY in_test) + 2) AS y FROM e
), long AS (
  SELECT vec_id, i, x[i] AS v, y FROM z, unnest({each}) AS r(i) WHERE NOT in_test
), one AS (
  SELECT i, avg(v) AS m, {'stddev_pop(v)' if scaled else '1.0'} AS s, covar_pop(v, y) AS cy FROM long GROUP BY i
), two AS (
  SELECT a.i AS i, b.i AS j, covar_pop(a.v, b.v) AS g FROM long a JOIN long b ON a.vec_id = b.vec_id GROUP BY a.i, b.i
), lines AS (
  SELECT two.i AS i, list(g / a.s / b.s ORDER BY j) AS line, sum(abs(g / a.s / b.s)) AS size
  FROM two JOIN one a ON a.i = two.i JOIN one b ON b.i = two.j GROUP BY two.i
), mat AS (
  SELECT list(line ORDER BY lines.i) AS g, list(cy / s ORDER BY lines.i) AS c, list(m ORDER BY lines.i) AS m, list(s ORDER BY lines.i) AS s,
    max(size) AS top, (SELECT count(*) FROM z WHERE NOT in_test) AS n, (SELECT avg(y) FROM z WHERE NOT in_test) AS my
  FROM lines JOIN one ON one.i = lines.i
), alphas AS (
  SELECT * FROM (VALUES {', '.join(f'({i}, CAST({a!r} AS DOUBLE))' for i, a in enumerate(alphas))}) AS v(position, alpha)
), w AS (
  SELECT 0 AS k, position, alpha, list_transform({each}, lambda i: 0.0::DOUBLE) AS w FROM alphas
  UNION ALL
  SELECT k + 1, position, alpha,
    list_transform({each}, lambda i: sign({step}) * greatest(abs({step}) - {shrink} / top, 0.0)) AS w
  FROM w, mat WHERE k < {STEPS}
), fitted AS (
  SELECT position, alpha, w FROM w WHERE k = {STEPS}
), sweep AS (
  SELECT position, alpha, avg(pow(y - my - list_dot_product(w, list_transform({each}, lambda i: (x[i] - m[i]) / s[i])), 2)) AS mse
  FROM fitted, mat, z WHERE in_test GROUP BY position, alpha
), report AS (
  SELECT 'e' || CAST(i - 1 AS STRING) AS feature, w[i] / s[i] AS coefficient FROM fitted, mat, unnest({each}) AS r(i)
)
"""


REPORT_SQL = wide_sql(False, (REPORT_ALPHA,), ridge=False, halves=False)


def end_sql(direction: str) -> str:
    return f"SELECT feature, round(coefficient, 6) + 0.0 AS coefficient FROM report ORDER BY report.coefficient {direction}, feature {direction} LIMIT 13"


@query("coefficient_report", REPORT_SQL + f"(SELECT * FROM ({end_sql('ASC')})) UNION ALL (SELECT * FROM ({end_sql('DESC')}))")
def coefficients(spark, sf):
    table, cols = embedded(spark, sf)
    counts, ends = coefficient_report(table, cols)
    return ends.select("feature", (F.round("coefficient", 6) + 0.0).alias("coefficient"))


@query(
    "coefficient_counts",
    REPORT_SQL + "SELECT count(*) FILTER (abs(coefficient) > 1e-9) AS picked, count(*) FILTER (abs(coefficient) <= 1e-9) AS eliminated FROM report",
)
def coefficient_counts(spark, sf):
    table, cols = embedded(spark, sf)
    return coefficient_report(table, cols)[0]


@query(
    "coefficient_counts_one",
    """
SELECT CAST(abs(c) > 100.0 AS BIGINT) AS picked, CAST(abs(c) <= 100.0 AS BIGINT) AS eliminated
FROM (SELECT covar_pop(l_quantity, l_extendedprice) AS c FROM lineitem)
""",
)
def one_count(spark, sf):
    counts, _ = coefficient_report(load(spark, sf, "lineitem"), ["l_quantity"], "l_extendedprice", alpha=100.0, transform=False)
    return counts


@query(
    "coefficient_report_one",
    """
WITH c AS (SELECT covar_pop(l_quantity, l_extendedprice) AS c, var_pop(l_quantity) AS v FROM lineitem),
w AS (SELECT 'l_quantity' AS feature, round(sign(c) * greatest(abs(c) - 100.0, 0.0) / v, 6) AS coefficient FROM c)
SELECT * FROM w UNION ALL SELECT * FROM w
""",
)
def one_coefficient(spark, sf):
    lines = load(spark, sf, "lineitem")
    _, ends = coefficient_report(lines, ["l_quantity"], "l_extendedprice", alpha=100.0, transform=False)
    return ends.select("feature", r6("coefficient"))


@query("ridge_sweep_wide", wide_sql(True, RIDGE_ALPHAS, ridge=True, halves=True) + ROUNDED_SWEEP)
def ridge_wide(spark, sf):
    table, cols = embedded(spark, sf)
    train, test = split(table, "vec_id")
    return ridge_sweep(train, test, cols).select("position", "alpha", F.round("mse", 8).alias("mse"))


@query("lasso_sweep_wide", wide_sql(True, LASSO_ALPHAS, ridge=False, halves=True) + ROUNDED_SWEEP)
def lasso_wide(spark, sf):
    table, cols = embedded(spark, sf)
    train, test = split(table, "vec_id")
    return lasso_sweep(train, test, cols).select("position", "alpha", F.round("mse", 8).alias("mse"))


@query("forest_sweep")
def forest(spark, sf):
    table, cols = embedded(spark, sf)
    return forest_sweep(table, cols, "vec_id", sizes=(10, 20), max_depth=6)
