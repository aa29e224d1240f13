"""Regressions against closed forms, and their reports."""

import numpy as np
import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from hedonic.operators.forest import forest_sweep
from hedonic.operators.moments import moments
from hedonic.operators.regress import (
    best_of, coefficient_report, feature_columns, fit_lasso, fit_ridge, lasso_sweep, model_pipeline,
    null_rmse, regression_metrics, ridge_sweep,
)


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(12)
    x = rng.normal(0, 1, (400, 5)) * [1, 10, 0.1, 5, 1] + [0, 50, 3, -4, 0]
    x[:, 4] = 0.3 * x[:, 0] + rng.normal(0, 0.2, 400)
    y = x @ [2.0, 0.3, -4.0, 0.0, 1.0] + rng.normal(0, 1, 400) + 100
    return x, y


@pytest.fixture(scope="module")
def table(spark, data):
    x, y = data
    rows = [(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id int, a double, b double, c double, d double, e double, sale_price double").repartition(5)


COLS = ["a", "b", "c", "d", "e"]


def scaled(x, by):
    return (x - by.mean(axis=0)) / by.std(axis=0)


def test_moments(table, data):
    x, y = data
    m = moments(table, [*COLS, "sale_price"])
    both = np.column_stack([x, y])
    assert m.n == 400 and m.mean == pytest.approx(both.mean(axis=0))
    assert m.cov == pytest.approx(np.cov(both.T, ddof=0), rel=1e-9)


def test_moments_of_constant_column_and_missing_value(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 4.0)], "k double, v double")
    assert moments(df, ["k", "v"]).cov == pytest.approx(np.array([[0.0, 0.0], [0.0, 1.0]]))
    with pytest.raises(ValueError, match="missing values in k"):
        moments(df.withColumn("k", F.lit(None).cast("double")), ["k", "v"])
    wide = df.select("v", *[F.col("v").alias(f"v{i}") for i in range(30)])
    with pytest.raises(ValueError, match="missing values in v3"):
        moments(wide.withColumn("v3", F.lit(float("nan"))), wide.columns)


@pytest.mark.parametrize("width", [1, 2, 30])
def test_moments_of_one_row_and_of_none(spark, width):
    df = spark.createDataFrame([(3.0,)], "v double").select(*[F.col("v").alias(f"v{i}") for i in range(width)])
    m = moments(df, df.columns)
    assert (m.n, m.mean.tolist(), m.cov.tolist()) == (1, [3.0] * width, [[0.0] * width] * width)
    with pytest.raises(ValueError):
        moments(df.where("v0 < 0"), df.columns)


def test_lasso_that_does_not_converge_raises(table):
    with pytest.raises(ValueError, match="converge"):
        fit_lasso(moments(table, [*COLS, "sale_price"]), 1e-6, rounds=1)


@pytest.mark.parametrize("alpha", [1e-15, 0.1, 10])
def test_ridge_closed_form(table, data, alpha):
    x, y = data
    z = scaled(x, x)
    w = np.linalg.solve(z.T @ z + alpha * np.eye(5), z.T @ (y - y.mean()))
    fit = fit_ridge(moments(table, [*COLS, "sale_price"]), alpha)
    assert fit.coef * x.std(axis=0) == pytest.approx(w, rel=1e-8)
    assert x @ fit.coef + fit.intercept == pytest.approx(z @ w + y.mean(), rel=1e-9)


@pytest.mark.parametrize("scale", [True, False])
@pytest.mark.parametrize("alpha", [0.5, 0.01])
def test_lasso_meets_its_optimality_conditions(table, data, alpha, scale):
    x, y = data
    z = scaled(x, x) if scale else x - x.mean(axis=0)
    fit = fit_lasso(moments(table, [*COLS, "sale_price"]), alpha, scale)
    w = fit.coef * (x.std(axis=0) if scale else 1)
    pull = z.T @ (y - y.mean() - z @ w) / len(y)
    for wi, p in zip(w, pull):
        assert abs(p) <= alpha + 1e-8 if wi == 0 else p == pytest.approx(alpha * np.sign(wi), abs=1e-8)


def test_lasso_agrees_with_spark_ml(table):
    alpha = 0.05
    estimator = LinearRegression(
        labelCol="sale_price", elasticNetParam=1.0, regParam=alpha, standardization=False, solver="l-bfgs", tol=1e-12, maxIter=500
    )
    model = model_pipeline(COLS, estimator).fit(table).stages[-1]
    fit = fit_lasso(moments(table, [*COLS, "sale_price"]), alpha)
    spread = np.sqrt(np.diag(moments(table, COLS + ["sale_price"]).cov)[:-1])
    # The pipeline's scaler divides by the sample deviation, a factor of 399/400.
    assert model.coefficients.toArray() == pytest.approx(fit.coef * spread, rel=5e-3, abs=1e-3)


def test_sweeps_equal_scoring_row_by_row(table, data):
    x, y = data
    train, test = table.where("id % 5 > 0"), table.where("id % 5 = 0")
    is_train = np.arange(400) % 5 > 0
    ys = [y[is_train], y[~is_train]]
    z, zt = scaled(x[is_train], x[is_train]), scaled(x[~is_train], x[is_train])
    got = ridge_sweep(train, test, COLS, alphas=(0.1, 10), transform=False).orderBy("position").collect()
    for r in got:
        w = np.linalg.solve(z.T @ z + r.alpha * np.eye(5), z.T @ (ys[0] - ys[0].mean()))
        assert r.mse == pytest.approx(np.mean((ys[1] - zt @ w - ys[0].mean()) ** 2), rel=1e-8)
    assert lasso_sweep(train, test, COLS, transform=False).count() == 6


def test_best_is_the_first_minimum(spark):
    sweep = spark.createDataFrame([(0, 1.0, 0.5), (1, 2.0, 0.2), (2, 3.0, 0.2)], "position int, alpha double, mse double")
    best = best_of(sweep).head()
    assert best.alpha == 2.0 and best.rmse == pytest.approx(0.2**0.5)


def test_metrics_and_null_model(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 4.0), (3.0, 3.0), (4.0, 4.0)], "y double, p double")
    got = regression_metrics(df, "y", "p").head()
    assert (got.mse, got.rmse) == (1.0, 1.0)
    assert null_rmse(df, "y").head().rmse == pytest.approx(1.118034, abs=1e-6)


def test_coefficient_report(table):
    counts, ends = coefficient_report(table, COLS, alpha=50.0, k=2, transform=False)
    assert counts.head().picked + counts.head().eliminated == 5 and counts.head().eliminated > 0
    assert ends.count() == 4


def test_leakage_columns_are_dropped(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, 5)], "lat int, appr_tot_val int, appr_date int, sale_date int, sale_price int")
    assert feature_columns(df) == ["lat"]


def test_forest_beats_the_mean(table):
    got = forest_sweep(table, COLS, "id", sizes=(3, 6), max_depth=5, max_bins=32).orderBy("position").collect()
    assert [r.n_trees for r in got] == [3, 6]
    assert all(r.rmse < null_rmse(table, "sale_price").head().rmse for r in got)
