"""Price regressions and their reports.

Ridge and lasso need the data only through means and covariances.  Those take one
pass on the executors whatever the number of penalties; a sweep is then
arithmetic on one small matrix, sized by the number of features.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Estimator, Pipeline
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hedonic.operators.moments import Moments, moments, moments_of
from hedonic.operators.profile import extremes
from hedonic.operators.scale import transform_target

# Penalties tried, and the one used for the coefficient report.
RIDGE_ALPHAS = (1e-15, 1e-10, 1e-5, 1e-3, 0.01, 0.05, 0.1, 0.3, 1, 3, 4, 5, 6, 7, 8, 10)
LASSO_ALPHAS = (0.01, 0.005, 0.001, 0.0005, 1e-4, 1e-5)
REPORT_ALPHA = 0.005
REPORT_ENDS = 13

# Columns that would leak the price into the features.
LEAKAGE = ("appr_tot_val", "appr_date", "sale_date", "sale_price")


def feature_columns(df: DataFrame, leakage: Sequence[str] = LEAKAGE) -> list[str]:
    """Columns left as features once the leaking ones are dropped."""
    return df.drop(*leakage).columns


@dataclass(frozen=True)
class LinearFit:
    """Coefficients on the raw feature scale; moments have the label last."""

    coef: np.ndarray
    intercept: float

    def mse(self, m: Moments) -> float:
        """Mean squared error on the rows behind ``m``."""
        w = np.append(-self.coef, 1.0)
        bias = float(w @ m.mean) - self.intercept
        return float(w @ m.cov @ w) + bias * bias


def _scales(m: Moments, scaled: bool) -> np.ndarray:
    std = np.sqrt(np.diag(m.cov)[:-1])
    return np.where(std > 0, std, 1.0) if scaled else np.ones_like(std)


def _fit(m: Moments, scaled: bool, solve) -> LinearFit:
    scale = _scales(m, scaled)
    gram = m.cov[:-1, :-1] / np.outer(scale, scale)
    coef = solve(gram, m.cov[:-1, -1] / scale) / scale
    return LinearFit(coef, float(m.mean[-1] - coef @ m.mean[:-1]))


def fit_ridge(m: Moments, alpha: float, scaled: bool = True) -> LinearFit:
    """Minimise ``|y - Xw|^2 + alpha |w|^2``; with a vanishing penalty the least-norm solution."""

    def solve(gram, xy):
        return np.linalg.lstsq(gram + alpha / m.n * np.eye(len(xy)), xy, rcond=None)[0]

    return _fit(m, scaled, solve)


def fit_lasso(m: Moments, alpha: float, scaled: bool = True, tol: float = 1e-12, rounds: int = 100_000) -> LinearFit:
    """Minimise ``|y - Xw|^2 / 2n + alpha |w|_1`` by cyclic coordinate descent.

    ``tol`` is relative to the largest effect of a feature; not reaching it within ``rounds`` raises.
    """

    def solve(gram, xy):
        w = np.zeros_like(xy)
        live = [i for i in range(len(xy)) if gram[i, i] > 0]
        for _ in range(rounds):
            moved = 0.0
            for i in live:
                pull = xy[i] - gram[i] @ w + gram[i, i] * w[i]
                new = np.sign(pull) * max(abs(pull) - alpha, 0.0) / gram[i, i]
                moved = max(moved, abs(new - w[i]) * np.sqrt(gram[i, i]))
                w[i] = new
            if moved <= tol * max(1.0, max((abs(w[i]) * np.sqrt(gram[i, i]) for i in live), default=0.0)):
                return w
        raise ValueError(f"the lasso did not converge within {rounds} rounds")

    return _fit(m, scaled, solve)


def _sweep(train, test, features, label, alphas, fit, transform) -> DataFrame:
    cols = [*features, label]
    if transform:
        train, test = transform_target(train, label), transform_target(test, label)
    # Both halves in one pass.
    both = train.select(*cols, F.lit(0).alias("_half")).unionByName(test.select(*cols, F.lit(1).alias("_half")))
    found = moments_of(both, cols, F.col("_half"))
    if len(found) < 2:
        raise ValueError("no rows")
    seen, unseen = found[0], found[1]
    rows = [(i, float(a), fit(seen, a).mse(unseen)) for i, a in enumerate(alphas)]
    return train.sparkSession.createDataFrame(rows, "position int, alpha double, mse double")


def ridge_sweep(
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    label: str = "sale_price",
    alphas: Sequence[float] = RIDGE_ALPHAS,
    transform: bool = True,
) -> DataFrame:
    """Test error of a ridge on standardised features for each penalty.

    ``transform`` rescales the label with :func:`transform_target`, train and
    test each by their own statistics.
    """
    return _sweep(train, test, features, label, alphas, fit_ridge, transform)


def lasso_sweep(
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    label: str = "sale_price",
    alphas: Sequence[float] = LASSO_ALPHAS,
    transform: bool = True,
) -> DataFrame:
    """Test error of a lasso on standardised features for each penalty."""
    return _sweep(train, test, features, label, alphas, fit_lasso, transform)


def best_of(sweep: DataFrame, parameter: str = "alpha") -> DataFrame:
    """The parameter with the smallest error, the earliest on a tie, and its RMSE."""
    best = sweep.orderBy("mse", "position").limit(1)
    return best.select(parameter, "mse", F.sqrt("mse").alias("rmse"))


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    error = F.col(label) - F.col(prediction)
    return df.agg(F.avg(error * error).alias("mse")).withColumn("rmse", F.sqrt("mse"))


def null_rmse(df: DataFrame, label: str) -> DataFrame:
    """Error of always predicting the mean."""
    return df.agg(F.stddev_pop(label).alias("rmse"))


def model_pipeline(cols: Sequence[str], estimator: Estimator, invalid: str = "error") -> Pipeline:
    """Assemble ``cols``, standardise them, then ``estimator`` on the column ``scaled``."""
    assembler = VectorAssembler(inputCols=list(cols), outputCol="raw", handleInvalid=invalid)
    scaler = StandardScaler(inputCol="raw", outputCol="scaled", withMean=True, withStd=True)
    return Pipeline(stages=[assembler, scaler, estimator.setFeaturesCol("scaled")])


def coefficient_table(spark: SparkSession, fit: LinearFit, cols: Sequence[str]) -> DataFrame:
    rows = [(c, float(w)) for c, w in zip(cols, fit.coef)]
    return spark.createDataFrame(rows, "feature string, coefficient double")


def coefficient_report(
    train: DataFrame,
    features: Sequence[str],
    label: str = "sale_price",
    alpha: float = REPORT_ALPHA,
    k: int = REPORT_ENDS,
    scaled: bool = False,
    transform: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Lasso coefficients: one row ``picked, eliminated``, and the ``k`` lowest and highest."""
    if transform:
        train = transform_target(train, label)
    fit = fit_lasso(moments(train, [*features, label]), alpha, scaled)
    table = coefficient_table(train.sparkSession, fit, features)
    kept = F.col("coefficient") != 0
    counts = table.agg(F.count_if(kept).alias("picked"), F.count_if(~kept).alias("eliminated"))
    return counts, extremes(table, "coefficient", k, ["feature"])
