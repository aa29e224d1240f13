"""Random-forest size sweep with cross validation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame

from hedonic.operators.regress import model_pipeline
from hedonic.operators.split import SEED, with_folds

# Numbers of trees tried.
FOREST_SIZES = tuple(range(100, 500, 50))


def forest_sweep(
    df: DataFrame,
    features: Sequence[str],
    key: str,
    label: str = "sale_price",
    sizes: Sequence[int] = FOREST_SIZES,
    folds: int = 5,
    seed: int = SEED,
    max_depth: int = 30,
    max_bins: int = 128,
    parallelism: int = 2,
) -> DataFrame:
    """Mean over folds of the held-out RMSE for each number of trees.

    All rows take part and the label stays on its own scale.  Folds follow the
    key, every split may look at every feature, and trees grow to Spark's
    deepest limit unless told otherwise.
    """
    ready = with_folds(df.select(key, *features, label), key, folds, seed)
    forest = RandomForestRegressor(
        labelCol=label, featureSubsetStrategy="all", maxDepth=max_depth, maxBins=max_bins, seed=seed
    )
    grid = ParamGridBuilder().addGrid(forest.numTrees, list(sizes)).build()
    search = CrossValidator(
        estimator=model_pipeline(features, forest),
        estimatorParamMaps=grid,
        evaluator=RegressionEvaluator(labelCol=label, metricName="rmse"),
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
        seed=seed,
    )
    scores = search.fit(ready).avgMetrics
    rows = [(i, int(n), float(s)) for i, (n, s) in enumerate(zip(sizes, scores))]
    return df.sparkSession.createDataFrame(rows, "position int, n_trees int, rmse double")
