"""Encoding, scaling, components and the split."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hedonic.operators.encode import (
    BEDROOM_EDGES, BEDROOM_LABELS, YEAR_EDGES, YEAR_LABELS, bin_column, categories, dummies, dummy_vectors, proximity_features,
)
from hedonic.operators.scale import pca_features, standardize, target_stats, transform_target
from hedonic.operators.split import split, with_folds
from tests.conftest import plan_of, rows


def test_year_bins_close_on_the_right(spark):
    cases = {
        0: None, 1700: None, 1800: 1700, 1900: 1800, 1910: 1900, 1911: 1910, 2000: 1990, 2001: 2000, 2010: 2000,
        2015: 2010, 2021: None,
    }
    df = spark.createDataFrame([(y,) for y in cases], "y int")
    got = {r.y: r.bin_y for r in bin_column(df, "y", YEAR_EDGES, YEAR_LABELS).collect()}
    assert got == cases


def test_bedroom_bins(spark):
    df = spark.createDataFrame([(v,) for v in (0, 1, 7, 99, 101, None)], "b int")
    assert [r.bin_b for r in bin_column(df, "b", BEDROOM_EDGES, BEDROOM_LABELS).collect()] == [0, 1, 7, 7, None, None]
    with pytest.raises(ValueError):
        bin_column(df, "b", (0, 1), (1, 2))


def test_dummies_drop_the_first_category(spark):
    df = spark.createDataFrame([(1, "B"), (2, None), (3, "A"), (4, "C")], "id int, v string")
    got = dummies(df, "v", "d").drop("v")
    assert got.columns == ["id", "d_B", "d_C"]
    assert rows(got) == [(1, 1, 0), (2, 0, 0), (3, 0, 0), (4, 0, 1)]
    assert dummies(df, "v", "d", drop_first=False).columns[2:] == ["d_A", "d_B", "d_C"]
    assert dummies(df.where("id = 1"), "v", "d", values=["A", "B", "C"]).columns[2:] == ["d_B", "d_C"]


def test_categories_sort_by_code_point(spark):
    df = spark.createDataFrame([("SeaTac",), ("SNOQUALMIE",), (None,)], "v string")
    assert categories(df, "v") == ["SNOQUALMIE", "SeaTac"]
    assert len(categories(spark.range(1100), "id")) == 1100


def test_dummy_vectors_agree_with_dummies(spark):
    df = spark.createDataFrame([(1, "B"), (2, None), (3, "A"), (4, "C")], "id int, v string")
    for drop_first in (False, True):
        wide = dummies(df, "v", "d", drop_first)
        columns = [c for c in wide.columns if c.startswith("d_")]
        sparse = dummy_vectors(df, "v", "d", drop_first).orderBy("id").collect()
        assert [list(map(int, r.d.toArray())) for r in sparse] == [[r[c] for c in columns] for r in wide.orderBy("id").collect()]


def test_proximity_features_take_the_last_two(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    got = proximity_features(df, {"p": ["a", "b", "c"]}).head()
    assert (got.p_1, got.p_2) == (2, 3)


def test_standardize(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (4.0, 5.0)], "v double, k double")
    got = standardize(df, ["v", "k"])
    assert [r.v for r in got.orderBy("v").collect()] == pytest.approx([-1.161895, -0.387298, 0.387298, 1.161895], abs=1e-6)
    assert all(r.k is None for r in got.collect())
    assert "NestedLoop" not in plan_of(got)


def test_target(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4)], "v double")
    expected = [-0.418005, 0.440051, 0.894950, 1.206462]
    assert [r.v for r in transform_target(df, "v").orderBy("v").collect()] == pytest.approx(expected, abs=1e-6)
    other = transform_target(df.where("v > 3"), "v", target_stats(df, "v")).head().v
    assert other == pytest.approx(expected[-1], abs=1e-6)


def test_target_far_below_the_mean_is_null(spark):
    df = spark.createDataFrame([(-100.0,)] + [(float(v % 3),) for v in range(50)], "v double")
    assert transform_target(df, "v", out="t").where("v = -100").head().t is None


def test_components_match_svd(spark):
    rng = np.random.default_rng(4)
    data = rng.integers(0, 5, (300, 6)) @ np.diag([3, 1, 2, 1, 0.5, 4]).astype(float)
    names = [f"g{i}" for i in range(6)]
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(data)], ["id", *names])
    got = np.array([tuple(r) for r in pca_features(df, names, 3).orderBy("id").select("View_1", "View_2", "View_3").collect()])
    centred = data - data.mean(axis=0)
    _, _, vt = np.linalg.svd(centred, full_matrices=False)
    assert np.abs(got) == pytest.approx(np.abs(centred @ vt[:3].T), abs=1e-8)


def test_split_is_a_stable_partition(spark):
    df = spark.range(2000).select(F.col("id").alias("k"))
    train, test = split(df, "k")
    assert train.count() + test.count() == 2000 and train.intersect(test).count() == 0
    assert 300 < test.count() < 500
    assert rows(test) == rows(split(df.repartition(7), "k")[1])
    assert rows(test) != rows(split(df, "k", seed=1)[1])
    sizes = [r["count"] for r in with_folds(df, "k").groupBy("fold").count().collect()]
    assert len(sizes) == 5 and min(sizes) > 300


def test_log_of_target_uses_one_plus(spark):
    df = spark.createDataFrame([(0.0,), (2.0,)], "v double")
    assert [r.v for r in transform_target(df, "v").orderBy("v").collect()] == pytest.approx([0.0, math.log(3)])
