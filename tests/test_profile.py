"""Profiles, histograms and quantiles."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from hedonic.operators.distributions import box_stats, density_grid, histogram, ratio_histogram
from hedonic.operators.profile import (
    column_types, count_by_year, describe, extremes, missing_report, profile_columns, row_count, shape, value_counts,
)
from hedonic.operators.quantiles import approx_quantiles, exact_quantiles, median_where
from tests.conftest import plan_of, rows


def doubles(spark, values):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "v double")


def test_histogram_hand_checked(spark):
    got = [tuple(r) for r in histogram(doubles(spark, [0, 1, 2, 3, 10]), "v", 5).orderBy("bin").collect()]
    assert got == [(0, 0.0, 2.0, 2), (1, 2.0, 4.0, 2), (2, 4.0, 6.0, 0), (3, 6.0, 8.0, 0), (4, 8.0, 10.0, 1)]


@pytest.mark.parametrize("bins", [1, 7, 20, 400])
def test_histogram_equals_numpy(spark, bins):
    values = np.concatenate([np.arange(0, 3, 0.1), np.random.default_rng(0).normal(1, 1, 500)])
    counts, edges = np.histogram(values, bins)
    got = histogram(doubles(spark, values), "v", bins).orderBy("bin").collect()
    assert [r.n for r in got] == counts.tolist()
    assert [r.left for r in got] == pytest.approx(edges[:-1].tolist())
    assert sum(r.n for r in got) == len(values)


def test_histogram_of_constant_and_missing(spark):
    got = histogram(doubles(spark, [3, 3, None, float("nan")]), "v", 2).orderBy("bin").collect()
    counts, _ = np.histogram([3, 3], 2)
    assert [r.n for r in got] == counts.tolist() and got[0].left == 2.5 and got[1].right == 3.5


def test_histogram_upper_bound_is_open(spark):
    got = histogram(doubles(spark, [0, 5, 10]), "v", 2, upper=10).orderBy("bin").collect()
    assert [r.n for r in got] == [1, 1]


def test_ratio_histogram_by_row_and_key(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0), ("a", 2.0, 2.0), ("b", 3.0, 0.0)], "k string, p double, v double")
    assert sum(r.n for r in ratio_histogram(df, "p", "v", 4).collect()) == 2
    assert sum(r.n for r in ratio_histogram(df, "p", "v", 4, key="k").collect()) == 4


@pytest.mark.parametrize("bins", [1, 3, 40])
def test_ratios_of_crowded_keys_are_counted_as_if_listed(spark, bins):
    """Keys with more numerators than bins take the ordered runs; edges and ties fall as in the list of pairs."""
    rng = np.random.default_rng(bins)
    data = [("hot", float(a), float(b)) for a, b in zip(rng.integers(-30, 90, 400), rng.integers(-2, 12, 400))]
    data += [(f"k{i % 7}", float(a), float(b)) for i, (a, b) in enumerate(rng.integers(1, 25, (120, 2)))]
    data += [("tops", 500.0, 0.0), ("gap", None, 2.0), ("gap", float("nan"), 3.0), (None, 9000.0, 1.0), ("one", 7.5, None)]
    df = spark.createDataFrame(data, "k string, p double, v double")
    want = [a / b for j, a, _ in data for k, _, b in data if j == k and j and a is not None and a == a and b and b > 0]
    counts, edges = np.histogram(want, bins)
    got = ratio_histogram(df, "p", "v", bins, key="k").orderBy("bin").collect()
    assert sum(r.n for r in got) == len(want)
    left = [r.left for r in got] + [got[-1].right]
    assert left == pytest.approx(edges.tolist(), rel=1e-12)
    placed = np.clip(np.searchsorted(left, want, side="right") - 1, 0, bins - 1)
    assert [r.n for r in got] == np.bincount(placed, minlength=bins).tolist()


def test_brackets_are_narrowed_until_few_values_are_left(spark):
    """Whatever the size, the last ordered pass sees a fixed number of values per bracket."""
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.normal(0, 1, 4000), np.full(3000, 0.25), rng.exponential(50, 3000)])
    df = spark.createDataFrame([("a", float(v)) for v in values] + [("b", float(v)) for v in values[:7]], "g string, v double")
    qs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {r.g: [r[f"q{i}"] for i in range(len(qs))] for r in exact_quantiles(df, "v", ["g"], qs, 500, final=40).collect()}
    assert got["a"] == pytest.approx(np.quantile(values, qs).tolist(), rel=1e-12)
    assert got["b"] == pytest.approx(np.quantile(values[:7], qs).tolist(), rel=1e-12)


def test_describe_keeps_a_wholly_missing_column(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), None), (3.0, None)], "a double, b int")
    got = {r.column: r for r in describe(df).collect()}
    assert (got["a"]["count"], got["a"].q50) == (2, 2.0)
    assert got["b"]["count"] == 0 and got["b"].q50 is None and got["b"].mean is None


@pytest.mark.parametrize("accuracy", [20, 100, 10000])
@pytest.mark.parametrize("kind", ["normal", "ties", "huge"])
def test_exact_quantiles_equal_numpy(spark, accuracy, kind):
    rng = np.random.default_rng(3)
    values = {
        "normal": rng.normal(0, 1, 3000),
        "ties": rng.integers(0, 5, 3000).astype(float),
        "huge": np.exp(rng.normal(0, 20, 3000)),
    }[kind]
    group = np.where(rng.random(3000) < 0.8, "hot", "cold")
    df = spark.createDataFrame(list(zip(group.tolist(), values.tolist())), "g string, v double").repartition(6)
    qs = [0.0, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {r.g: [r[f"q{i}"] for i in range(len(qs))] for r in exact_quantiles(df, "v", ["g"], qs, accuracy).collect()}
    for g in ("hot", "cold"):
        assert got[g] == pytest.approx(np.quantile(values[group == g], qs).tolist(), rel=1e-12)


def test_tiny_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("b", 2.0), (None, 5.0), ("c", None)], "g string, v double")
    assert rows(exact_quantiles(df, "v", ["g"], [0.5])) == [("a", 1.0), ("b", 1.5)]
    assert rows(approx_quantiles(df, "v", ["g"], [0.5])) == [("a", 1.0), ("b", 1.0)]


def test_describe(spark):
    got = describe(doubles(spark, [1, 2, 3, 4, None, float("nan")])).head()
    assert got.asDict() == pytest.approx(
        dict(column="v", count=4, mean=2.5, std=1.290994448, min=1, q25=1.75, q50=2.5, q75=3.25, max=4)
    )
    assert describe(doubles(spark, range(101)), approx=True).head().q50 == 50


def test_box(spark):
    df = spark.createDataFrame([("a", float(v)) for v in (1, 2, 3, 4, 100)] + [(None, 7.0), ("b", None)], "g string, v double")
    assert rows(box_stats(df, "v", "g")) == [("a", 5, 2.0, 3.0, 4.0, 1.0, 4.0, 1)]
    assert box_stats(df, "v", "g", approx=True).head().outliers == 1


def test_median_where(spark):
    df = doubles(spark, [0, 0, 0, 1990, 2000, 2005])
    assert rows(median_where(df, "v", F.col("v") != 0)) == [(2000.0,)]


def test_counts(spark):
    df = spark.createDataFrame([("x", "2014-01-01"), ("y", "2014-05-01"), ("x", None)], "c string, d string")
    df = df.withColumn("d", F.col("d").cast("date"))
    assert rows(row_count(df)) == [(3,)] and rows(shape(df)) == [(3, 2)]
    assert rows(count_by_year(df, "d")) == [(2014, 2)]
    assert [tuple(r) for r in value_counts(df, "c", 1).collect()] == [("x", 2)]
    assert column_types(df) == {"c": "string", "d": "date"}


def test_missing_counts_nan_and_null(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), "a"), (None, "b"), (2.0, "c")], "v double, s string")
    assert rows(missing_report(df)) == [("s", 1, 25.0), ("v", 2, 50.0)]


def test_profile(spark):
    df = spark.createDataFrame([(1, "a", 0.5), (1, None, 0.5)], "i int, s string, d double")
    assert rows(profile_columns(df)) == [("i", "int", "1", 2), ("s", "string", None, 1), ("s", "string", "a", 1)]


def test_extremes_overlap_on_short_input(spark):
    df = doubles(spark, [3, 1, 2])
    assert sorted(r.v for r in extremes(df, "v", 2).collect()) == [1, 2, 2, 3]


def test_density_keeps_edges_and_drops_outside(spark):
    df = spark.createDataFrame([(0.0, 0.0), (10.0, 10.0), (10.1, 5.0), (None, 1.0)], "x double, y double")
    assert rows(density_grid(df, "x", "y", 2, 2, (0, 10), (0, 10))) == [(0, 0, 1), (1, 1, 1)]


def test_plans_stay_on_the_jvm(spark):
    df = spark.createDataFrame([("a", 1.0)], "g string, v double")
    for plan in map(plan_of, (box_stats(df, "v", "g"), histogram(df, "v", 3), describe(df), missing_report(df))):
        for bad in ("NestedLoop", "Cartesian", "BatchEval", "ArrowEval"):
            assert bad not in plan
