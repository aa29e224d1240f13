"""Proximity counts against brute force, under skew, and their plans."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hedonic.operators import proximity, pyramid, strips
from hedonic.operators.layers import DEFAULT_LAYERS, LayerSpec, poi_layer, stack_layers
from hedonic.operators.proximity import count_name, outline_counts, proximity_counts
from tests.conftest import rows

RADII = (1000, 5000, 20000)


def frame(spark, points, schema):
    return spark.createDataFrame([tuple(p) for p in points], schema)


def brute(props, pois, layers, radii, mode="rows"):
    """Counts by looking at every pair."""
    out = {}
    seen = set()
    for pin, x, y in props:
        counts = out.setdefault(pin, [0] * (len(layers) * len(radii)))
        if x is None or y is None or (mode == "distinct" and (pin, x, y) in seen):
            continue
        seen.add((pin, x, y))
        for layer, px, py in pois:
            if layer not in layers or px is None or py is None:
                continue
            d2 = (px - x) * (px - x) + (py - y) * (py - y)
            for i, r in enumerate(radii):
                if d2 <= r * r:
                    counts[layers.index(layer) * len(radii) + i] += 1
    return sorted((pin, *c) for pin, c in out.items())


def run(spark, props, pois, layers, radii=RADII, **kw):
    df = proximity_counts(
        frame(spark, props, "pin string, x double, y double"),
        frame(spark, pois, "layer string, x double, y double"), layers, radii, **kw,
    )
    assert df.columns == ["pin", *[count_name(la, r) for la in layers for r in radii]]
    return rows(df)


PROPS = [("A", 0.0, 0.0), ("A", 0.0, 0.0), ("B", 6000.0, 0.0), ("C", 100000.0, 0.0)]
POIS = [("p", x, y) for x, y in ((1000.0, 0.0), (1001.0, 0.0), (0.0, 5000.0), (6000.0, 20000.0), (None, None))]


@pytest.mark.parametrize(
    "mode, expected",
    [
        ("rows", [("A", 2, 6, 6), ("B", 0, 2, 4), ("C", 0, 0, 0)]),
        ("distinct", [("A", 1, 3, 3), ("B", 0, 2, 4), ("C", 0, 0, 0)]),
    ],
)
def test_hand_checked(spark, mode, expected):
    assert run(spark, PROPS, POIS, ["p"], mode=mode) == expected


def test_property_without_place_counts_zero(spark):
    props = [("A", None, None), ("B", float("nan"), 1.0), ("C", 1.0, 1.0)]
    assert run(spark, props, [("p", 0.0, 0.0)], ["p"]) == [("A", 0, 0, 0), ("B", 0, 0, 0), ("C", 1, 1, 1)]


def test_no_points_at_all(spark):
    assert run(spark, PROPS, [("other", 0.0, 0.0)], ["p"]) == [("A", 0, 0, 0), ("B", 0, 0, 0), ("C", 0, 0, 0)]


def cloud(seed, n, centre, spread, grid=None):
    rng = np.random.default_rng(seed)
    xy = rng.normal(centre, spread, (n, 2))
    return np.round(xy / grid) * grid if grid else xy


@pytest.mark.parametrize("budget, leaf", [(10**9, None), (200, None), (1, None), (None, 1), (None, 5), (None, 1000)])
@pytest.mark.parametrize("mode", ["rows", "distinct"])
def test_equals_brute_force_at_every_depth(spark, monkeypatch, budget, leaf, mode):
    # A third of both sides sits in one spot-sized cluster, some places repeat,
    # coordinates go negative and many distances fall exactly on a radius.
    place = np.vstack([cloud(1, 60, 0, 15000, 500), cloud(2, 30, -7000, 40, 20)])
    point = np.vstack([cloud(3, 80, 0, 15000, 500), cloud(4, 40, -7600, 40, 20)])
    props = [(f"k{i % 70}", float(x), float(y)) for i, (x, y) in enumerate(place)] + [("lost", None, 3.0)]
    pois = [("abc"[i % 3], float(x), float(y)) for i, (x, y) in enumerate(point)]
    if leaf is None:
        got = run(spark, props, pois, ["a", "b"], mode=mode, pair_budget=budget, held=0)
    else:
        monkeypatch.setattr(pyramid, "LEAF_SPOTS", leaf)
        got = run(spark, props, pois, ["a", "b"], mode=mode)
    assert got == brute(props, pois, ["a", "b"], RADII, mode)


def test_work_of_one_cell_is_dealt_over_salts(spark, monkeypatch):
    place, point = cloud(12, 80, 0, 3000, 10), cloud(13, 90, 0, 3000, 10)
    props = [(str(i), float(x), float(y)) for i, (x, y) in enumerate(place)]
    pois = [("p", float(x), float(y)) for x, y in point]
    monkeypatch.setattr(proximity, "TASK_PAIRS", 50)
    assert run(spark, props, pois, ["p"], held=0) == brute(props, pois, ["p"], RADII, "rows")


@pytest.mark.parametrize("held", [0, 1000])
def test_far_and_infinite_coordinates(spark, held):
    props = [("A", 1e15, -1e15), ("B", float("inf"), 0.0), ("C", 3e300, 0.0)]
    pois = [("p", 1e15, -1e15), ("p", 1e15 + 1, -1e15), ("p", 3e300, 0.0), ("p", float("-inf"), 0.0)]
    assert run(spark, props, pois, ["p"], (1,), held=held) == [("A", 2), ("B", 0), ("C", 1)]


def test_copies_of_one_point_cost_one(spark):
    props = [("A", 10.0, 10.0)] * 300 + [("B", 500.0, 0.0)]
    pois = [("p", 0.0, 0.0)] * 400
    assert run(spark, props, pois, ["p"], (100, 600)) == [("A", 120000, 120000), ("B", 0, 400)]


def test_hot_cell_is_refined_not_listed(spark, monkeypatch):
    """With everything in one base cell the exact tests stay far under all pairs."""
    n = 4000
    place, point = cloud(5, n, 0, 3000), cloud(6, n, 0, 3000)
    tested = []
    real = proximity.math.ceil
    monkeypatch.setattr(proximity.math, "ceil", lambda v: tested.append(v * proximity.TASK_PAIRS) or real(v))
    props = [(str(i), float(x), float(y)) for i, (x, y) in enumerate(place)]
    pois = [("p", float(x), float(y)) for x, y in point]
    got = run(spark, props, pois, ["p"], pair_budget=400, held=0)
    assert run(spark, props, pois, ["p"]) == got
    d2 = ((place[:, None, :] - point[None, :, :]) ** 2).sum(axis=2)
    expected = sorted((str(i), *[int((row <= r * r).sum()) for r in RADII]) for i, row in enumerate(d2))
    assert got == expected
    assert sum(tested) < n * n / 4


def test_counts_grow_with_radius_and_ignore_partitioning(spark):
    place, point = cloud(7, 200, 0, 9000), cloud(8, 300, 0, 9000)
    props = frame(spark, [(str(i), *map(float, p)) for i, p in enumerate(place)], "pin string, x double, y double")
    pois = frame(spark, [("p", *map(float, p)) for p in point], "layer string, x double, y double")
    once = rows(proximity_counts(props, pois, ["p"]))
    again = rows(proximity_counts(props.repartition(13), pois.repartition(5), ["p"]))
    assert once == again
    assert all(a <= b <= c for _, a, b, c in once)


@pytest.mark.parametrize("held", [0, 1000])
def test_polygon_lies_between_apothem_and_circle(spark, held):
    place, point = cloud(9, 150, 0, 9000, 10), cloud(10, 250, 0, 9000, 10)
    props = [(str(i), *map(float, p)) for i, p in enumerate(place)]
    pois = [("p", *map(float, p)) for p in point]
    got = run(spark, props, pois, ["p"], (5000,), quad_segs=8, pair_budget=100, held=held)
    step = np.pi / 16
    expected = []
    for pin, x, y in props:
        dx, dy = np.array([p[1] - x for p in pois]), np.array([p[2] - y for p in pois])
        phi = np.mod(np.arctan2(dy, dx), step) - step / 2
        expected.append((pin, int((np.hypot(dx, dy) * np.cos(phi) <= 5000 * np.cos(step / 2)).sum())))
    assert got == sorted(expected)


@pytest.mark.parametrize("held", [10**6, 50])
def test_outlines(spark, held):
    rng = np.random.default_rng(11)
    homes = [(str(i), float(x), float(y), float(w)) for i, (x, y, w) in enumerate(rng.uniform(0, 30000, (60, 3)) / (1, 1, 20))]
    spots = [("p", float(x), float(y)) for x, y in rng.uniform(0, 30000, (120, 2))]
    corner = lambda dx, dy: F.struct((F.col("x") + dx * F.col("w")).alias("x"), (F.col("y") + dy * F.col("w")).alias("y"))
    props = frame(spark, homes, "pin string, x double, y double, w double").select(
        "pin", F.array(corner(-1, -1), corner(1, -1), corner(1, 1), corner(-1, 1)).alias("ring")
    )
    pois = frame(spark, spots, "layer string, x double, y double")
    got = rows(outline_counts(props, pois, ["p"], (1000, 5000), held=held))

    def near(h, r):
        _, x, y, w = h
        return sum(np.hypot(max(abs(px - x) - w, 0), max(abs(py - y) - w, 0)) <= r for _, px, py in spots)

    assert got == sorted((h[0], near(h, 1000), near(h, 5000)) for h in homes)


def outline_distance(rings, x, y):
    """Distance to the area of some rings, even-odd."""
    best, inside = np.inf, False
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
            ux, uy = bx - ax, by - ay
            length2 = ux * ux + uy * uy
            t = min(1, max(0, ((x - ax) * ux + (y - ay) * uy) / length2)) if length2 else 0
            best = min(best, np.hypot(x - ax - t * ux, y - ay - t * uy))
            if (ay > y) != (by > y) and x < ax + (y - ay) * ux / uy:
                inside = not inside
    return 0.0 if inside else best


@pytest.mark.parametrize("leaf", [4, 48])
def test_parts_holes_and_giants(spark, monkeypatch, leaf):
    """Rings with holes and several parts, one outline far wider than any radius, one of a single corner, odd ones."""
    monkeypatch.setattr(pyramid, "LEAF_SPOTS", leaf)
    rng = np.random.default_rng(14)

    def square(x, y, w):
        return [(x - w, y - w), (x + w, y - w), (x + w, y + w), (x - w, y + w)]

    homes = {}
    for i, (x, y, w) in enumerate(rng.uniform(-20000, 20000, (40, 3)).tolist()):
        w = abs(w) / 20
        homes[f"h{i}"] = [square(x, y, w), square(x, y, w / 2)[::-1], square(x + 3 * w, y, w / 3)]
        star = rng.uniform(-w, w, (7, 2)) + (x, y)
        homes[f"s{i}"] = [[tuple(p) for p in star.tolist()]]
    homes["giant"] = [square(0, 0, 60000), square(0, 0, 15000), square(0, 0, 4000)]
    homes["dot"] = [[(100.0, 100.0)]]
    spots = [tuple(p) for p in rng.uniform(-80000, 80000, (150, 2)).tolist()] + [tuple(p) for p in rng.normal(0, 9000, (250, 2)).tolist()]
    rows_ = [(k, [[{"x": float(x), "y": float(y)} for x, y in ring] for ring in rings]) for k, rings in homes.items()]
    rows_ += [("none", None), ("bare", []), ("void", [[]]), ("lost", [[{"x": float("inf"), "y": 0.0}]]), ("half", [[{"x": 1.0, "y": None}]])]
    props = spark.createDataFrame(rows_, "pin string, rings array<array<struct<x: double, y: double>>>")
    pois = frame(spark, [("ab"[i % 2], *p) for i, p in enumerate(spots)], "layer string, x double, y double")
    got = {r[0]: tuple(r[1:]) for r in outline_counts(props, pois, ["a", "b"], (500, 3000)).collect()}
    want = {k: (0,) * 4 for k in ("none", "bare", "void", "lost", "half")}
    for k, rings in homes.items():
        far = [outline_distance(rings, *p) for p in spots]
        want[k] = tuple(sum(d <= r for d in far[j::2]) for j in (0, 1) for r in (500, 3000))
    assert got == want


def test_layers(spark):
    df = spark.createDataFrame([(-122.3321, 47.6062), (None, 47.0)], "Longitude double, Latitude double")
    spec = LayerSpec("Parks_Map", "parks", "Longitude", "Latitude")
    got = poi_layer(df, spec, gid="fill").collect()
    assert got[0].layer == "parks" and got[0].x == pytest.approx(1270714.8, abs=0.05)
    assert got[1].x is None and got[1].y is None
    assert poi_layer(df, spec, gid="null").select("gid").distinct().collect()[0][0] is None
    named = spark.createDataFrame([(-122.0, 47.0)], "long double, lat double")
    tables = {s.source: df if s.lon == "Longitude" else named for s in DEFAULT_LAYERS}
    assert stack_layers(tables.__getitem__).count() == 2 * 2 + 3
    with pytest.raises(ValueError):
        poi_layer(df, LayerSpec("a", "b", srid=3857))


def test_plan_has_no_nested_loop_or_python(spark):
    props = frame(spark, PROPS, "pin string, x double, y double")
    pois = frame(spark, POIS, "layer string, x double, y double")
    df = proximity_counts(props, pois, ["p"])
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("NestedLoop", "Cartesian", "Python", "Arrow"):
        assert bad not in plan


@pytest.mark.parametrize("totals, pairs", [(5_000_000, 1_000_000), (60, 7)])
def test_many_points_and_outlines_meet_in_strips(spark, monkeypatch, totals, pairs):
    """Beyond the held points: several slabs, wide and odd outlines, corners exactly on a radius, no cell pairs, no broadcast points."""
    monkeypatch.setattr(strips, "SLAB_TOTALS", totals)
    monkeypatch.setattr(strips, "CHUNK", 50)
    monkeypatch.setattr(proximity, "PAIR_BUDGET", pairs)
    rng = np.random.default_rng(21)
    square = lambda x, y, w: [(x - w, y - w), (x + w, y - w), (x + w, y + w), (x - w, y + w)]
    homes = {"giant": [square(0.0, 0.0, 60000), square(0.0, 0.0, 15000), square(0.0, 0.0, 4000)], "dot": [[(100.0, 100.0)]]}
    for i, (x, y, w) in enumerate(np.round(rng.uniform(-20000, 20000, (25, 3)) / 500).tolist()):
        x, y, w = 500 * x, 500 * y, 25 * abs(w) + 1
        homes[f"h{i}"] = [square(x, y, w), square(x, y, w / 2)[::-1], square(x + 3 * w, y, w / 3)]
        homes[f"s{i}"] = [[tuple(p) for p in (rng.uniform(-w, w, (7, 2)) + (x, y)).tolist()]]
    spots = [tuple(p) for p in (np.round(rng.uniform(-80000, 80000, (150, 2)) / 500) * 500).tolist()]
    spots += [tuple(p) for p in rng.normal(0, 9000, (250, 2)).tolist()]
    rows_ = [(k, [[{"x": float(x), "y": float(y)} for x, y in ring] for ring in rings]) for k, rings in homes.items()]
    rows_ += [("none", None), ("lost", [[{"x": float("inf"), "y": 0.0}]]), ("half", [[{"x": 1.0, "y": None}]])]
    props = spark.createDataFrame(rows_, "pin string, rings array<array<struct<x: double, y: double>>>")
    pois = frame(spark, [("ab"[i % 2], *p) for i, p in enumerate(spots)], "layer string, x double, y double")
    got = {r[0]: tuple(r[1:]) for r in outline_counts(props, pois, ["a", "b"], (500, 3000), held=0).collect()}
    want = {k: (0,) * 4 for k in ("none", "lost", "half")}
    for k, rings in homes.items():
        far = [outline_distance(rings, *p) for p in spots]
        want[k] = tuple(sum(d <= r for d in far[j::2]) for j in (0, 1) for r in (500, 3000))
    assert got == want
    places = [(k, *map(float, rings[0][0])) for k, rings in homes.items()]
    points = [("ab"[i % 2], *p) for i, p in enumerate(spots)]
    assert run(spark, places, points, ["a", "b"], (500, 3000), held=0, pair_budget=pairs) == brute(places, points, ["a", "b"], (500, 3000))


def test_work_on_a_place_grows_with_the_root_of_the_points():
    """Points that are tested one by one around a place: a few times the root, however many lie near it."""
    tested = []

    class Counting(strips.Buffer):
        def near(self, radius, dx, dy):
            tested.append(len(dx))
            return super().near(radius, dx, dy)

    rng = np.random.default_rng(22)
    x, y = rng.uniform(0, 100_000, (2, 200))
    where = strips.Places(x, y, np.arange(200), np.ones(200, dtype=np.int64))
    for n in (10_000, 160_000):
        px, py = rng.uniform(0, 100_000, (2, n))
        table = pa.table({"px": px, "py": py, "layer": np.zeros(n, dtype=np.int32), "n": np.ones(n, dtype=np.int64)})
        tested.clear()
        for rows_, counts, *_ in strips.spots_around(where, strips.Slab(table, 1), (20000.0,), Counting(), 10**6):
            d2 = (x[rows_, None] - px) ** 2 + (y[rows_, None] - py) ** 2
            assert (counts[:, 0, 0] == (d2 <= 20000.0**2).sum(axis=1)).all()
        assert sum(tested) / 200 < 4 * np.sqrt(n)
