"""Points of interest within radii of every property, counted in one job.

Cost follows distinct places, not rows.  Properties and points are first reduced to
distinct locations with multiplicities.  While the distinct points are few, which is
counted, places walk down their pyramid (:mod:`hedonic.operators.pyramid`).  Beyond that,
places meet slabs of points in tasks and count strip by strip
(:mod:`hedonic.operators.strips`).  Results equal the plain theta join.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hedonic.functions.geo import buffer_metric
from hedonic.operators.pyramid import HELD_SPOTS, counts_around_outlines, counts_around_points, extent
from hedonic.operators.skew import is_small, join_lookups
from hedonic.operators.strips import counts_in_strips
from hedonic.session import settle

# Buffer radii in feet.
RADII = (1000, 5000, 20000)

# Pairs of a place and a point that a task lists at a time.
PAIR_BUDGET = 1_000_000
# Pairs of a place (of a corner, for outlines) and a strip of points that make a task.
TASK_PAIRS = 50_000_000


def count_name(layer: str, radius) -> str:
    return f"{layer}_counts{radius:g}"


def proximity_counts(
    props: DataFrame,
    pois: DataFrame,
    layers: Sequence[str],
    radii: Sequence[float] = RADII,
    key: str = "pin",
    mode: str = "rows",
    quad_segs: int | None = None,
    pair_budget: int = PAIR_BUDGET,
    held: int = HELD_SPOTS,
) -> DataFrame:
    """One row per key with columns ``{layer}_counts{radius}``, 0 where nothing is near.

    ``props`` has ``key, x, y`` and ``pois`` has ``layer, x, y`` in the unit of
    ``radii``; boundaries count as near.  ``mode="rows"`` counts once per
    property row, so a key with several rows has its counts multiplied;
    ``mode="distinct"`` counts once per location of the key.  ``quad_segs``
    replaces circles by inscribed polygons.  Up to ``held`` distinct points are sent to
    every executor; of more, a task lists ``pair_budget`` pairs at a time.
    """
    names = _names(layers, radii, mode)
    tallies = [f"n{j}" for j in range(len(layers))]
    visits = _visits(props, key, ["x", "y"], _usable(["x", "y"]))
    spots = settle(_spots(pois, layers))
    sites = visits.where("usable").select("x", "y")
    n, far = extent(spots)
    if n <= held:
        found = counts_around_points(sites, spots, tallies, radii, names, quad_segs, far)
    else:
        metric, bound = buffer_metric(F.col("px") - F.col("x"), F.col("py") - F.col("y"), quad_segs)
        found = counts_in_strips(
            settle(sites.distinct()), spots, ["x", "y"], ("x", "x", "y", "y"), tallies, radii, names, pair_budget, TASK_PAIRS,
            quad_segs, None if quad_segs is None else lambda r: metric <= bound(r),
        )
    return _per_key(visits, found, key, ["x", "y"], names, mode)


def outline_counts(
    props: DataFrame,
    pois: DataFrame,
    layers: Sequence[str],
    radii: Sequence[float] = RADII,
    key: str = "pin",
    mode: str = "rows",
    held: int = HELD_SPOTS,
) -> DataFrame:
    """Like :func:`proximity_counts` for properties given by outlines.

    ``rings`` is an ``array<array<struct<x,y>>>``: outer rings and holes of all parts, in any
    order and direction (a point in an odd number of them is inside).  ``ring`` may stand
    for a single one, an ``array<struct<x,y>>``.  A point inside has distance 0.  An outline
    without a corner, or with one at no finite place, has no place.
    """
    names = _names(layers, radii, mode)
    tallies = [f"n{j}" for j in range(len(layers))]
    rings = F.col("rings") if "rings" in props.columns else F.when(F.col("ring").isNotNull(), F.array("ring"))
    props = props.select(key, F.filter(rings, lambda r: F.size(r) > 0).alias("rings"))
    corners = F.flatten("rings")
    ends = F.transform(corners, lambda p: p["x"] + p["y"])
    usable = F.col("rings").isNotNull() & (F.size(corners) > 0) & F.forall(ends, lambda v: F.abs(v) < float("inf"))
    # Outlines travel as values; two hashes stand for them in groups and joins.
    keys = ["site", "site2"]
    props = props.withColumns({"site": F.xxhash64("rings"), "site2": F.xxhash64("rings", F.lit(1))})
    visits = _visits(props, key, keys, usable)
    xs, ys = F.transform(corners, lambda p: p["x"]), F.transform(corners, lambda p: p["y"])
    box = {"x0": F.array_min(xs), "x1": F.array_max(xs), "y0": F.array_min(ys), "y1": F.array_max(ys)}
    places = settle(props.where(usable).dropDuplicates(keys).select(*keys, "rings", *[c.alias(n) for n, c in box.items()]))
    spots = settle(_spots(pois, layers))
    if extent(spots)[0] <= held:
        found = counts_around_outlines(places, spots, tallies, radii, names, keys, held)
    else:
        box = ("x0", "x1", "y0", "y1")
        found = counts_in_strips(places, spots, keys, box, tallies, radii, names, PAIR_BUDGET, TASK_PAIRS)
    return _per_key(visits, found, key, keys, names, mode)


def _names(layers: Sequence[str], radii: Sequence[float], mode: str) -> dict[tuple[int, int], str]:
    """Output column of each radius and layer."""
    if mode not in ("rows", "distinct"):
        raise ValueError(f"mode must be 'rows' or 'distinct', not {mode!r}")
    return {(i, j): count_name(layer, r) for j, layer in enumerate(layers) for i, r in enumerate(radii)}


def _visits(props: DataFrame, key: str, keys: list[str], usable: Column) -> DataFrame:
    """Rows ``m`` of every key and place."""
    rows = props.select(key, *keys, F.coalesce(usable, F.lit(False)).alias("usable"))
    return settle(rows.groupBy(key, *keys, "usable").agg(F.count(F.lit(1)).alias("m")))


def _per_key(visits: DataFrame, found: DataFrame, key: str, keys: list[str], names, mode: str) -> DataFrame:
    """Counts of places, ``found``, added up by key; keys without a place have zeros."""
    times = F.col("m") if mode == "rows" else F.lit(1)
    located, found = visits.where("usable"), settle(found)
    joined = located.join(F.broadcast(found), keys, "left") if is_small(found) else join_lookups(located, [found], keys, "left")
    near = joined.select(
        key, *[(F.coalesce(F.col(n), F.lit(0)) * times).alias(n) for n in names.values()]
    )
    far = visits.where("NOT usable").select(key, *[F.lit(0).cast("long").alias(n) for n in names.values()])
    return near.unionByName(far).groupBy(key).agg(*[F.sum(n).alias(n) for n in names.values()])


def _usable(cols: Sequence[str]) -> Column:
    """Every coordinate is there and finite."""
    return reduce(lambda a, b: a & b, [F.coalesce(F.abs(F.col(c)) < float("inf"), F.lit(False)) for c in cols])


def _spots(pois: DataFrame, layers: Sequence[str]) -> DataFrame:
    """Distinct points with their number per layer, ``n0, n1, ...``."""
    wanted = pois.where(_usable(["x", "y"]) & F.col("layer").isin(list(layers)))
    per_layer = [F.count_if(F.col("layer") == layer).alias(f"n{j}") for j, layer in enumerate(layers)]
    return wanted.groupBy(F.col("x").alias("px"), F.col("y").alias("py")).agg(*per_layer)
