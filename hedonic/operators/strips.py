"""Counts of many points around many places: slabs of points in tasks, cut in strips.

Points are ordered by ``y`` and cut in slabs of bounded size.  A place meets the slabs within
the largest radius; a slab met by many places is dealt over several tasks, each with some of
the places.  Nothing is broadcast but the bounds of the slabs, one row each.

In a task the points lie in strips of equal number, those of a strip ordered by ``x``, with
running totals.  Around a place every radius takes from a strip one stretch of points that
surely lie within it, whose totals are two look-ups, and two short ends, whose points are
tested.  With strips of about the root of the points the work on a place grows with the root
of the points too, whatever cells its neighbours share.

An outline's corners stand for it: what is near a corner is near, and what is near a side of
length ``s`` lies within ``sqrt(r^2 + s^2 / 4)`` of a corner.  Points between the two bounds,
or in the outline's box, meet its sides.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hedonic.functions.geo import sector
from hedonic.session import settle

# Points times layers that a task holds.
SLAB_TOTALS = 5_000_000
# Corners that a task holds, and that it works on at a time.
TASK_CORNERS, CHUNK = 500_000, 8192
# Tasks for each core, so that they end together.
WAVES = 3
# Relative slack between bounds and tests that round differently.
ROUND, CLOSE = 1e-12, 1e-9


@dataclass(frozen=True)
class Buffer:
    """The area around a corner: a circle, or with ``quad_segs`` the polygon inscribed in it."""

    quad_segs: int | None = None

    def half_width(self, radius: float, dy: np.ndarray, slack: float) -> np.ndarray:
        """Half the width of the area at height ``dy`` >= 0, a little more or less by ``slack``; NaN where it has none."""
        if self.quad_segs is None:
            with np.errstate(invalid="ignore", over="ignore"):
                return np.sqrt(radius * radius * (1 + slack) - dy * dy) * (1 + slack)
        angles = np.arange(self.quad_segs + 1) * sector(self.quad_segs)
        grown = radius * (1 + slack)
        return np.interp(dy, grown * np.sin(angles), grown * np.cos(angles), right=np.nan) * (1 + slack)

    def near(self, radius: float, dx: np.ndarray, dy: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
        """Which offsets lie inside, and which are too close to the edge to tell by this arithmetic."""
        d2 = dx * dx + dy * dy
        if self.quad_segs is None:
            return d2 <= radius * radius, None
        step = sector(self.quad_segs)
        bound = radius * math.cos(step / 2)
        metric = np.sqrt(d2) * np.cos(np.mod(np.arctan2(dy, dx), step) - step / 2)
        return metric <= bound * (1 - CLOSE), np.abs(metric - bound) <= bound * CLOSE


def ranges(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which range, and which number, for the numbers of all ranges ``start .. start + size`` in a row."""
    ends = np.cumsum(size)
    which = np.repeat(np.arange(len(size)), size)
    return which, np.arange(ends[-1] if len(ends) else 0) + (start - ends + size)[which]


class Slab:
    """Points ordered by strip and ``x``, with running totals by layer."""

    def __init__(self, points: pa.Table, layers: int):
        x, y = (points.column(c).to_numpy() for c in ("px", "py"))
        n, layer, weight = len(x), points.column("layer").to_numpy(), points.column("n").to_numpy()
        size = strip_size(n, np.ptp(x), np.ptp(y))
        strip = np.empty(n, dtype=np.int64)
        strip[np.argsort(y, kind="stable")] = np.arange(n) // size
        order = np.lexsort((x, strip))
        self.x, self.y, self.layer, self.weight = x[order], y[order], layer[order], weight[order]
        self.bounds = np.append(np.arange(0, n, size), n)
        self.low, self.high = (f.reduceat(self.y, self.bounds[:-1]) for f in (np.minimum, np.maximum))
        # Layers share words, each with as many bits as the weight of all points asks for.
        self.bits = max(1, int(self.weight.sum()).bit_length())
        self.layers, self.shared = layers, max(1, 63 // self.bits)
        place = self.layer // self.shared
        shifted = self.weight << (self.bits * (self.layer % self.shared))
        self.words = [np.where(place == k, shifted, 0) for k in range(-(-layers // self.shared))]
        self.totals = [np.append(0, np.cumsum(w)) for w in self.words]

    def by_layer(self, words: Sequence[np.ndarray]) -> np.ndarray:
        """Sums of words as counts (place, layer)."""
        mask = (1 << self.bits) - 1
        return np.column_stack([(words[j // self.shared] >> (self.bits * (j % self.shared))) & mask for j in range(self.layers)])


def strip_size(n: int, width: float, height: float) -> int:
    """Points of a strip: so many that look-ups and tests take about the same time."""
    shape = width / height if height > 0 else math.inf
    return max(min(n, 64), min(n, int(math.sqrt(n * min(5 * shape, n)))))


@dataclass
class Places:
    """Some places: corners in a row, those of place ``k`` from ``first[k]`` on; ``after`` is where a corner's side ends."""

    cx: np.ndarray
    cy: np.ndarray
    first: np.ndarray
    count: np.ndarray
    after: np.ndarray | None = None

    def take(self, which: np.ndarray) -> Places:
        count = self.count[which]
        _, at = ranges(self.first[which], count)
        first = np.cumsum(count) - count
        after = None
        if self.after is not None:
            after = self.after[at] - np.repeat(self.first[which] - first, count)
        return Places(self.cx[at], self.cy[at], first, count, after)

    def over(self, f: np.ufunc, values: np.ndarray) -> np.ndarray:
        return values if len(values) == len(self.first) else f.reduceat(values, self.first)


def spots_around(places: Places, slab: Slab, radii: Sequence[float], buffer: Buffer, most: int) -> Iterator[tuple]:
    """Yield ``rows, counts``: counts (place, radius, layer), and pairs ``rows, points, radius`` left to an exact test."""
    middle = places.over(np.minimum, places.cy)
    order = np.argsort(middle, kind="stable")
    for part in np.split(order, np.searchsorted(np.cumsum(places.count[order]), np.arange(CHUNK, places.count.sum(), CHUNK))):
        if not len(part):
            continue
        left = places.over(np.minimum, places.cx)[part]
        part = part[np.argsort(left, kind="stable")]
        counts = []
        chunk = Chunk(places.take(part), slab, radii, buffer)
        for i in range(len(radii)):
            words = [np.zeros(len(part), dtype=np.int64) for _ in slab.words]
            for own, point in chunk.count(i, words, most):
                yield part[own], None, point, i
            counts.append(slab.by_layer(words))
        yield part, np.stack(counts, axis=1), None, None


class Chunk:
    """Places worked on together."""

    def __init__(self, places: Places, slab: Slab, radii: Sequence[float], buffer: Buffer):
        self.places, self.slab, self.radii, self.buffer = places, slab, radii, buffer
        self.outlined = places.after is not None
        self.x0, self.x1, self.y0, self.y1 = (
            places.over(f, v) for v in (places.cx, places.cy) for f in (np.minimum, np.maximum)
        )
        # Half the longest side of each outline, squared.
        self.reach2 = np.zeros(len(places.first))
        if self.outlined:
            ux, uy = places.cx[places.after] - places.cx, places.cy[places.after] - places.cy
            self.reach2 = places.over(np.maximum, ux * ux + uy * uy) / 4

    def count(self, i: int, sums: list[np.ndarray], most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Add the words of what lies within radius ``i`` to ``sums``; yield pairs too close to an edge."""
        slab, radius = self.slab, float(self.radii[i])
        outer = np.sqrt(radius * radius + self.reach2) * (1 + ROUND)
        top, bottom = (self.y1 + outer).max(), (self.y0 - outer).min()
        for s in np.flatnonzero((slab.low <= top) & (slab.high >= bottom)).tolist():
            gap = np.maximum(np.maximum(slab.low[s] - self.y1, self.y0 - slab.high[s]), 0.0)
            rows = np.flatnonzero(gap <= outer * (1 + ROUND))
            if not len(rows):
                continue
            lo, a, b, hi = self.stretches(s, rows, radius, outer)
            found = [t[b] - t[a] for t in slab.totals]
            start, size = np.concatenate([lo, b]), np.concatenate([a - lo, hi - b])
            some = np.flatnonzero(size)
            start, size, owner = start[some], size[some], some % len(rows)
            ends = np.cumsum(size)
            # At most so many pairs, or those of one stretch, are listed at a time.
            cuts = np.searchsorted(ends, np.arange(most, ends[-1], most)) if len(some) else []
            cuts = [0, *np.unique(cuts).tolist(), len(some)]
            for begin, end in zip(cuts[:-1], cuts[1:]):
                if begin == end:
                    continue
                which, point = ranges(start[begin:end], size[begin:end])
                own = rows[owner[begin:end]][which]
                near, doubt = self.test(own, point, radius, outer)
                first = ends[begin:end] - size[begin:end] - (ends[begin] - size[begin])
                # The left ends of places come before the right ones, each place once in both.
                half = begin + np.searchsorted(some[begin:end], len(rows))
                for f, word in zip(found, slab.words):
                    added = np.add.reduceat(word[point] * near, first)
                    f[owner[begin:half]] += added[: half - begin]
                    f[owner[half:end]] += added[half - begin :]
                if doubt is not None and doubt.any():
                    yield own[doubt], point[doubt]
            for total, f in zip(sums, found):
                if len(rows) == len(total):
                    total += f
                else:
                    total[rows] += f

    def stretches(self, s: int, rows: np.ndarray, radius: float, outer: np.ndarray) -> tuple[np.ndarray, ...]:
        """Per place the points of a strip that may be near, ``lo .. hi``, and of them those that surely are, ``a .. b``."""
        slab, low, high = self.slab, self.slab.low[s], self.slab.high[s]
        places = self.places if len(rows) == len(self.places.first) else self.places.take(rows)
        cx, cy = places.cx, places.cy
        below, above = low - cy, cy - high
        inner = self.buffer.half_width(radius, np.maximum(np.abs(below), np.abs(above)), -ROUND)
        wide = np.repeat(outer[rows], places.count) if self.outlined else radius
        wide = self.buffer.half_width(wide, np.maximum(np.maximum(below, above), 0.0), ROUND)
        slack = (np.abs(cx) + radius) * 1e-15
        out, sure = wide + slack + wide * ROUND, inner - slack
        # A corner without an own stretch, NaN, neither widens nor narrows that of its outline.
        l_out, r_out = places.over(np.fmin, cx - out), places.over(np.fmax, cx + out)
        l_in, r_in = cx - sure, cx + sure
        l_in[~(sure >= 0)] = r_in[~(sure >= 0)] = np.nan
        first, last = places.over(np.fmin, l_in), places.over(np.fmax, r_in)
        # Stretches with a point in common are one.
        joined = places.over(np.fmax, l_in) <= places.over(np.fmin, r_in)
        begin, end = slab.bounds[s], slab.bounds[s + 1]
        x = slab.x[begin:end]
        some = ~np.isnan(l_out)
        lo = begin + np.where(some, x.searchsorted(l_out, "left"), 0)
        hi = begin + np.where(some, x.searchsorted(r_out, "right"), 0)
        a = np.where(joined, begin + x.searchsorted(first, "left"), hi)
        b = np.where(joined, begin + x.searchsorted(last, "right"), hi)
        a = np.clip(a, lo, hi)
        return lo, a, np.clip(b, a, hi), hi

    def test(self, own: np.ndarray, point: np.ndarray, radius: float, outer: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
        px, py = self.slab.x[point], self.slab.y[point]
        if not self.outlined:
            return self.buffer.near(radius, px - self.places.cx[own], py - self.places.cy[own])
        places = self.places
        which, at = ranges(places.first[own], places.count[own])
        dx, dy = px[which] - places.cx[at], py[which] - places.cy[at]
        offsets = np.cumsum(places.count[own]) - places.count[own]
        d2 = np.minimum.reduceat(dx * dx + dy * dy, offsets)
        near = d2 <= radius * radius * (1 - CLOSE)
        boxed = (px >= self.x0[own]) & (px <= self.x1[own]) & (py >= self.y0[own]) & (py <= self.y1[own])
        open_ = np.flatnonzero(~near & (boxed | (d2 <= outer[own] ** 2 * (1 + CLOSE))))
        if len(open_):
            near[open_] = self.distance(own[open_], px[open_], py[open_]) <= radius
        return near, None

    def distance(self, own: np.ndarray, px: np.ndarray, py: np.ndarray) -> np.ndarray:
        """Distance of points to their outlines, 0 inside: the arithmetic of ``pyramid.side_tests``."""
        places = self.places
        size = places.count[own]
        which, at = ranges(places.first[own], size)
        x, y, ax, ay = px[which], py[which], places.cx[at], places.cy[at]
        by = places.cy[places.after[at]]
        ux, uy, dx, dy = places.cx[places.after[at]] - ax, by - ay, x - ax, y - ay
        length2 = ux * ux + uy * uy
        along = np.where(length2 > 0, np.clip((dx * ux + dy * uy) / length2, 0.0, 1.0), 0.0)
        gx, gy = dx - along * ux, dy - along * uy
        crosses = ((ay > y) != (by > y)) & (x < ax + dy * ux / uy)
        offsets = np.cumsum(size) - size
        d2 = np.minimum.reduceat(gx * gx + gy * gy, offsets)
        return np.where(np.add.reduceat(crosses.astype(np.int64), offsets) % 2 == 1, 0.0, np.sqrt(d2))


def outline_places(rings: pa.ChunkedArray) -> Places:
    """Corners and sides of ``array<array<struct<x,y>>>``, none of them missing or empty."""
    parts = pa.concat_arrays(rings.chunks)
    of_ring = parts.flatten()
    rings_of = np.append(0, np.cumsum(np.asarray(parts.value_lengths())))
    sizes = np.asarray(of_ring.value_lengths())
    ends = np.append(0, np.cumsum(sizes))
    corners = of_ring.flatten()
    x, y = (corners.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
    after = np.arange(1, len(x) + 1)
    after[ends[1:] - 1] = ends[:-1]
    first = ends[rings_of]
    return Places(x, y, first[:-1], np.diff(first), after)


def counts_in_strips(
    places: DataFrame, spots: DataFrame, keys: Sequence[str], box: Sequence[str], tallies: Sequence[str],
    radii: Sequence[float], names: dict, most: int, pairs: int, quad_segs: int | None = None, exact: Callable | None = None,
) -> DataFrame:
    """Counts ``names`` (by radius and tally) of ``spots`` around distinct ``places``.

    Places have ``keys``, the columns ``box`` (low and high x, low and high y), and ``rings``
    where they are outlines.  ``most`` pairs of a place and a point are listed at a time,
    ``pairs`` of a corner and a strip make a task.  ``exact(radius)`` is the condition
    of a pair ``x, y, px, py`` too close to a polygon's edge.
    """
    layers, radii = len(tallies), [float(r) for r in radii]
    outlined = "rings" in places.columns
    each = [F.struct(F.lit(j).alias("layer"), F.col(t).cast("long").alias("n")) for j, t in enumerate(tallies)]
    points = spots.select("px", "py", F.inline(F.array(*each))).where("n > 0")
    slabs = 1 + points.count() // (SLAB_TOTALS // layers)
    points = settle(points.repartitionByRange(slabs, "py", "px").withColumn("slab", F.spark_partition_id()))
    held = points.groupBy("slab").agg(
        F.count(F.lit(1)).alias("points"), F.min("px").alias("bx0"), F.max("px").alias("bx1"),
        F.min("py").alias("by0"), F.max("py").alias("by1"),
    )
    held = settle(held)
    # A place meets the slabs that its box, widened by the largest radius, touches.
    x0, x1, y0, y1 = map(F.col, box)
    reach = max(radii) * (1 + CLOSE)

    def touches(low: Column, high: Column, b0: str, b1: str) -> Column:
        return (F.col(b0) - high <= reach) & (low - F.col(b1) <= reach)

    meeting = places.join(F.broadcast(held.drop("points")), touches(x0, x1, "bx0", "bx1") & touches(y0, y1, "by0", "by1"))
    meeting = meeting.drop("bx0", "bx1", "by0", "by1")
    corners = F.size(F.flatten("rings")) if outlined else F.lit(1)
    load = meeting.groupBy("slab").agg(F.sum(corners).alias("corners")).join(held, "slab").collect()  # a row per slab
    work = {r.slab: r.corners * -(-r.points // strip_size(r.points, r.bx1 - r.bx0, r.by1 - r.by0)) for r in load}
    if not work:
        return _sums(places.select(*keys, *_none(names)).limit(0), keys, names, None, radii)
    cores = places.sparkSession.sparkContext.defaultParallelism
    share = max(1, sum(work.values()) // (WAVES * cores))
    salts = [(r.slab, max(math.ceil(work[r.slab] / pairs), -(-work[r.slab] // share), -(-r.corners // TASK_CORNERS))) for r in load]
    tasks = sum(s for _, s in salts)
    salts = F.broadcast(places.sparkSession.createDataFrame(salts, "slab int, salts int"))
    # Small in bytes and large in work: the number of tasks is set, and twice as large, for hashes share some.
    a = points.join(salts, "slab").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    a = a.select("slab", "salt", "px", "py", "layer", "n").repartition(2 * tasks, "slab", "salt")
    b = meeting.join(salts, "slab").withColumn("salt", F.pmod(F.xxhash64(*keys), F.col("salts").cast("long")).cast("int"))
    b = b.select("slab", "salt", *keys, *(["rings"] if outlined else [])).repartition(2 * tasks, "slab", "salt")
    columns = list(names.items())
    fields = [places.schema[k] for k in keys]
    schema = ", ".join([*[f"{f.name} {f.dataType.simpleString()}" for f in fields], "px double", "py double", *[f"{n} long" for n in names.values()]])
    buffer = Buffer(quad_segs)

    def count(spots: pa.Table, places: pa.Table) -> pa.Table:
        with np.errstate(all="ignore"):  # what overflows is beyond every radius
            return _counted(spots, places)

    def _counted(spots: pa.Table, places: pa.Table) -> pa.Table:
        own = [places.column(k).to_numpy() for k in keys]
        found: list[list[np.ndarray]] = []
        if len(own[0]) and spots.num_rows:
            slab = Slab(spots, layers)
            if outlined:
                where = outline_places(places.column("rings"))
            else:
                where = Places(own[0], own[1], np.arange(len(own[0])), np.ones(len(own[0]), dtype=np.int64))
            for rows, counts, point, radius in spots_around(where, slab, radii, buffer, most):
                if counts is not None:
                    some = np.flatnonzero(counts.any(axis=(1, 2)))
                    rows, missing = rows[some], np.full(len(some), np.nan)
                    found.append([*[k[rows] for k in own], missing, missing, *[counts[some, i, j] for (i, j), _ in columns]])
                else:
                    n = [np.where((slab.layer[point] == j) & (i == radius), slab.weight[point], 0) for (i, j), _ in columns]
                    found.append([*[k[rows] for k in own], slab.x[point], slab.y[point], *n])
        types = [places.schema.field(k).type for k in keys] + [pa.float64()] * 2 + [pa.int64()] * len(columns)
        arrays = [pa.array(np.concatenate(c) if found else [], t) for c, t in zip(zip(*found) if found else [()] * len(types), types)]
        return pa.Table.from_arrays(arrays, names=[*keys, "px", "py", *[n for _, n in columns]])

    counted = a.groupBy("slab", "salt").cogroup(b.groupBy("slab", "salt")).applyInArrow(count, schema)
    return _sums(counted, keys, names, exact, radii)


def _none(names: dict) -> list[Column]:
    return [F.lit(float("nan")).alias("px"), F.lit(float("nan")).alias("py"), *[F.lit(0).cast("long").alias(n) for n in names.values()]]


def _sums(counted: DataFrame, keys: Sequence[str], names: dict, exact: Callable | None, radii: Sequence[float]) -> DataFrame:
    """Sums by place; rows with a point are pairs still to be tested."""
    if exact is None:
        return counted.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in names.values()])
    near = {i: F.isnan("px") | exact(r) for i, r in enumerate(radii)}
    return counted.groupBy(*keys).agg(*[F.sum(F.when(near[i], F.col(n)).otherwise(F.lit(0))).alias(n) for (i, _), n in names.items()])
