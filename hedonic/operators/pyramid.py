"""Counts of points around places, by walking places down a pyramid of the points' cells.

Points of interest are few next to properties.  Their distinct locations are filed in
square cells, a cell with many of them in 4 x 4 smaller ones, and so on: a pyramid, built
once from the finest cells by shifts, and sent to every executor after its size was
measured (around outlines, more points are dealt to several pyramids, whose counts add up).

A place starts at the cells within the largest radius and goes down level by level.  From
the box of the points in a cell and the place's own box a cell is, for each radius, wholly
inside (its totals count), wholly outside, or undecided.  Undecided cells with many points
give way to their parts; the points of the others are looked at.  Places never meet in a
cell of their own, so that however many share a spot they spread over all tasks, and no
pair of a place and a cell is ever written down.

A place may be an outline of any number of rings (parts and holes alike).  One far wider
than the largest radius starts at wider cells, so that it does not set the cells of the
others.  Points that the box cannot decide meet the outline's sides, one row a side: the
least distance and the parity of crossings are plain aggregates.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hedonic.functions.geo import buffer_metric, sector
from hedonic.session import settle

# Distinct points of one pyramid: what is broadcast has less than a row of a hundred bytes for each.
HELD_SPOTS = 20_000
# A cell with more points is cut further.
LEAF_SPOTS = 100
# A cell is cut into 4 x 4, so many times at most.
LEVEL_BITS, DEPTH = 2, 10
# Cell numbers stay below this, so that sums and shifts of them are exact.
CELL_RANGE = 1 << 61
# Relative slack between box arithmetic and a test that rounds differently.
SLACK = 1e-9
# Places that a task walks down.
TASK_PLACES = 4_000

CELL = ("lvl", "cx", "cy", "cn", "bx0", "bx1", "by0", "by1")


def cell_number(at: Column, size: float) -> Column:
    """The cell of a coordinate; places out of range share the outermost one."""
    return F.floor(F.greatest(F.least(at / size, F.lit(float(CELL_RANGE))), F.lit(-float(CELL_RANGE)))).cast("long")


def _any(flags: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, flags)


def _gap(x0: Column, x1: Column, b0: Column, b1: Column) -> Column:
    return F.greatest(F.lit(0.0), b0 - x1, x0 - b1)


def _far(x0: Column, x1: Column, b0: Column, b1: Column) -> Column:
    return F.greatest(b1 - x0, x1 - b0)


class Pyramid:
    """The cells of ``spots`` (``px, py`` and tallies) from ``above`` levels over the base cells down.

    ``far`` bounds the coordinates: cells become no smaller than numbers can tell apart.
    """

    def __init__(self, spots: DataFrame, tallies: Sequence[str], size: float, above: int, far: float):
        self.tallies, self.size = list(tallies), size
        room = (math.log2(CELL_RANGE) - math.log2(max(far / size, 1.0))) // LEVEL_BITS
        finest = max(0, min(DEPTH, int(room) - 1))
        width = size / 2 ** (LEVEL_BITS * finest)
        placed = spots.withColumns({"fx": cell_number(F.col("px"), width), "fy": cell_number(F.col("py"), width)})
        placed = placed.withColumn("lvl", F.explode(F.sequence(F.lit(-above), F.lit(finest))))
        shift = f"{LEVEL_BITS} * ({finest} - lvl)"
        placed = placed.withColumns({"cx": F.expr(f"shiftright(fx, {shift})"), "cy": F.expr(f"shiftright(fy, {shift})")})
        cells = placed.groupBy("lvl", "cx", "cy").agg(
            F.count(F.lit(1)).alias("cn"), F.min("px").alias("bx0"), F.max("px").alias("bx1"), F.min("py").alias("by0"),
            F.max("py").alias("by1"), *[F.sum(t).alias(t) for t in tallies],
        )
        cells = settle(cells)
        self.heavy = (F.col("cn") > LEAF_SPOTS) & (F.col("lvl") < finest)
        up = cells.where(self.heavy).select(
            (F.col("lvl") + 1).alias("lvl"), F.col("cx").alias("hx"), F.col("cy").alias("hy")
        )
        above_base = cells.where("lvl <= 0")
        parts = cells.where("lvl > 0").withColumns({"hx": F.shiftright("cx", LEVEL_BITS), "hy": F.shiftright("cy", LEVEL_BITS)})
        parts = parts.join(up, ["lvl", "hx", "hy"], "left_semi")
        self.cells = above_base.unionByName(parts.drop("hx", "hy"))
        self.steps = sorted(r.lvl for r in cells.where(self.heavy).select("lvl").distinct().collect())
        leaves = self.cells.where(~self.heavy).select("lvl", "cx", "cy")
        points = placed.select("lvl", "cx", "cy", "px", "py", *[F.col(t).alias(f"p_{t}") for t in tallies])
        self.points = points.join(leaves, ["lvl", "cx", "cy"], "left_semi")

    def around(self, places: DataFrame, box: Sequence[str], radii: Sequence[float], sure, reach) -> DataFrame:
        """Rows of a place and a cell, ``px, py`` and tallies: points of undecided cells, totals of the others.

        ``far2`` of a cell that lies wholly inside some radius is set, ``px`` is missing then.
        ``sure`` and ``reach`` bound a radius from below and above.
        """
        x0, x1, y0, y1 = map(F.col, box)
        most = max(map(reach, radii))
        own = [c for c in places.columns if c != "lvl"]

        def span(low: Column, high: Column) -> Column:
            ends = [cell_number(c, self.size) for c in (low - most, high + most)]
            return F.sequence(*[_shifted(c, -LEVEL_BITS * F.col("lvl")) for c in ends])

        rows = places.withColumn("cx", F.explode(span(x0, x1))).withColumn("cy", F.explode(span(y0, y1)))
        rows = rows.join(F.broadcast(self.cells.where("lvl <= 0")), ["lvl", "cx", "cy"])

        def judged(df: DataFrame) -> DataFrame:
            gx, gy = _gap(x0, x1, F.col("bx0"), F.col("bx1")), _gap(y0, y1, F.col("by0"), F.col("by1"))
            fx, fy = _far(x0, x1, F.col("bx0"), F.col("bx1")), _far(y0, y1, F.col("by0"), F.col("by1"))
            df = df.withColumns({"gap2": gx * gx + gy * gy, "far2": fx * fx + fy * fy}).where(F.col("gap2") <= most**2)
            undecided = [(F.col("far2") > sure(r) ** 2) & (F.col("gap2") <= reach(r) ** 2) for r in radii]
            return df.withColumn("open", _any(undecided)).drop("gap2")

        rows = judged(rows)
        for level in self.steps:
            cut = F.col("open") & (F.col("lvl") == level) & self.heavy
            rows = rows.withColumns({"hx": F.when(cut, F.col("cx")), "hy": F.when(cut, F.col("cy"))})
            part = self.cells.where(F.col("lvl") == level + 1)
            hold = [F.shiftright("cx", LEVEL_BITS).alias("hx"), F.shiftright("cy", LEVEL_BITS).alias("hy")]
            part = part.select(*hold, *[F.col(c).alias(f"_{c}") for c in (*CELL, *self.tallies)])
            rows = rows.join(F.broadcast(part), ["hx", "hy"], "left")
            rows = judged(rows.select(*own, *[F.coalesce(f"_{c}", c).alias(c) for c in (*CELL, *self.tallies)]))
        rows = rows.withColumns({f"_{c}": F.when(F.col("open"), F.col(c)) for c in ("lvl", "cx", "cy")}).drop("lvl", "cx", "cy")
        points = self.points.withColumnsRenamed({c: f"_{c}" for c in ("lvl", "cx", "cy")})
        rows = rows.join(F.broadcast(points), ["_lvl", "_cx", "_cy"], "left")
        return rows.select(*own, "far2", "px", "py", *[F.coalesce(f"p_{t}", t).alias(t) for t in self.tallies])


def _shifted(cell: Column, bits: Column) -> Column:
    return F.call_function("shiftright", cell, bits.cast("int"))


def start_level(box: Sequence[str], size: float) -> Column:
    """0, or as many levels up as a box is wider than the base cells."""
    x0, x1, y0, y1 = map(F.col, box)
    width = F.greatest(x1 - x0, y1 - y0) / size
    up = F.ceil(F.log2(F.greatest(width, F.lit(1.0))) / LEVEL_BITS)
    return (-F.least(up, F.lit(24))).cast("int")


def extent(spots: DataFrame) -> tuple[int, float]:
    """Number of points, and their farthest coordinate."""
    n, far = spots.agg(F.count(F.lit(1)), F.max(F.greatest(F.abs("px"), F.abs("py")))).head()
    return n, far or 0.0


def _slices(spots: DataFrame, n: int, held: int) -> list[DataFrame]:
    parts = max(1, -(-n // held))
    if parts == 1:
        return [spots]
    return [spots.where(F.pmod(F.xxhash64("px", "py"), F.lit(parts)) == i) for i in range(parts)]


def _walked(places: DataFrame) -> DataFrame:
    """Distinct places dealt evenly to tasks, for the work on each is many times its size.

    The number of tasks is set before the distinct, which then needs no shuffle of its own
    (one whose few bytes would be put back into a single task).
    """
    tasks = max(places.sparkSession.sparkContext.defaultParallelism, -(-places.count() // TASK_PLACES))
    return places.repartition(tasks, *places.columns[:2]).distinct()


def _nested(rows: DataFrame, keys: Sequence[str], tallies: Sequence[str], radii: Sequence[float], within: Sequence[Column], names) -> DataFrame:
    """Sums of rows that lie ``within`` a radius and so in all larger ones: by the smallest radius first, then of those."""
    order = sorted(range(len(radii)), key=lambda i: radii[i])
    smallest = reduce(lambda when, k: when.when(within[order[k]], F.lit(k)), range(1, len(order)), F.when(within[order[0]], F.lit(0)))
    near = rows.select(*keys, *tallies, smallest.alias("smallest")).where(F.col("smallest").isNotNull())
    once = near.groupBy(*keys, "smallest").agg(*[F.sum(t).alias(t) for t in tallies])
    rank = {i: k for k, i in enumerate(order)}
    sums = [F.sum(F.when(F.col("smallest") <= rank[i], F.col(tallies[j])).otherwise(F.lit(0))).alias(n) for (i, j), n in names.items()]
    return once.groupBy(*keys).agg(*sums)


def _totals(rows: DataFrame, keys: Sequence[str], tallies: Sequence[str], within: Sequence[Column], names) -> DataFrame:
    """Sums of rows by each radius they lie ``within``."""
    flags = [f"w{i}" for i in range(len(within))]
    near = rows.select(*keys, *tallies, *[w.alias(f) for w, f in zip(within, flags)]).where(_any([F.col(f) for f in flags]))
    sums = [F.sum(F.when(F.col(f"w{i}"), F.col(tallies[j])).otherwise(F.lit(0))).alias(n) for (i, j), n in names.items()]
    return near.groupBy(*keys).agg(*sums)


def _added(parts: list[DataFrame], keys: Sequence[str], names) -> DataFrame:
    if len(parts) == 1:
        return parts[0]
    whole = reduce(DataFrame.unionByName, parts)
    return whole.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in names.values()])


def counts_around_points(
    places: DataFrame, spots: DataFrame, tallies: Sequence[str], radii: Sequence[float], names, quad_segs: int | None, far: float
) -> DataFrame:
    """Counts ``names`` (by radius and tally) of ``spots`` around each place ``x, y``, repeated or not."""
    metric, bound = buffer_metric(F.col("px") - F.col("x"), F.col("py") - F.col("y"), quad_segs)
    # For circles the box corners bound each offset and rounding is monotone, so no slack is needed.
    inner = 1.0 if quad_segs is None else math.cos(sector(quad_segs) / 2) * (1 - SLACK)
    outer = 1.0 if quad_segs is None else 1 + SLACK
    size, box = max(radii) * (1 + 1e-6), ("x", "x", "y", "y")
    rows = _walked(places.select("x", "y")).withColumn("lvl", F.lit(0))
    found = Pyramid(spots, tallies, size, 0, far).around(rows, box, radii, lambda r: r * inner, lambda r: r * outer)
    whole = F.col("px").isNull()
    within = [F.when(whole, F.col("far2") <= (r * inner) ** 2).otherwise(metric <= bound(r)) for r in map(float, radii)]
    return _nested(found, ["x", "y"], tallies, radii, within, names)


def ring_table(places: DataFrame, keys: Sequence[str], rings: str = "rings") -> DataFrame:
    """``keys, ax, ay, bx, by``: the sides of all rings, one row each.  A ring may repeat its first corner or not."""
    ring = places.select(*keys, F.explode(rings).alias("ring")).where(F.size("ring") > 0)
    after = F.concat(F.slice("ring", F.lit(2), F.greatest(F.size("ring") - 1, F.lit(0))), F.slice("ring", 1, 1))
    side = ring.select(*keys, F.explode(F.arrays_zip(F.col("ring").alias("a"), after.alias("b"))).alias("s"))
    return side.select(*keys, F.col("s.a.x").alias("ax"), F.col("s.a.y").alias("ay"), F.col("s.b.x").alias("bx"), F.col("s.b.y").alias("by"))


def side_tests(x: Column, y: Column) -> tuple[Column, Column]:
    """Squared distance of a point to the side ``ax, ay, bx, by`` of its row, and whether its ray to the right crosses it."""
    ax, ay, bx, by = (F.col(c) for c in ("ax", "ay", "bx", "by"))
    ux, uy, dx, dy = bx - ax, by - ay, x - ax, y - ay
    length2 = ux * ux + uy * uy
    along = F.when(length2 > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), (dx * ux + dy * uy) / length2))).otherwise(F.lit(0.0))
    gx, gy = dx - along * ux, dy - along * uy
    straddles = (ay > y) != (by > y)
    crosses = F.when(straddles, x < ax + dy * ux / uy).otherwise(F.lit(False))
    return gx * gx + gy * gy, crosses


def counts_around_outlines(
    places: DataFrame, spots: DataFrame, tallies: Sequence[str], radii: Sequence[float], names, keys: Sequence[str], held: int
) -> DataFrame:
    """Counts of ``spots`` around each place ``keys, rings, x0, x1, y0, y1``; inside an outline the distance is 0."""
    size, box = max(radii) * (1 + 1e-6), ("x0", "x1", "y0", "y1")
    boxes = _walked(places.select(*keys, *box)).withColumn("lvl", start_level(box, size))
    above = -(boxes.agg(F.min("lvl")).head()[0] or 0)
    sides = ring_table(places, keys)
    radii = [float(r) for r in radii]
    x0, x1, y0, y1 = map(F.col, box)
    px, py = F.col("px"), F.col("py")

    def sure(r: float) -> float:
        return r * (1 - SLACK)

    def reach(r: float) -> float:
        return r * (1 + SLACK)

    n, far = extent(spots)
    parts = []
    for part in _slices(spots, n, held):
        found = Pyramid(part, tallies, size, above, far).around(boxes, box, radii, sure, reach)
        gx, gy, fx, fy = _gap(x0, x1, px, px), _gap(y0, y1, py, py), _far(x0, x1, px, px), _far(y0, y1, py, py)
        found = found.withColumns({"far2": F.when(px.isNull(), F.col("far2")).otherwise(fx * fx + fy * fy), "gap2": gx * gx + gy * gy})
        within = [F.col("far2") <= sure(r) ** 2 for r in radii]
        parts.append(_nested(found, keys, tallies, radii, within, names))
        # Few points lie where the box cannot tell: those meet the sides.
        opens = [px.isNotNull() & ~w & (F.col("gap2") <= reach(r) ** 2) for w, r in zip(within, radii)]
        unsure = found.select(*keys, "px", "py", *tallies, *[o.alias(f"o{i}") for i, o in enumerate(opens)])
        unsure = settle(unsure.where(_any([F.col(f"o{i}") for i in range(len(radii))])))
        d2, crosses = side_tests(px, py)
        met = unsure.join(sides, list(keys)).groupBy(*keys, "px", "py").agg(
            F.min(d2).alias("d2"), F.count_if(crosses).alias("crossed"),
            *[F.max(c).alias(c) for c in (*tallies, *[f"o{i}" for i in range(len(radii))])],
        )
        distance = F.when(F.col("crossed") % 2 == 1, F.lit(0.0)).otherwise(F.sqrt("d2"))
        close = met.withColumn("distance", distance)
        parts.append(_totals(close, keys, tallies, [F.col(f"o{i}") & (F.col("distance") <= r) for i, r in enumerate(radii)], names))
    return _added(parts, keys, names)
