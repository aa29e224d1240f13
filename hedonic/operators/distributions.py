"""Binned counts and box-plot statistics: the tables behind the plots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hedonic.operators.lookups import ratio
from hedonic.operators.quantiles import approx_quantiles, exact_quantiles, join_groups
from hedonic.session import settle

# Fixed value: reach of a box-plot whisker in interquartile ranges.
WHISKER = 1.5


def histogram(
    df: DataFrame, col: str, bins: int, upper: float | None = None, weight: str | None = None
) -> DataFrame:
    """Equal-width bins from the smallest to the largest value.

    Each bin takes its left edge, the last one both.  Empty bins are listed.
    ``upper`` first drops values not under it; a constant column is widened by
    one half to both sides.  With ``weight`` a row stands for that many values.
    """
    times = F.lit(1) if weight is None else F.col(weight)
    values = df.select(F.col(col).cast("double").alias("_v"), times.cast("long").alias("_w"))
    values = values.where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    if upper is not None:
        values = values.where(F.col("_v") < upper)
    span = values.agg(_span(F.min("_v"), F.max("_v"))).scalar()
    return _listed(_placed(values, span, bins), span, bins)


def _span(lo: Column, hi: Column) -> Column:
    """First and last edge; a single value is widened by one half to both sides."""
    flat = lo == hi
    return F.struct(
        F.when(flat, lo - 0.5).otherwise(lo).alias("lo"),
        F.when(flat, hi + 0.5).otherwise(hi).alias("hi"),
    )


def _edge(i: Column, lo: Column, hi: Column, bins: int) -> Column:
    return F.when(i >= bins, hi).otherwise(lo + i * ((hi - lo) / bins))


def _placed(values: DataFrame, span: Column, bins: int) -> DataFrame:
    """``bin, n`` of values ``_v`` that stand for ``_w`` each."""
    spread = values.select("_v", "_w", span.alias("_s"))
    spread = spread.select("_v", "_w", F.col("_s.lo").alias("_lo"), F.col("_s.hi").alias("_hi"))
    lo, hi, g = F.col("_lo"), F.col("_hi"), F.col("_g")
    guess = F.least(F.floor((F.col("_v") - lo) / ((hi - lo) / bins)), F.lit(bins - 1))
    # Rounding in the division may miss an edge by one bin.
    exact = (
        F.when(F.col("_v") < _edge(g, lo, hi, bins), g - 1)
        .when((F.col("_v") >= _edge(g + 1, lo, hi, bins)) & (g < bins - 1), g + 1)
        .otherwise(g)
    )
    return spread.withColumn("_g", guess).groupBy(exact.cast("int").alias("bin")).agg(F.sum("_w").alias("n"))


def _listed(counts: DataFrame, span: Column, bins: int) -> DataFrame:
    """Every bin with its edges and its part of ``counts`` (``bin, n``)."""
    frame = counts.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"), span.alias("_s"))
    frame = frame.select("bin", F.col("_s.lo").alias("_lo"), F.col("_s.hi").alias("_hi"))
    lo, hi = F.col("_lo"), F.col("_hi")
    frame = frame.select(
        "bin", _edge(F.col("bin"), lo, hi, bins).alias("left"), _edge(F.col("bin") + 1, lo, hi, bins).alias("right")
    )
    return frame.join(counts, "bin", "left").select("bin", "left", "right", F.coalesce(F.col("n"), F.lit(0)).alias("n"))


def ratio_histogram(df: DataFrame, num: str, den: str, bins: int = 400, key: str | None = None) -> DataFrame:
    """Histogram of ``num / den`` over rows with a positive denominator.

    With ``key`` the two columns are aligned by key instead of by row: every
    numerator of a key counts with every denominator of it.  Pairs are listed
    only for keys of at most ``bins`` different numerators; of the others the
    pairs below each edge are counted from ordered runs (see :func:`_swept`), so
    that the work is bounded by the rows times the bins whatever a key holds.
    """
    positive = df.where(F.col(den) > 0)
    if key is None:
        pairs = positive.select(ratio(F.col(num), F.col(den)).alias("ratio"), F.lit(1).alias("n"))
        return histogram(pairs, "ratio", bins, weight="n")

    def distinct(rows: DataFrame, column: str) -> DataFrame:
        """``_key, _v, _n``: the different values of every key, with their rows."""
        values = rows.select(F.col(key).alias("_key"), F.col(column).cast("double").alias("_v"))
        values = values.where(F.col("_key").isNotNull() & F.col("_v").isNotNull() & ~F.isnan("_v"))
        return values.groupBy("_key", "_v").agg(F.count(F.lit(1)).alias("_n"))

    tops, bottoms = settle(distinct(df, num)), settle(distinct(positive, den))

    def ends(rows: DataFrame, side: str) -> DataFrame:
        return rows.groupBy("_key").agg(
            F.min("_v").alias(f"{side}lo"), F.max("_v").alias(f"{side}hi"),
            F.count(F.lit(1)).alias(f"{side}values"), F.sum("_n").alias(f"{side}rows"),
        )

    keys = settle(ends(tops, "t").join(ends(bottoms, "b"), "_key"))
    # Division by a positive number keeps the order, so a key's extremes are quotients of its extremes.
    lowest = ratio(F.col("tlo"), F.when(F.col("tlo") < 0, F.col("blo")).otherwise(F.col("bhi")))
    highest = ratio(F.col("thi"), F.when(F.col("thi") < 0, F.col("bhi")).otherwise(F.col("blo")))
    span = keys.agg(_span(F.min(lowest), F.max(highest))).scalar()

    crowded = F.col("tvalues") > bins
    listed = tops.join(keys.where(~crowded).select("_key"), "_key").select("_key", F.col("_v").alias("_num"), F.col("_n").alias("_a"))
    listed = listed.join(bottoms, "_key").select(ratio(F.col("_num"), F.col("_v")).alias("_v"), (F.col("_a") * F.col("_n")).alias("_w"))
    many = keys.where(crowded).select("_key", F.col("trows") * F.col("brows"))
    total = many.toDF("_key", "_pairs").agg(F.coalesce(F.sum("_pairs"), F.lit(0)).alias("_below")).select(F.lit(bins).alias("_edge"), "_below")
    below = _swept(tops.join(many.select("_key"), "_key"), bottoms.join(many.select("_key"), "_key"), span, bins)
    below = below.union(total).union(df.sparkSession.range(1).select(F.lit(0).alias("_edge"), F.lit(0).cast("long").alias("_below")))
    # Pairs below an edge are in the bin before it, pairs below the edge before that are not.
    steps = below.select(F.explode(F.array(
        F.struct((F.col("_edge") - 1).alias("bin"), F.col("_below").alias("n")),
        F.struct(F.col("_edge").alias("bin"), (-F.col("_below")).alias("n")),
    )).alias("_s")).select("_s.*").where(F.col("bin").between(0, bins - 1))
    counts = _placed(listed, span, bins).union(steps).groupBy("bin").agg(F.sum("n").alias("n"))
    return _listed(counts, span, bins)


def _swept(tops: DataFrame, bottoms: DataFrame, span: Column, bins: int) -> DataFrame:
    """``_edge, _below``: pairs of a key's numerators and denominators whose ratio is below each inner edge.

    For a denominator and an edge, these are the numerators below one threshold.  Numerators
    and thresholds are ordered together in ranges, of which a key may take many; each range
    counts for itself, and the numerators of the ranges before it are added once per key.
    """
    spread = bottoms.select("_key", F.col("_v").alias("_den"), F.col("_n").alias("_w"), span.alias("_s"))
    spread = spread.withColumn("_edge", F.explode(F.sequence(F.lit(1), F.lit(bins - 1))) if bins > 1 else F.lit(0)).where("_edge > 0")
    edge = _edge(F.col("_edge"), F.col("_s.lo"), F.col("_s.hi"), bins)
    # The least number whose quotient is not below the edge is the product or a neighbour of it.
    near = [F.col("_at") * F.lit(1.0 + step * 2.0**-52) for step in range(-4, 5)]
    least = F.least(*[F.when(ratio(c, F.col("_den")) >= F.col("_at_edge"), c) for c in near])
    thresholds = spread.withColumn("_at_edge", edge).withColumn("_at", F.col("_at_edge") * F.col("_den"))
    thresholds = thresholds.select("_key", least.alias("_v"), "_w", "_edge")
    runs = tops.select("_key", "_v", F.col("_n").alias("_w"), F.lit(0).alias("_edge")).union(thresholds)
    # Written down, so that a range keeps its number.
    runs = settle(runs.repartitionByRange("_key", "_v").withColumn("_range", F.spark_partition_id()))

    value = F.when(F.col("_edge") == 0, F.col("_w")).otherwise(0)
    inside = Window.partitionBy("_range", "_key").orderBy(F.col("_v"), F.desc("_edge")).rowsBetween(Window.unboundedPreceding, 0)
    local = runs.withColumn("_run", F.sum(value).over(inside)).where("_edge > 0")
    local = local.groupBy("_range", "_key", "_edge").agg(F.sum(F.col("_w") * F.col("_run")).alias("_pairs"), F.sum("_w").alias("_w"))
    before = Window.partitionBy("_key").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = runs.groupBy("_range", "_key").agg(F.sum(value).alias("_sum"))
    sums = sums.select("_range", "_key", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_ahead"))
    whole = local.join(sums, ["_range", "_key"])
    return whole.groupBy("_edge").agg(F.sum(F.col("_pairs") + F.col("_w") * F.col("_ahead")).alias("_below"))


def density_grid(
    df: DataFrame, x: str, y: str, nx: int, ny: int, xlim: tuple[float, float], ylim: tuple[float, float]
) -> DataFrame:
    """Points per cell of an ``nx`` by ``ny`` grid over the limits; points outside drop out."""

    def cell(c: str, n: int, lo: float, hi: float) -> Column:
        at = F.floor((F.col(c).cast("double") - lo) * n / (hi - lo))
        return F.least(at, F.lit(n - 1)).cast("int")

    inside = F.col(x).between(*xlim) & F.col(y).between(*ylim)
    cells = df.where(inside).select(cell(x, nx, *xlim).alias("ix"), cell(y, ny, *ylim).alias("iy"))
    return cells.groupBy("ix", "iy").agg(F.count(F.lit(1)).alias("n"))


def box_stats(df: DataFrame, value: str, by: str, approx: bool = False) -> DataFrame:
    """Box-plot numbers of ``value`` per category: quartiles, whiskers, outlier count.

    Whiskers reach the last data point within 1.5 interquartile ranges of the
    box.  Rows with a missing value or category take no part.
    """
    clean = df.select(F.col(by).alias("category"), F.col(value).cast("double").alias("_v"))
    clean = clean.where(F.col("category").isNotNull() & F.col("_v").isNotNull() & ~F.isnan("_v"))
    quantiles = approx_quantiles if approx else exact_quantiles
    box = quantiles(clean, "_v", ["category"], [0.25, 0.5, 0.75]).select(
        "category", F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3")
    )
    reach = (F.col("q3") - F.col("q1")) * WHISKER
    low, high = F.col("q1") - reach, F.col("q3") + reach
    inside = F.col("_v").between(low, high)
    return (
        join_groups(clean, box, ["category"])
        .groupBy("category", "q1", "median", "q3")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min(F.when(inside, F.col("_v"))).alias("_low"),
            F.max(F.when(inside, F.col("_v"))).alias("_high"),
            F.count_if(~inside).alias("outliers"),
        )
        .select(
            "category", "n", "q1", "median", "q3",
            F.least("_low", "q1").alias("whisker_low"),
            F.greatest("_high", "q3").alias("whisker_high"),
            "outliers",
        )
    )
