"""Exact quantiles that never gather a group in one task.

A sketch brackets every wanted rank, and as long as a bracket holds more than a fixed
number of distinct values it is sketched and narrowed again.  Only then are its values
put in order, so what one task sorts does not grow with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hedonic.operators.skew import is_small, join_lookups
from hedonic.session import release, settle

SKETCH_ACCURACY = 10000
# Distinct values of a bracket that are put in order.
FINAL_VALUES = 20_000


def join_groups(df: DataFrame, groups: DataFrame, by: list[str]) -> DataFrame:
    """Join the settled rows of each group to the rows of ``df``.

    Groups are often few and one may be most of the data, so they are measured, and
    broadcast when few; many groups are looked up with hot ones split.
    """
    if is_small(groups):
        return df.join(F.broadcast(groups), by)
    return join_lookups(df, [groups], by, "inner")


def exact_quantiles(
    df: DataFrame,
    value: str,
    by: list[str],
    qs: list[float],
    accuracy: int = SKETCH_ACCURACY,
    final: int = FINAL_VALUES,
) -> DataFrame:
    """Linearly interpolated quantiles: one row per group with columns ``q0, q1, ...``.

    NULL and NaN values, and rows with a NULL group, are left out.  A rank outside its
    bracket, which the sketch's guarantee rules out, raises.
    """
    clean = df.select(*by, F.col(value).cast("double").alias("_v"))
    clean = clean.where(F.col("_v").isNotNull() & ~F.isnan("_v")).dropna(subset=by)
    brackets = settle(_first_brackets(clean, by, qs, accuracy))
    while True:
        counts = settle(_counts(clean, brackets, by))
        inside = counts.where(F.col("_v").isNotNull()).groupBy(*by, "_i").agg(F.count(F.lit(1)).alias("_values"))
        if (inside.agg(F.max("_values")).head()[0] or 0) <= final:
            break
        narrower = settle(_narrowed(counts, brackets, by, accuracy))
        release(counts)
        brackets = narrower

    running = Window.partitionBy(*by, "_i").orderBy(F.col("_v").asc_nulls_first())
    upto = F.sum("_c").over(running.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = counts.withColumn("_end", upto).withColumn("_start", F.col("_end") - F.col("_c"))

    def at(rank: Column) -> Column:
        hit = (F.col("_start") <= rank) & (rank < F.col("_end")) & F.col("_v").isNotNull()
        found = F.max(F.when(hit, F.col("_v")))
        return F.when(found.isNull(), F.raise_error(F.lit("a rank is outside its bracket"))).otherwise(found)

    low, high = F.floor("_rank"), F.ceil("_rank")
    picked = ranked.groupBy(*by, "_i").agg(
        at(low).alias("_low"), at(high).alias("_high"), F.max(F.col("_rank") - low).alias("_frac")
    )
    picked = picked.withColumn("_q", F.col("_low") + F.col("_frac") * (F.col("_high") - F.col("_low")))
    return picked.groupBy(*by).agg(
        *[F.max(F.when(F.col("_i") == i, F.col("_q"))).alias(f"q{i}") for i in range(len(qs))]
    )


def _first_brackets(clean: DataFrame, by: list[str], qs: list[float], accuracy: int) -> DataFrame:
    """``_lo`` and ``_hi`` around each rank of each group."""
    margin = 4.0 / accuracy
    asked = [max(q - margin, 0.0) for q in qs] + [min(q + margin, 1.0) for q in qs]
    sketch = clean.groupBy(*by).agg(
        F.count("_v").alias("_n"),
        F.min("_v").alias("_min"),
        F.max("_v").alias("_max"),
        F.percentile_approx("_v", asked, accuracy).alias("_marks"),
    )
    # In a group smaller than the sketch a margin may fall between two ranks.
    small = F.col("_n") < accuracy
    brackets = []
    for i, q in enumerate(qs):
        lo = F.when(small | F.lit(q <= margin), F.col("_min")).otherwise(F.col("_marks")[i])
        hi = F.when(small | F.lit(q >= 1 - margin), F.col("_max")).otherwise(F.col("_marks")[len(qs) + i])
        rank = (F.col("_n") - 1) * F.lit(q)
        brackets.append(F.struct(F.lit(i).alias("_i"), lo.alias("_lo"), hi.alias("_hi"), rank.alias("_rank")))
    return sketch.select(*by, F.inline(F.array(*brackets)))


def _counts(clean: DataFrame, brackets: DataFrame, by: list[str]) -> DataFrame:
    """How often each value inside a bracket occurs, and (under NULL) how many values lie below it."""
    every = [F.struct("_i", "_lo", "_hi", "_rank").alias("_b")]
    wide = settle(brackets.groupBy(*by).agg(F.collect_list(every[0]).alias("_brackets")))
    rows = join_groups(clean, wide, by).select(*by, "_v", F.explode("_brackets").alias("_b")).where(F.col("_v") <= F.col("_b._hi"))
    inside = F.when(F.col("_v") >= F.col("_b._lo"), F.col("_v"))
    return rows.groupBy(*by, F.col("_b._i").alias("_i"), F.col("_b._rank").alias("_rank"), inside.alias("_v")).agg(
        F.count(F.lit(1)).alias("_c")
    )


def _narrowed(counts: DataFrame, brackets: DataFrame, by: list[str], accuracy: int) -> DataFrame:
    """Brackets between distinct values of the old ones that surely hold the rank.

    Distinct values are sketched into stretches; the counts of these, few as they are,
    say in which stretch the rank lies.
    """
    key = [*by, "_i"]
    known = counts.where(F.col("_v").isNotNull())
    stretches = 1000
    marks = known.groupBy(*key).agg(F.percentile_approx("_v", [k / stretches for k in range(1, stretches)], accuracy).alias("_marks"))
    below = counts.where(F.col("_v").isNull()).select(*key, F.col("_c").alias("_below"))
    marks = marks.join(below, key, "left")
    placed = join_groups(known, settle(marks), key)
    spot = F.size(F.filter("_marks", lambda m: m < F.col("_v")))
    sums = placed.groupBy(*key, "_rank", spot.alias("_spot")).agg(
        F.sum("_c").alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.first(F.coalesce("_below", F.lit(0))).alias("_below")
    )
    upto = Window.partitionBy(*key).orderBy("_spot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = sums.withColumn("_end", F.sum("_c").over(upto) + F.col("_below")).withColumn("_start", F.col("_end") - F.col("_c"))
    hit = ends.where((F.floor("_rank") < F.col("_end")) & (F.ceil("_rank") >= F.col("_start")))
    return hit.groupBy(*key, "_rank").agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"))


def approx_quantiles(
    df: DataFrame, value: str, by: list[str], qs: list[float], accuracy: int = SKETCH_ACCURACY
) -> DataFrame:
    """One-pass sketch version with the same output columns."""
    clean = df.select(*by, F.col(value).cast("double").alias("_v"))
    clean = clean.where(F.col("_v").isNotNull() & ~F.isnan("_v")).dropna(subset=by)
    marks = clean.groupBy(*by).agg(F.percentile_approx("_v", list(qs), accuracy).alias("_m"))
    return marks.select(*by, *[F.col("_m")[i].alias(f"q{i}") for i in range(len(qs))])


def median_where(df: DataFrame, col: str, cond) -> DataFrame:
    """Median of ``col`` over rows satisfying ``cond``, as one row ``median``.

    No qualifying row gives an empty result.
    """
    one = df.where(cond).select(F.lit(0).alias("_one"), F.col(col))
    return exact_quantiles(one, col, ["_one"], [0.5]).select(F.col("q0").alias("median"))
