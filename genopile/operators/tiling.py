"""Equal-count genome segments with overlap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genopile.config import HALO
from genopile.operators.prefix import exclusive_prefix


# Up to so many segments it is quicker to compare with every bound.
_FEW = 32


def equal_bounds(rows: DataFrame, n_segments: int) -> DataFrame:
    """Positions that close a segment of equal record count, ``(bound)``.

    A bound is the position of every ``count / n_segments``-th record in genome order.  Only
    a histogram of positions is formed; its running sum is kept distributed.  At most about
    twice ``n_segments`` rows come back, whatever the data.  Rows without a position on the axis
    count for nothing.
    """
    histogram = rows.filter(F.col("cum_pos").isNotNull()).groupBy("cum_pos").agg(F.count(F.lit(1)).alias("n"))
    running = exclusive_prefix(histogram, "cum_pos", [], {"n": "before"})
    total = histogram.agg(F.sum("n")).scalar()
    step = F.greatest(F.lit(1).cast("bigint"), F.floor(total / n_segments).cast("bigint"))
    closed = F.floor((F.col("before") + F.col("n")) / step) > F.floor(F.col("before") / step)
    return running.filter(closed).select(F.col("cum_pos").alias("bound"))


def segments(bounds: DataFrame, halo: int = HALO) -> DataFrame:
    """``(seg, lo, hi)``: records with ``lo < cum_pos <= hi``; the last one is open.

    The bound list is small by construction (see :func:`equal_bounds`), so it is numbered
    as one sorted array.
    """
    listed = bounds.agg(F.array_sort(F.collect_list("bound")).alias("bs"))
    numbered = listed.select("bs", F.explode(F.sequence(F.lit(0), F.size("bs"))).alias("seg"))
    lo = F.when(F.col("seg") > 0, F.get("bs", F.col("seg") - 1) - halo)
    return numbered.select(F.col("seg").cast("bigint").alias("seg"), lo.alias("lo"), F.get("bs", F.col("seg")).alias("hi"))


def _below(bounds: Column, x: Column, n_segments: int) -> Column:
    """How many sorted bounds are smaller than ``x``: counted where they are few, else by halving the range."""
    if n_segments <= _FEW:
        return F.size(F.filter(bounds, lambda b: b < x)).cast("bigint")
    steps = F.sequence(F.lit(1), F.lit(max(1, (4 * n_segments).bit_length())))
    start = F.struct(F.lit(0).alias("lo"), F.size(bounds).alias("hi"))

    def halve(s: Column, _: Column) -> Column:
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        smaller = F.coalesce(F.get(bounds, mid) < x, F.lit(False)) & (s["lo"] < s["hi"])
        return F.struct(
            F.when(smaller, mid + 1).otherwise(s["lo"]).alias("lo"),
            F.when(smaller | (s["lo"] >= s["hi"]), s["hi"]).otherwise(mid).alias("hi"),
        )

    return F.aggregate(steps, start, halve, lambda s: s["lo"].cast("bigint"))


def _bound_array(bounds: DataFrame) -> Column:
    return bounds.agg(F.array_sort(F.collect_list("bound"))).scalar()


def assign_segment(rows: DataFrame, bounds: DataFrame, n_segments: int) -> DataFrame:
    """Segment of each record without overlap: the first whose bound is not below it.

    Records without a position on the axis have no segment.

    The bounds reach every task as one small array; no join and no shuffle.
    """
    with_bounds = rows.withColumn("_bs", _bound_array(bounds))
    seg = _below(F.col("_bs"), F.col("cum_pos"), n_segments)
    return with_bounds.withColumn("seg", F.when(F.col("cum_pos").isNotNull(), seg)).drop("_bs")


def approximate_bounds(rows: DataFrame, n_segments: int, accuracy: int = 10_000) -> DataFrame:
    """Like :func:`equal_bounds`, ``(cut, bound)`` from quantile sketches that tasks make and merge.

    The rank of a bound is off by at most ``count / accuracy``; ``cut`` counts from 1.  One pass, and
    one row per task is shuffled whatever the number of positions.
    """
    shares = F.array(*(F.lit(i / n_segments) for i in range(1, n_segments)))
    listed = rows.agg(F.percentile_approx("cum_pos", shares, accuracy).alias("bounds"))
    each = listed.select(F.posexplode("bounds").alias("i", "bound"))
    return each.select((F.col("i") + 1).cast("bigint").alias("cut"), "bound")


def spanned_segments(rows: DataFrame, bounds: DataFrame, n_segments: int, end: Column) -> DataFrame:
    """A copy of each record in every segment that it touches from ``cum_pos`` to ``end``.

    Records without a position on the axis have no segment.
    """
    with_bounds = rows.withColumn("_bs", _bound_array(bounds))
    first = _below(F.col("_bs"), F.col("cum_pos"), n_segments)
    last = _below(F.col("_bs"), end, n_segments)
    segs = F.when(F.col("cum_pos").isNotNull(), F.sequence(first, F.greatest(first, last)))
    return with_bounds.withColumn("seg", F.explode_outer(segs)).drop("_bs")


def halo_segments(rows: DataFrame, bounds: DataFrame, n_segments: int, halo: int = HALO) -> DataFrame:
    """Like :func:`assign_segment`, with a copy in each segment whose overlap holds the record."""
    with_bounds = rows.withColumn("_bs", _bound_array(bounds))
    first = _below(F.col("_bs"), F.col("cum_pos"), n_segments)
    last = _below(F.col("_bs"), F.col("cum_pos") + halo, n_segments)
    segs = F.when(F.col("cum_pos").isNotNull(), F.sequence(first, last))
    return with_bounds.withColumn("seg", F.explode_outer(segs)).drop("_bs")
