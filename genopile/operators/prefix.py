"""Running sums over a total order without moving a table into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def exclusive_prefix(
    df: DataFrame,
    key: str,
    within: list[str],
    sums: dict[str, str],
    shifts: tuple[int, ...] = (16, 32),
) -> DataFrame:
    """Add, per ``{column: name}`` of ``sums``, the sum over all rows before this one.

    Rows are ordered by ``key`` (a whole number from 0 up to 2**48), then by ``within``.
    The key range is cut into buckets of ``2**shift`` values.  A window runs inside each
    bucket; bucket totals, a far smaller table, get the same treatment one level up.  The
    last level has at most ``2**16`` rows.
    """
    return _level(df, key, within, sums, shifts, 0)


def _level(df, key, within, sums, shifts, depth):
    order = [F.col(key), *(F.col(c) for c in within)]
    bucket = f"_bucket{depth}"
    last = depth == len(shifts)
    if last:
        df = df.withColumn(bucket, F.lit(0))
    else:
        step = shifts[depth] - (shifts[depth - 1] if depth else 0)
        df = df.withColumn(bucket, F.shiftright(F.col(key), step))
    before = Window.partitionBy(bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    inside = df.withColumns(
        {name: F.coalesce(F.sum(c).over(before), zero) for c, name in sums.items()}
    )
    if last:
        return inside.drop(bucket)
    totals = df.groupBy(bucket).agg(*(F.sum(c).alias(c) for c in sums))
    base = {name: f"_base{depth}_{name}" for name in sums.values()}
    above = _level(totals, bucket, [], {c: base[n] for c, n in sums.items()}, shifts, depth + 1)
    joined = inside.join(above.select(bucket, *base.values()), bucket)
    return joined.withColumns({n: F.col(n) + F.col(b) for n, b in base.items()}).drop(
        bucket, *base.values()
    )
