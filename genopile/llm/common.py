"""Small helpers that the corpus operators share.

Every operator carries an input row as one struct column, so that extra columns of the caller
never meet the columns it makes itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Space, tab, line feed, vertical tab, form feed, carriage return.
BLANK = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(df: DataFrame, name: str = "doc") -> Column:
    """The input row as one struct."""
    return F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias(name)


def words(text: Column) -> Column:
    """Maximal runs of characters other than the six blanks of ``BLANK``; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANK), "")


def dense_index(
    df: DataFrame, keys: list[str], order: Column, name: str, buckets: int
) -> DataFrame:
    """Number the rows of every key from 0 without gaps, in ``order`` (a whole number, any sign).

    ``order`` should be a hash that is unique or nearly so: its remainder deals a key's rows
    to ``buckets`` groups that are numbered apart, so a hot key is never sorted in one task.
    Bucket sizes are summed map-side; their running sums involve ``buckets`` rows a key.
    """
    rows = df.withColumns({"_order": order}).withColumn(
        "_bucket", F.pmod(F.col("_order"), F.lit(buckets)).cast("int")
    )
    sizes = rows.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    before = (
        Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = sizes.select(
        *keys,
        "_bucket",
        F.coalesce(F.sum("_size").over(before), F.lit(0)).cast("bigint").alias("_start"),
    )
    inside = Window.partitionBy(*keys, "_bucket").orderBy("_order")
    numbered = rows.withColumn("_place", F.row_number().over(inside))
    return (
        numbered.join(starts, [*keys, "_bucket"])
        .withColumn(name, F.col("_start") + F.col("_place") - 1)
        .drop("_bucket", "_order", "_start", "_place")
    )


def of_lowest(df: DataFrame, number: Column, n: int) -> DataFrame:
    """Rows among which are those of the ``n`` lowest ``number`` (a 64-bit hash), and few more.

    A task that sorts rows sends up to ``n`` of them; below a threshold set by the number of all
    rows, little more than ``n`` are left in all tasks together.  Where hashes are so uneven that
    fewer are left, all rows are returned.
    """
    share = (1.2 * n + 1000) / max(1, df.count())
    if share >= 1:
        return df
    few = df.filter(number < F.lit(int(share * 2**64) - 2**63))
    return few if few.count() >= n else df
