"""Finding keys that hold too large a share of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genopile.storage import materialize

# A key is hot when it holds more than one part in this many of the total weight.  So there
# are fewer hot keys than this, whatever the data: the list may always be broadcast.
SHARES = 4096

# A key lighter than this is never hot; one task handles it whatever its share.
LIGHT = 1 << 22


def stored_loads(df: DataFrame, keys: list[str], weight: Column) -> tuple[DataFrame, int]:
    """``load``, the summed weight of each key, stored, and the total over all keys.

    The rows are read once; loads are pre-aggregated on the map side.
    """
    loads = materialize(df.groupBy(*keys).agg(F.sum(weight).alias("load")), "loads")
    return loads, loads.agg(F.coalesce(F.sum("load"), F.lit(0).cast("bigint"))).first()[0]


def above_share(loads: DataFrame, total: int, shares: int = SHARES, light: int = LIGHT) -> DataFrame:
    """Keys above ``1 / shares`` of the summed weight, with their ``load``; fewer than ``shares`` rows."""
    return loads.filter((F.col("load") * shares > total) & (F.col("load") > light))
