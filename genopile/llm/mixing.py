"""Mixing sources to target weights by temperature, realised as budgeted block permutations.

Source weights are token shares raised to an exponent between 0 (equal) and 1 (as found) and
normalised.  The exponent is bisected until the weights reach a target entropy or until the
source that is repeated most reaches a repetition limit.  The budget is the least with which
every document is used at least once, so mixing repeats documents and never drops any.  Every
source's draws are permuted by a seeded hash and cut into blocks of the budget, each block with
the source's weight of tokens; the order within a block is a hash as well.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from genopile.llm.common import table, whole, words
from genopile.storage import materialize


@dataclass(frozen=True)
class Mixing:
    # The most often a source may be gone through; used where no entropy is asked for.
    max_epochs: float = 2.0
    # Entropy of the weights as a share of the logarithm of the number of sources.
    target_entropy: float | None = None
    # Tokens of one block, all sources together.
    block_tokens: int = 1 << 22
    seed: int = 17
    # Rows that one group numbers when token sums run along a permutation.
    group_rows: int = 1 << 17


def bisect_exponent(logs: DataFrame, options: Mixing, steps: int = 50) -> float:
    """The least exponent that keeps the limit, or the largest that reaches the entropy.

    ``logs`` has one row a source with ``l``, the logarithm of its share of the largest source.
    The repetition limit has a closed form in the smallest ``l``.  Entropy falls as the exponent
    rises; bisection evaluates it by one aggregate a step, and only sums come to the driver.
    """
    if options.target_entropy is None:
        least = logs.agg(F.min("l")).first()[0]

        def holds(a: float) -> bool:  # epochs of the rarest source
            return least is None or (a - 1) * least <= math.log(max(1.0, options.max_epochs))

        low, high = 0.0, 1.0
        if holds(low):
            return low
        for _ in range(steps):
            middle = (low + high) / 2
            low, high = (low, middle) if holds(middle) else (middle, high)
        return high

    def entropy(a: float) -> float:
        w = F.exp(F.lit(a) * F.col("l"))
        row = logs.agg(F.sum(w), F.sum(w * F.lit(a) * F.col("l")), F.count(F.lit(1))).first()
        if row[2] < 2:
            return 1.0
        return (math.log(row[0]) - row[1] / row[0]) / math.log(row[2])

    low, high = 0.0, 1.0
    if entropy(high) >= options.target_entropy:
        return high
    for _ in range(min(steps, 30)):
        middle = (low + high) / 2
        low, high = (middle, high) if entropy(middle) >= options.target_entropy else (low, middle)
    return low


def source_weights(sums: DataFrame, options: Mixing) -> DataFrame:
    """``source``, ``tokens``, ``weight``, ``epochs`` from ``source`` and ``tokens``.

    Sources of no tokens get weight 0 and one epoch.
    """
    real = sums.filter("tokens > 0")
    top = real.agg(F.max("tokens")).first()[0] or 1
    logs = materialize(
        real.select("source", "tokens", F.log(F.col("tokens") / F.lit(float(top))).alias("l")),
        "source-logs",
    )
    exponent = bisect_exponent(logs, options)
    raw = F.exp(F.lit(exponent) * F.col("l"))
    total = logs.agg(F.sum(raw)).first()[0] or 1.0
    weighted = logs.select(
        "source",
        "tokens",
        (raw / F.lit(total)).alias("weight"),
        F.exp(F.lit(exponent - 1) * F.col("l")).alias("epochs"),
    )
    empty = sums.filter("tokens = 0").select(
        "source", "tokens", F.lit(0.0).alias("weight"), F.lit(1.0).alias("epochs")
    )
    return weighted.unionByName(empty)


def tokens_before(rows: DataFrame, groups: int) -> DataFrame:
    """Add ``before``: tokens of a (source, epoch) ahead of each row in the order of ``order``.

    Hash ranges deal a permutation to ``groups`` groups, so a hot source is never summed in one
    task; group totals, ``groups`` rows a source and epoch, are summed one level up.
    """
    keys = ["source", "epoch"]
    # 63 bits of the hash, cut into equal ranges.
    group = F.floor(
        F.shiftrightunsigned("order", 1).cast("double") / F.lit(float(1 << 63)) * groups
    ).cast("int")
    rows = rows.withColumn("group", group)
    above = Window.partitionBy(*keys).orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    bases = (
        rows.groupBy(*keys, "group")
        .agg(F.sum("tokens").alias("sum"))
        .select(*keys, "group", F.coalesce(F.sum("sum").over(above), zero).alias("base"))
    )
    inside = (
        Window.partitionBy(*keys, "group")
        .orderBy(F.shiftrightunsigned("order", 1), "row")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    summed = rows.withColumn("inner", F.coalesce(F.sum("tokens").over(inside), zero))
    return summed.join(bases, [*keys, "group"]).withColumn(
        "before", F.col("base") + F.col("inner")
    ).drop("base", "inner", "group")


def mix(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    keep: list[str] | None = None,
    options: Mixing = Mixing(),
    tokens: Column | None = None,
) -> DataFrame:
    """One row per draw: ``doc`` (a struct of the columns ``keep``, all by default) and ``mix``
    (``tokens``, ``weight``, ``epochs``, ``epoch`` from 0, ``block``, ``place``).

    Sorting by ``(block, place)`` gives the training order.  Every input row is drawn once at
    least; a source of ``epochs`` 2.3 is drawn twice whole, and from its third permutation the
    rows that start within 0.3 of its tokens.  Null and empty texts have no tokens and are drawn
    once.  A null source is a source of its own.  Repeated rows are drawn each on its own; an
    empty table gives an empty result; extra columns ride along inside ``doc``.
    """
    kept_columns = docs.select(*(f"`{c}`" for c in keep)) if keep else docs
    size = F.size(words(F.col(f"`{text}`"))) if tokens is None else F.coalesce(tokens, F.lit(0))
    name = F.concat(F.lit("s:"), F.col(f"`{source}`").cast("string"))
    stored = materialize(
        docs.select(
            whole(kept_columns),
            F.coalesce(name, F.lit("null")).alias("source"),
            size.cast("bigint").alias("tokens"),
        ).withColumn("row", F.monotonically_increasing_id()),
        "mix-rows",
    )
    sums = stored.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("n"))
    sums = materialize(sums, "source-tokens")
    weights = materialize(source_weights(sums.select("source", "tokens"), options), "source-weights")
    groups = max(1, -(-(sums.agg(F.max("n")).first()[0] or 0) // options.group_rows))
    # The largest source is gone through once, which fixes the budget.
    budget = weights.agg(F.sum(F.col("tokens") * F.col("epochs"))).first()[0] or 0
    blocks = max(1, round(budget / options.block_tokens))

    slim = stored.select("row", "source", "tokens").join(
        weights.select("source", "weight", "epochs", F.col("tokens").alias("all")), "source"
    )
    last = F.greatest(F.lit(0), F.ceil(F.col("epochs") - 1e-9).cast("int") - 1)
    epochs = F.when(F.col("tokens") > 0, F.sequence(F.lit(0), last)).otherwise(F.array(F.lit(0)))
    rows = slim.withColumn("epoch", F.explode(epochs)).withColumn(
        "order", F.xxhash64(F.lit(options.seed), "epoch", "row")
    )
    placed = tokens_before(rows, groups)
    start = F.col("epoch") * F.col("all") + F.col("before")
    share = start / F.greatest(F.col("all") * F.col("epochs"), F.lit(1.0))
    drawn = placed.filter((F.col("epoch") == 0) | (start < F.col("all") * F.col("epochs"))).select(
        "row",
        F.struct(
            "tokens",
            "weight",
            "epochs",
            "epoch",
            F.least(F.lit(blocks - 1), F.floor(share * blocks)).cast("bigint").alias("block"),
            F.xxhash64(F.lit(options.seed + 1), "epoch", "row").alias("place"),
        ).alias("mix"),
    )
    return stored.select("row", "doc").join(drawn, "row").select("doc", "mix")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"), keep=["doc_id", "source"])
    return mixed.select("doc.doc_id", "doc.source", "mix.*")
