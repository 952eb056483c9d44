"""Reference sequence from FASTA."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from genopile.config import TILE
from genopile.sources.lines import stored_lines


def fasta_tiles(spark: SparkSession, paths: str | list[str], tile: int = TILE) -> DataFrame:
    """``(chrom, tile, seq)`` from FASTA, plain or gzipped.

    The file is read by lines, so a contig is never one value.  Within a split a window finds
    the header above each line and the bases since; totals per split carry both across
    splits.
    """
    lines = stored_lines(spark, paths if isinstance(paths, list) else [paths])
    head = F.col("value").startswith(">")
    name = F.when(head, F.regexp_extract("value", r"^>\s*(\S+)", 1))
    text = F.when(head, "").otherwise(F.regexp_replace("value", r"\s", ""))
    marked = lines.select("path", "block", "line_id", head.alias("head"), name.alias("name"), text.alias("text"))

    order = Window.partitionBy("path", "block").orderBy("line_id")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    above = F.last("name", ignorenulls=True).over(upto)
    section = F.count_if("head").over(upto)
    known = marked.withColumns({"above": above, "section": section})
    inside = Window.partitionBy("path", "block", "section").orderBy("line_id")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    known = known.withColumn("since", F.coalesce(F.sum(F.length("text")).over(before), F.lit(0)))

    # Per split: its last header and how many bases follow it (all bases where it has none).
    bases_in = F.max(F.col("since") + F.length("text"))
    tails = known.groupBy("path", "block", "section").agg(
        F.max("above").alias("above"), bases_in.alias("bases")
    )
    last = F.max(F.struct("section", "above", "bases"))
    splits = tails.groupBy("path", "block").agg(last.alias("last"))
    file_order = Window.partitionBy("path").orderBy("block")
    prior = file_order.rowsBetween(Window.unboundedPreceding, -1)
    carried = splits.withColumns(
        {
            "open": F.last(F.col("last.above"), ignorenulls=True).over(prior),
            "reset": F.count_if(F.col("last.above").isNotNull()).over(file_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        }
    )
    run = Window.partitionBy("path", "reset").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = carried.withColumn("upto", F.sum(F.col("last.bases")).over(run))
    carried = carried.withColumn("carry", F.coalesce(F.lag("upto").over(file_order), F.lit(0)))

    placed = known.join(carried.select("path", "block", "open", "carry"), ["path", "block"]).filter(
        ~F.col("head") & (F.col("text") != "")
    )
    orphan = F.col("section") == 0
    return _retile(
        placed.select(
            F.when(orphan, F.col("open")).otherwise(F.col("above")).alias("chrom"),
            (F.col("since") + F.when(orphan, F.col("carry")).otherwise(0)).alias("at"),
            "text",
        ).filter(F.col("chrom").isNotNull()),
        tile,
    )


def _retile(rows: DataFrame, tile: int) -> DataFrame:
    """Lines ``(chrom, at, text)`` to tiles; a long line is cut in one pass."""
    to_border = (tile - F.col("at") % tile).cast("int")
    head = F.left("text", to_border)
    rest = F.expr("substr(text, %d - int(at %% %d) + 1)" % (tile, tile))
    chunks = F.concat(F.array(head), F.regexp_extract_all(rest, F.lit(".{1,%d}" % tile), F.lit(0)))
    pieces = rows.select("chrom", "at", F.posexplode(chunks).alias("i", "piece"))
    number = F.floor(F.col("at") / tile) + F.col("i")
    order = F.when(F.col("i") == 0, F.col("at") % tile).otherwise(0)
    # One group is one tile, so it holds at most ``tile`` bases.
    tiles = pieces.groupBy("chrom", number.cast("bigint").alias("tile")).agg(
        F.array_sort(F.collect_list(F.struct(order.alias("o"), "piece"))).alias("parts")
    )
    return tiles.select("chrom", "tile", F.array_join(F.transform("parts", lambda p: p["piece"]), "").alias("seq"))
