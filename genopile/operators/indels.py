"""Indel counts per position and sample, in long form and as per-sample summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genopile.config import TILE, PileupOptions
from genopile.functions.pileup_text import indel_marks
from genopile.operators.genome import tile_of
from genopile.operators.pileup import read_blocks
from genopile.operators.reads import usable
from genopile.storage import materialize


def pileup_indels(
    reads: DataFrame,
    tiles: DataFrame,
    options: PileupOptions = PileupOptions(),
    by: tuple[str, ...] = (),
    tile: int = TILE,
    positions: DataFrame | None = None,
) -> DataFrame:
    """``(chrom, tile, pos, sample, indel, n)`` from CIGARs; with ``positions`` only at those.

    An event belongs to the base before it; one at the start of a read has no such base and
    is left out.  Events are counted first, deletions by length, and stored, so the reads are
    gone through once; only then is the deleted sequence looked up, once per distinct event.
    """
    keep = ["sample", *by]
    indel_reads = usable(reads, options).filter(F.col("cigar").rlike("[ID]"))
    blocks = read_blocks(indel_reads, keep).filter(
        F.col("b.op").isin("I", "D") & F.col("b.prev").isin("M", "=", "X", "D")
    )
    at = F.col("b.read_off") + F.when(F.col("b.prev") == "D", 1).otherwise(0)
    good = F.ascii(F.substr("qual", at, F.lit(1))) - 33 >= options.min_base_qual
    inserted = F.concat(F.lit("+"), F.upper(F.substr("seq", F.col("b.read_off") + 1, F.col("b.len"))))
    keys = ["chrom", "tile", "pos", *keep]
    pos = F.col("read_pos") + F.col("b.ref_off") - 1
    events = (
        blocks.filter(good)
        .select(
            *keep,
            "chrom",
            pos.alias("pos"),
            tile_of(pos, tile).alias("tile"),
            F.when(F.col("b.op") == "I", inserted).alias("ins"),
            F.when(F.col("b.op") == "D", F.col("b.len")).alias("gap"),
        )
        .groupBy(*keys, "ins", "gap")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    if positions is not None:
        listed = positions.select("chrom", "pos").withColumn("tile", tile_of(F.col("pos"), tile))
        events = events.join(listed, ["chrom", "tile", "pos"], "left_semi")
    events = materialize(events, "indel-events")
    insertions = events.filter(F.col("ins").isNotNull()).select(*keys, F.col("ins").alias("indel"), "n")
    gaps = events.filter(F.col("gap").isNotNull())
    sequences = deleted_sequences(gaps.select("chrom", "pos", "gap").distinct(), tiles, tile)
    deletions = gaps.join(sequences, ["chrom", "pos", "gap"]).select(*keys, "indel", "n")
    return insertions.unionByName(deletions)


def deleted_sequences(gaps: DataFrame, tiles: DataFrame, tile: int = TILE) -> DataFrame:
    """Reference text of deletions ``(chrom, pos, gap)`` that follow ``pos``, as ``-SEQ``.

    Bases that the reference lacks are ``N``.
    """
    first, last = F.col("pos") + 1, F.col("pos") + F.col("gap")
    parts = gaps.withColumn("tile", F.explode(F.sequence(tile_of(first, tile), tile_of(last, tile))))
    lo = F.greatest(first - F.col("tile") * tile, F.lit(1))
    hi = F.least(last - F.col("tile") * tile, F.lit(tile))
    size = (hi - lo + 1).cast("int")
    cut = F.rpad(F.coalesce(F.substr("seq", lo.cast("int"), size), F.lit("")), size, F.lit("N"))
    joined = parts.join(tiles, ["chrom", "tile"], "left").withColumn("part", F.struct("tile", cut.alias("text")))
    # One group is one deletion: its parts are as many as the tiles it spans.
    whole = joined.groupBy("chrom", "pos", "gap").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    text = F.array_join(F.transform("parts", lambda p: p["text"]), "")
    return whole.select("chrom", "pos", "gap", F.concat(F.lit("-"), F.upper(text)).alias("indel"))


def text_indels(rows: DataFrame) -> DataFrame:
    """``(chrom, pos, sample, indel, n)`` from pileup text."""
    marks = rows.filter(F.col("depth") > 0).select(
        "chrom", "pos", "sample", F.explode(indel_marks(F.col("bases"))).alias("indel")
    )
    return marks.groupBy("chrom", "pos", "sample", "indel").agg(F.count(F.lit(1)).alias("n"))


def indel_summary(indels: DataFrame) -> DataFrame:
    """One row per position and sample.

    ``indels`` is the whole table of distinct indels, most frequent first.  It is built from
    counts, so an entry is a distinct sequence, not a read.
    """
    keys = [c for c in indels.columns if c not in ("indel", "n")]
    entry = F.struct("n", "indel")
    deleted = F.col("indel").startswith("-")
    size = F.length("indel") - 1
    longest = F.max(F.when(deleted, F.struct(size.alias("size"), "n", F.expr("substr(indel, 2)").alias("seq"))))
    return indels.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_indels"),
        F.sum("n").alias("indel_total"),
        F.max(entry)["indel"].alias("top_indel"),
        F.count_if(deleted).alias("n_dels"),
        longest["seq"].alias("longest_del"),
        F.sort_array(F.collect_list(entry), asc=False).alias("indels"),
    )


def attach_indels(calls: DataFrame, summary: DataFrame) -> DataFrame:
    """Add the indel columns to per-sample rows; zero where there is none."""
    own = {"n_indels", "indel_total", "top_indel", "n_dels", "longest_del", "indels"}
    keys = [c for c in summary.columns if c not in own and c in calls.columns]
    joined = calls.join(summary, keys, "left")
    return joined.withColumns(
        {c: F.coalesce(F.col(c), F.lit(0).cast("bigint")) for c in ("n_indels", "indel_total", "n_dels")}
    )
