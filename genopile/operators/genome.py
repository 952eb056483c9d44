"""Contig dictionary, the cumulative axis and the tiled reference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genopile.config import TILE
from genopile.functions.dna import chrom_number
from genopile.operators.prefix import exclusive_prefix

_LAST = 1 << 48


def tile_of(pos: Column, tile: int = TILE) -> Column:
    """Number of the reference tile that holds a one-based position."""
    return F.floor((pos - 1) / tile).cast("bigint")


def tile_reference(contigs: DataFrame, tile: int = TILE) -> DataFrame:
    """``(chrom, tile, seq)`` from whole contigs ``(chrom, seq)``.

    The regular expression cuts a contig in one pass; ``substr`` per tile would scan from
    the start of the contig each time.
    """
    pieces = F.regexp_extract_all("seq", F.lit("(?s).{1,%d}" % tile), F.lit(0))
    return contigs.select("chrom", F.posexplode(pieces).alias("tile", "seq")).select(
        "chrom", F.col("tile").cast("bigint").alias("tile"), "seq"
    )


def contig_lengths(tiles: DataFrame) -> DataFrame:
    return tiles.groupBy("chrom").agg(F.sum(F.length("seq")).cast("bigint").alias("len"))


def contig_dictionary(lengths: DataFrame) -> DataFrame:
    """Add ``chrom_ord`` (from 1) and ``offset`` to ``(chrom, len)``.

    Contigs are ordered by the first number in their name, of up to 38 digits, then by name; names
    without a number come last.
    """
    digits = F.regexp_extract("chrom", r"\d+", 0).try_cast("decimal(38,0)")
    number = F.coalesce(F.least(chrom_number(F.col("chrom")), F.lit(_LAST - 1)), F.lit(_LAST - 1))
    keyed = lengths.withColumns(
        {
            "_num": number,
            "_nameless": digits.isNull().cast("int"),
            # Numbers beyond the running sum's range share its last value and are ordered here.
            "_digits": digits,
            "_one": F.lit(1).cast("bigint"),
        }
    )
    ordered = exclusive_prefix(
        keyed, "_num", ["_nameless", "_digits", "chrom"], {"_one": "_before", "len": "offset"}
    )
    return ordered.select("chrom", (F.col("_before") + 1).alias("chrom_ord"), "len", "offset")


def key_by_pos(reads: DataFrame) -> DataFrame:
    """Coordinate key of each alignment; the full contig name is kept."""
    return reads.withColumn("chrom_num", chrom_number(F.col("rname")))


def with_cum_pos(rows: DataFrame, contigs: DataFrame, chrom: str = "rname") -> DataFrame:
    """Position on one axis over all contigs.

    Rows of a contig that the dictionary lacks stay, without an order and a position.  No broadcast is forced: the planner broadcasts the dictionary when its measured size is
    below the session's limit, and otherwise sorts and splits hot contigs.
    """
    lookup = contigs.select(F.col("chrom").alias(chrom), "chrom_ord", "offset")
    return rows.join(lookup, chrom, "left").withColumn("cum_pos", F.col("offset") + F.col("pos"))


def genome_sort(rows: DataFrame) -> DataFrame:
    """Genome order; sample and read name break ties, so a deep position can be split.

    Rows of unknown contigs come last, by contig name.
    """
    ties = [c for c in ("rname", "sample", "qname") if c in rows.columns]
    first, *rest = (["rname", "pos", *ties[1:]] if "rname" in ties else ["pos", *ties])
    return rows.orderBy(F.col("chrom_ord").asc_nulls_last(), first, *rest)


def ref_bases(positions: DataFrame, tiles: DataFrame, tile: int = TILE) -> DataFrame:
    """Reference base at each ``(chrom, pos)``; ``N`` where the reference has none."""
    keyed = positions.withColumn("tile", tile_of(F.col("pos"), tile))
    joined = keyed.join(tiles, ["chrom", "tile"], "left")
    base = F.substr("seq", (F.col("pos") - F.col("tile") * tile).cast("int"), F.lit(1))
    known = F.coalesce(F.nullif(base, F.lit("")), F.lit("N"))
    return joined.withColumn("ref", known).drop("seq", "tile")
