"""Filters and projections on reads and alignments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genopile.config import PileupOptions
from genopile.functions.cigar import ref_span
from genopile.operators.genome import tile_of


def tab5(pairs: DataFrame) -> DataFrame:
    """One tab-separated line per read pair."""
    return pairs.select("sample", F.concat_ws("\t", "header", "seq1", "qual1", "seq2", "qual2").alias("line"))


def fastq_records(pairs: DataFrame) -> DataFrame:
    """Four-line FASTQ records; mates are told apart by a name suffix, single ends have none."""
    paired = F.col("seq2") != ""

    def record(seq: str, qual: str, suffix: Column) -> Column:
        name = F.concat(F.lit("@"), F.col("header"), suffix)
        return F.concat_ws("\n", name, F.col(seq), F.lit("+"), F.col(qual))

    first = record("seq1", "qual1", F.when(paired, "_1").otherwise(""))
    second = F.when(paired, record("seq2", "qual2", F.lit("_2")))
    return pairs.select("sample", F.explode(F.array_compact(F.array(first, second))).alias("record"))


def aligned_only(reads: DataFrame) -> DataFrame:
    unmapped = F.col("flag").bitwiseAND(F.lit(4)) != 0
    return reads.filter((F.col("rname") != "*") & ~unmapped)


def min_mapq(reads: DataFrame, mapq: int = 30) -> DataFrame:
    return reads.filter(F.col("mapq") >= mapq)


def usable(reads: DataFrame, options: PileupOptions) -> DataFrame:
    """Reads that may enter a pileup; plain column predicates, so they reach the scan."""
    flag = F.col("flag")
    kept = min_mapq(aligned_only(reads), options.min_mapq).filter(
        flag.bitwiseAND(F.lit(options.skip_flags)) == 0
    )
    if options.count_orphans:
        return kept
    orphan = (flag.bitwiseAND(F.lit(1)) != 0) & (flag.bitwiseAND(F.lit(2)) == 0)
    return kept.filter(~orphan)


def region_reads(reads: DataFrame, chrom: str, lo: int, hi: int, start: int | None = None) -> DataFrame:
    """Reads whose span meets a region; bounds of their starts are pushed to the scan.

    ``start``, from the bin index, is a position before which none of them starts.
    """
    end = F.col("pos") + ref_span(F.col("cigar")) - 1
    near = reads.filter((F.col("rname") == chrom) & (F.col("pos") <= hi))
    if start is not None:
        near = near.filter(F.col("pos") >= start)
    return near.filter(end >= lo)


def region_sites(sites: DataFrame, chrom: str, lo: int, hi: int) -> DataFrame:
    return sites.filter((F.col("chrom") == chrom) & F.col("pos").between(lo, hi))


def at_positions(sites: DataFrame, positions: DataFrame) -> DataFrame:
    """Sites named in a position list; sites with a tile column join on it as well."""
    keys = [c for c in ("chrom", "tile", "pos") if c in sites.columns]
    wanted = positions.select("chrom", "pos")
    if "tile" in keys:
        wanted = wanted.withColumn("tile", tile_of(F.col("pos")))
    return sites.join(wanted, keys, "left_semi")
