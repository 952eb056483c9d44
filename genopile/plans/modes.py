"""The three ways to call variants, and the run from reads to a result table."""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genopile.config import Cutoffs, PileupOptions
from genopile.functions.alleles import with_alleles
from genopile.functions.cigar import ref_span
from genopile.operators import align, genome, tiling
from genopile.operators.calls import called_sites, matrix
from genopile.operators.genotype import (
    called_alternates,
    genotypes,
    joint_sites,
    site_genotypes,
    site_vcf_rows,
    with_quality,
)
from genopile.operators.indels import attach_indels, indel_summary, pileup_indels
from genopile.operators.pileup import pileup_counts
from genopile.operators.positions import snarp
from genopile.operators.reads import aligned_only, region_reads, region_sites
from genopile.sinks.alignments import bin_index, region_start, write_sorted
from genopile.sinks.variants import write_matrix, write_vcf
from genopile.sources.alignments import alignments, listed_alignments
from genopile.sources.reads import read_pairs
from genopile.sources.reference import fasta_tiles
from genopile.storage import materialize


def sample_calls(
    reads: DataFrame,
    tiles: DataFrame,
    options: PileupOptions = PileupOptions(),
    indels: bool = False,
    positions: DataFrame | None = None,
    by: tuple[str, ...] = (),
    differing: bool = False,
    samples: list[str] | None = None,
) -> DataFrame:
    """Alignments to per-sample rows ready for the calling expressions.

    With ``samples`` every site has a row for each of them, see :func:`pileup_counts`.

    With ``differing`` only sites that may be called are there: some read has another base than the
    reference or, with ``indels``, an indel.  These are stored, as they are read twice.
    """
    found = None
    if indels:
        found = indel_summary(pileup_indels(reads, tiles, options, by, positions=positions))
        found = materialize(found, "indels") if differing else found
    besides = found.select("chrom", "pos") if differing and indels else None
    counts = pileup_counts(reads, options, by=by, positions=positions, tiles=tiles, differing=differing, besides=besides, samples=samples)
    calls = with_alleles(counts)
    return attach_indels(calls, found) if indels else calls


def call_variants(
    reads: DataFrame,
    tiles: DataFrame,
    samples: list[str],
    cutoffs: Cutoffs = Cutoffs(),
    options: PileupOptions = PileupOptions(),
    hets: bool = False,
    indels: bool = False,
) -> DataFrame:
    """Sites called by coverage and purity: ``chrom, pos, type, ref, obs``."""
    return called_sites(sample_calls(reads, tiles, options, indels, differing=True), samples, cutoffs, hets, indels)


def genotype_positions(
    reads: DataFrame,
    tiles: DataFrame,
    positions: DataFrame,
    samples: list[str],
    options: PileupOptions = PileupOptions(),
) -> DataFrame:
    """Genotypes at listed positions, with rows for positions without reads."""
    calls = sample_calls(reads, tiles, options, positions=positions)
    return snarp(calls, positions, tiles, samples)


def joint_call(
    reads: DataFrame,
    tiles: DataFrame,
    samples: list[str],
    options: PileupOptions = PileupOptions(),
    hets: bool = False,
) -> DataFrame:
    """All samples at the union of the samples' variants, one row per called alternate.

    The likelihood counters are used twice, so they are stored once.
    """
    counts = pileup_counts(reads, options, quality=True, tiles=tiles, differing=True)
    stored = materialize(counts, "counters")
    return joint_sites(stored, called_alternates(genotypes(stored), hets), samples)


def joint_sites_call(
    reads: DataFrame,
    tiles: DataFrame,
    samples: list[str],
    options: PileupOptions = PileupOptions(),
    hets: bool = False,
) -> DataFrame:
    """All samples against all alleles that some sample is called with, one row a site.

    The likelihood counters are used twice, so they are stored once.
    """
    counts = pileup_counts(reads, options, quality=True, tiles=tiles, differing=True)
    stored = materialize(counts, "counters")
    return site_genotypes(stored, called_alternates(genotypes(stored), hets), samples)


@dataclass(frozen=True)
class Run:
    """Settings of one run from read pairs, or from alignments, to a result table.

    ``alignments`` is SAM text or Parquet (one table a sample, or one with a ``sample`` column);
    ``manifest`` lists samples and SAM files.  With either, ``paths`` is not read.
    """

    paths: str
    reference: str
    output: str
    alignments: str | None = None
    manifest: str | None = None
    alignment_format: str = "sam"
    name: str = "variants"
    read_format: str = "avro"
    partitions: int | None = None
    save_alignments: bool = False
    index: bool = False
    stop_after_alignment: bool = False
    hets: bool = False
    indels: bool = False
    vcf: bool = False
    positions: DataFrame | None = None
    region: tuple[str, int, int] | None = None
    cutoffs: Cutoffs = field(default_factory=Cutoffs)
    options: PileupOptions = field(default_factory=PileupOptions)
    seed_length: int = align.K
    seed_stride: int = align.STRIDE
    max_insert: int = align.MAX_INSERT
    max_mismatch: float = align.MAX_MISMATCH


def run(spark: SparkSession, job: Run) -> DataFrame | None:
    """Align, store, call and write; the result table is returned as well.

    Alignments are written once, sorted; the passes of the pileup then read only the columns
    they use.
    """
    if job.vcf and job.indels and job.positions is None:
        warnings.warn("VCF rows hold no indels; call without vcf for indel rows", stacklevel=2)
    tiles = materialize(fasta_tiles(spark, job.reference), "tiles")
    contigs = materialize(genome.contig_dictionary(genome.contig_lengths(tiles)), "contigs")
    aligned = _alignments(spark, job, tiles, contigs)
    if job.save_alignments or job.index or job.stop_after_alignment:
        path = f"{job.output}/{job.name}.alignments"
        write_sorted(aligned, contigs, path)
        reads = spark.read.parquet(path)
        if job.index:
            bins = f"{job.output}/{job.name}.bins"
            bin_index(reads).write.parquet(bins)
            if job.region:
                start = region_start(spark.read.parquet(bins), *job.region)
                reads = region_reads(reads, *job.region, start=start)
        if job.stop_after_alignment:
            return None
    else:
        reads = materialize(aligned, "alignments")
    samples = [r.sample for r in reads.select("sample").distinct().orderBy("sample").collect()]
    result = _result(reads, tiles, samples, job)
    if job.vcf and job.positions is None:
        write_vcf(result, f"{job.output}/{job.name}.vcf")
    else:
        write_matrix(result, f"{job.output}/{job.name}.txt")
    return result


def run_in_segments(spark: SparkSession, job: Run, n_segments: int) -> DataFrame:
    """Call segment by segment, so that a run that ended half-way goes on where it stopped.

    Under ``output`` the alignments are stored once by segment of equal read counts, each read in
    every segment it touches; then every segment's sites go to a folder of their own, complete
    when its writer has left its marker there.  A later run with the same ``output`` and name
    takes what is complete as it is and computes the rest; settings must be those of the first.
    Reads on contigs that the reference lacks are called in a segment of their own, the last.
    """
    if job.vcf or job.positions is not None or job.region:
        raise ValueError("segments are called by thresholds over the whole genome")
    place = f"{job.output}/{job.name}"
    tiles = materialize(fasta_tiles(spark, job.reference), "tiles")
    contigs = materialize(genome.contig_dictionary(genome.contig_lengths(tiles)), "contigs")
    if not _complete(spark, f"{place}.by-segment"):
        aligned = materialize(_alignments(spark, job, tiles, contigs), "alignments")
        placed = genome.with_cum_pos(aligned_only(aligned), contigs)
        bounds = materialize(tiling.equal_bounds(placed, n_segments), "bounds")
        bounds.write.mode("overwrite").parquet(f"{place}.bounds")
        names = aligned.select("sample").distinct()
        names.write.mode("overwrite").parquet(f"{place}.samples")
        end = F.col("cum_pos") + ref_span(F.col("cigar")) - 1
        copies = tiling.spanned_segments(placed, bounds, n_segments, end)
        copies = copies.withColumn("seg", F.coalesce("seg", F.lit(-1).cast("bigint"))).drop("chrom_ord", "offset", "cum_pos")
        copies.repartition("seg").write.mode("overwrite").partitionBy("seg").parquet(f"{place}.by-segment")
    bounds = spark.read.parquet(f"{place}.bounds")
    samples = [r.sample for r in spark.read.parquet(f"{place}.samples").orderBy("sample").collect()]
    reads = spark.read.parquet(f"{place}.by-segment")
    segs = [r.seg for r in reads.select("seg").distinct().orderBy("seg").collect()]
    for seg in segs:
        folder = f"{place}.sites/{seg}"
        if not _complete(spark, folder):
            sites = call_variants(reads.filter(F.col("seg") == seg), tiles, samples, job.cutoffs, job.options, job.hets, job.indels)
            placed = genome.with_cum_pos(sites, contigs, "chrom")
            own = tiling.assign_segment(placed, bounds, n_segments).filter(F.coalesce("seg", F.lit(-1)) == seg)
            own.drop("seg", "chrom_ord", "offset", "cum_pos").write.mode("overwrite").parquet(folder)
    sites = spark.read.parquet(*(f"{place}.sites/{seg}" for seg in segs)) if segs else None
    if sites is None:
        sites = call_variants(reads, tiles, samples, job.cutoffs, job.options, job.hets, job.indels)
    result = matrix(_ordered(sites, contigs), samples)
    write_matrix(result, f"{place}.txt")
    return result


def _complete(spark: SparkSession, folder: str) -> bool:
    """Whether a writer has finished this folder."""
    marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    return marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker)


def _ordered(sites: DataFrame, contigs: DataFrame) -> DataFrame:
    lookup = contigs.select("chrom", "chrom_ord")
    return sites.join(lookup, "chrom", "left").orderBy(F.col("chrom_ord").asc_nulls_last(), "chrom", "pos")


def _alignments(spark: SparkSession, job: Run, tiles: DataFrame, contigs: DataFrame) -> DataFrame:
    """Given alignments as they are, else read pairs placed on the reference."""
    if job.manifest:
        return listed_alignments(spark, job.manifest)
    if job.alignments:
        return alignments(spark, job.alignments, job.alignment_format)
    pairs = read_pairs(spark, job.paths, job.read_format)
    if job.partitions:
        pairs = pairs.repartition(job.partitions)
    return align.seed_align(
        pairs, tiles, contigs, job.seed_length, job.seed_stride, job.max_insert, job.max_mismatch
    )


def _result(reads: DataFrame, tiles: DataFrame, samples: list[str], job: Run) -> DataFrame:
    """Positions first, else VCF, else calls by thresholds; rows in genome order."""
    if job.region:
        reads = region_reads(reads, *job.region)
    if job.positions is not None:
        sites = genotype_positions(reads, tiles, job.positions, samples, job.options)
    elif job.vcf:
        sites = with_quality(joint_sites_call(reads, tiles, samples, job.options, job.hets))
    else:
        sites = call_variants(reads, tiles, samples, job.cutoffs, job.options, job.hets, job.indels)
    if job.region:
        sites = region_sites(sites, *job.region)
    # The result is written and returned; only its sorting is done twice.
    sites = materialize(sites, "sites")
    ordered = _ordered(sites, genome.contig_dictionary(genome.contig_lengths(tiles)))
    if job.vcf and job.positions is None:
        return site_vcf_rows(ordered, samples)
    return matrix(ordered, samples)
