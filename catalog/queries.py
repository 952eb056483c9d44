"""One query per operator, over the tables derived in ``genopile.fixtures``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genopile import fixtures as fx
from genopile.config import Cutoffs, PileupOptions
from genopile.functions import alleles as A
from genopile.operators import align, calls, genome, genotype, indels, merge, positions, reads, tiling
from genopile.operators.pileup import pileup_counts
from genopile.operators.prefix import exclusive_prefix
from genopile.operators.text_pileup import parse_pileup, text_calls
from genopile.plans import modes
from genopile.sinks import alignments as aln_sink
from genopile.sinks import variants as var_sink
from genopile.sources import alignments as aln_source
from genopile.sources import reads as read_source
from genopile.sources import reference as ref_source
from genopile.sources import tables
from genopile.storage import free_shuffles, materialize, release, scratch

SAMPLES = fx.SAMPLES
SEGMENTS = 16
SITE = ["chrom", "pos", "ref", "sample"]
LOOSE = Cutoffs(hets_cov=4)
BSA = {"min_cov": 5, "max_ref_freq": 0.5}

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


# Inputs ------------------------------------------------------------------------------


def _tiles(spark: SparkSession, d: str) -> DataFrame:
    return genome.tile_reference(fx.contigs(spark, d))


def _contigs(spark: SparkSession, d: str) -> DataFrame:
    return genome.contig_dictionary(genome.contig_lengths(_tiles(spark, d)))


def _reference(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Tiles and contigs, both stored, for steps that read them more than once."""
    tiles = materialize(_tiles(spark, d), "tiles")
    return tiles, materialize(genome.contig_dictionary(genome.contig_lengths(tiles)), "contigs")


def _cum(spark: SparkSession, d: str) -> DataFrame:
    return genome.with_cum_pos(reads.aligned_only(fx.aln(spark, d)), _contigs(spark, d))


def _bounds(spark: SparkSession, d: str) -> DataFrame:
    return tiling.equal_bounds(_cum(spark, d), SEGMENTS)


def _stored_bounds(spark: SparkSession, d: str) -> DataFrame:
    """Bounds on their own; the one column they need is stored, as their running sum reads it often."""
    return tiling.equal_bounds(materialize(_cum(spark, d).select("cum_pos"), "cum-pos"), SEGMENTS)


def _text(spark: SparkSession, d: str, with_indels: bool = False) -> DataFrame:
    return text_calls(fx.pileup(spark, d), with_indels)


def _aln(spark: SparkSession, d: str) -> DataFrame:
    """Alignments for steps that read them more than once."""
    return materialize(fx.aln(spark, d), "all-alignments", "zstd")


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    """Read pairs for steps that read them more than once."""
    return materialize(fx.read_pairs(spark, d), "all-pairs", "zstd")


def _sites(spark: SparkSession, d: str, quality: bool = False) -> DataFrame:
    return pileup_counts(_aln(spark, d), quality=quality, tiles=_tiles(spark, d), differing=True)


COUNTS = ["n_a", "n_c", "n_g", "n_t", "n_n", "n_del"]


# Sources -----------------------------------------------------------------------------


@query
def read_pairs(spark, d):
    """Stored read pairs of all samples, found by a wildcard."""
    path = scratch(spark, "pairs")
    pairs = _pairs(spark, d)
    for s in SAMPLES:
        pairs.filter(F.col("sample") == s).drop("sample").write.parquet(f"{path}/{s}.parquet")
    release(pairs)
    return read_source.read_pairs(spark, f"{path}/*.parquet", "parquet")


@query
def tag_samples(spark, d):
    """Samples named by their files, from a comma-separated list of JSON tables."""
    path = scratch(spark, "pairs")
    pairs = _pairs(spark, d)
    for s in SAMPLES:
        pairs.filter(F.col("sample") == s).drop("sample").write.json(f"{path}/{s}.json", compression="gzip")
    release(pairs)
    listed = ",".join(f"{path}/{s}.json" for s in SAMPLES)
    return read_source.read_pairs(spark, listed, "json").select("sample", "header")


def _write_fastq(pairs: DataFrame, path: str, mate: int, compression: str) -> None:
    """Records in the order of the stored pairs, which both mates share."""
    record = F.concat_ws(
        "\n", F.concat(F.lit("@"), F.col("header"), F.lit(f"/{mate}")), F.col(f"seq{mate}"), F.lit("+"), F.col(f"qual{mate}")
    )
    pairs.select(record.alias("value")).write.text(path, compression=compression)


@query
def fastq_to_pairs(spark, d):
    """Two-mate FASTQ, plain and gzipped, and the single-end reads on their own, back to pairs."""
    path = scratch(spark, "fastq")
    # Derived once; seven files are written from it.
    pairs = _pairs(spark, d)
    first, second = {}, {}
    for s, compression in zip(SAMPLES, ("none", "gzip", "none")):
        own = pairs.filter(F.col("sample") == s)
        first[s] = f"{path}/{s}_1.fastq"
        _write_fastq(own, first[s], 1, compression)
        second[s] = f"{path}/{s}_2.fastq"
        _write_fastq(own, second[s], 2, compression)
    first["single"] = f"{path}/single_1.fastq"
    _write_fastq(pairs.filter("seq2 = ''"), first["single"], 1, "none")
    release(pairs)
    return read_source.fastq_to_pairs(spark, first, second)


@query
def fasta_contigs(spark, d):
    """Contig lengths and base counts of a FASTA file, read by lines."""
    path = scratch(spark, "fasta")
    lines = F.array_join(F.regexp_extract_all("seq", F.lit(".{1,60}"), F.lit(0)), "\n")
    text = F.concat(F.lit(">"), F.col("chrom"), F.lit(" derived\n"), lines)
    fx.contigs(spark, d).select(text.alias("value")).write.text(f"{path}/ref.fasta")
    tiles = ref_source.fasta_tiles(spark, f"{path}/ref.fasta")
    per_tile = tiles.withColumns({f"n_{b.lower()}": F.length(F.regexp_replace("seq", f"[^{b}]", "")) for b in "ACGT"})
    return per_tile.groupBy("chrom").agg(
        F.sum(F.length("seq")).alias("len"), *(F.sum(f"n_{b}").alias(f"n_{b}") for b in "acgt")
    )


@query
def ref_bases(spark, d):
    listed = fx.positions(spark, d).distinct()
    return genome.ref_bases(listed, _tiles(spark, d)).select("chrom", "pos", "ref")


@query
def position_list(spark, d):
    path = scratch(spark, "positions")
    lines = fx.positions(spark, d).select(F.concat_ws("\t", "chrom", F.col("pos").cast("string")).alias("value"))
    note = spark.createDataFrame([("#seqid\tcoord",)], "value string")
    note.unionByName(lines).unionByName(lines).write.text(f"{path}/list.tsv")
    return tables.positions(spark, f"{path}/list.tsv")


@query
def manifest_missing(spark, d):
    """A manifest of one file per supplier, of which those of the samples are written."""
    path = scratch(spark, "manifest")
    fx.read_pairs(spark, d).select(F.col("header").alias("value"), "sample").write.partitionBy("sample").text(f"{path}/files")
    supplier = spark.read.parquet(f"{d}/supplier.parquet")
    name = F.concat(F.lit("s"), F.col("s_suppkey"))
    line = F.concat(name, F.lit(f"\t{path}/files/sample="), name)
    note = spark.createDataFrame([("#name\tfilename",)], "value string")
    note.unionByName(supplier.select(line.alias("value"))).write.text(f"{path}/list.tsv")
    listed = tables.with_presence(tables.manifest(spark, f"{path}/list.tsv"), [f"{path}/files"])
    return tables.missing_files(listed).select("sample", F.regexp_extract("path", "([^/]+)$", 1).alias("file"))


def _written_sam(spark, d) -> str:
    """SAM text of every sample, packed; the alignments it is written from go once it is there."""
    path = scratch(spark, "sam")
    fields = [F.col(c).cast("string") for c in ("qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual")]
    head = aln_sink.header_lines(_contigs(spark, d)).select("value")
    aln = _aln(spark, d)
    for s in SAMPLES:
        # Every record is followed by a blank line.
        body = aln.filter(F.col("sample") == s).select(F.concat(F.concat_ws("\t", *fields), F.lit("\n")).alias("value"))
        head.unionByName(body).write.text(f"{path}/{s}.sam", compression="gzip")
    release(aln)
    return path


@query
def sam_rows(spark, d):
    lines = aln_source.sam_lines(spark, f"{_written_sam(spark, d)}/*.sam")
    return aln_source.sam_rows(lines).drop("tags")


@query
def manifest_calls(spark, d):
    """From a manifest of SAM files to called variants, without placing reads."""
    path = _written_sam(spark, d)
    lines = "\n".join(f"{s}\t{path}/{s}.sam" for s in SAMPLES)
    spark.createDataFrame([(lines,)], "value string").write.text(f"{path}/list.tsv")
    rows = aln_source.listed_alignments(spark, f"{path}/list.tsv")
    sites = modes.call_variants(rows, _tiles(spark, d), SAMPLES)
    return calls.long_rows(sites)


@query
def contigs(spark, d):
    """Contig dictionary from ``@SQ`` lines."""
    lines = aln_source.sam_lines(spark, f"{_written_sam(spark, d)}/*.sam")
    return genome.contig_dictionary(aln_source.header_contigs(lines)).select("chrom", "chrom_ord", "len")


@query
def split_sam_records(spark, d):
    """Aligner output, many lines in one text, to rows."""
    line = F.concat_ws("\t", "qname", F.col("flag").cast("string"), "rname", F.col("pos").cast("string"))
    text = F.concat(line, F.lit("\n\n"), line, F.lit("\n"))
    blobs = fx.aln(spark, d).select("sample", text.alias("text"))
    return aln_source.split_records(blobs).select("sample", "value")


@query
def pileup_rows(spark, d):
    """Wide pileup text to one row per sample."""
    path = scratch(spark, "pileup")
    cell = F.concat_ws("\t", F.col("depth").cast("string"), "bases", "quals")
    wide = fx.pileup(spark, d).groupBy("chrom", "pos", "ref").pivot("sample", SAMPLES).agg(F.max(cell))
    line = F.concat_ws("\t", "chrom", F.col("pos").cast("string"), "ref", *(F.coalesce(s, F.lit("0\t*\t*")) for s in SAMPLES))
    wide.select(line.alias("value")).write.text(path)
    return tables.pileup_rows(spark, path, SAMPLES)


@query
def vcf_rows_in(spark, d):
    """VCF written by the sink, read back to genotypes."""
    path = scratch(spark, "vcf")
    var_sink.write_vcf(vcf_rows(spark, d), path)
    body = tables.vcf_body(spark, [f"{path}/header", f"{path}/records"], SAMPLES)
    return tables.vcf_variants(body, SAMPLES)


# Sinks -------------------------------------------------------------------------------


@query
def sorted_alignments(spark, d):
    path = scratch(spark, "sorted")
    # Ranges are found by a pass of their own, so alignments and contigs are derived before it.
    aln, known = _aln(spark, d), materialize(_contigs(spark, d), "contigs")
    free_shuffles(spark)
    aln_sink.write_sorted(aln, known, path, compression="zstd")
    release(aln)
    return spark.read.parquet(path).select(*aln.columns)


@query
def sorted_sam(spark, d):
    """SAM text sink, read back by the SAM reader's columns."""
    path = scratch(spark, "sorted")
    # Contigs of a known size, few enough of which are broadcast, so that reads move once.  Alignments
    # are stored: packed they are smaller than the shuffle files of deriving them twice.
    aln, known = _aln(spark, d), materialize(_contigs(spark, d), "contigs")
    free_shuffles(spark)
    aln_sink.write_sam(aln, known, path, compression="gzip")
    release(aln)
    lines = spark.read.text(f"{path}/records")
    return aln_source.sam_rows(lines).select("sample", "qname", "flag", "rname", "pos", "cigar")


@query
def bin_index(spark, d):
    return aln_sink.bin_index(fx.aln(spark, d))


@query
def genotype_matrix(spark, d):
    sites = calls.called_sites(_text(spark, d, True), SAMPLES, hets=True, indels=True)
    return calls.matrix(sites, SAMPLES)


@query
def matrix_file(spark, d):
    """The matrix written as text with a header and read back."""
    path = scratch(spark, "matrix")
    var_sink.write_matrix(calls.matrix(calls.called_sites(_text(spark, d), SAMPLES), SAMPLES), path)
    head = spark.read.text(f"{path}/header").first()["value"].split("\t")
    return spark.read.csv(f"{path}/records", sep="\t", schema=", ".join(f"`{c}` string" for c in head))


@query
def vcf_rows(spark, d):
    sites = modes.joint_call(_aln(spark, d), _tiles(spark, d), SAMPLES, hets=True)
    return genotype.vcf_rows(sites, SAMPLES)


# Projections and filters -------------------------------------------------------------


@query
def tab5(spark, d):
    return reads.tab5(fx.read_pairs(spark, d))


@query
def fastq_out(spark, d):
    return reads.fastq_records(fx.read_pairs(spark, d))


@query
def aligned_only(spark, d):
    return reads.aligned_only(fx.aln(spark, d)).select("sample", "qname", "rname", "pos")


@query
def key_by_pos(spark, d):
    return genome.key_by_pos(reads.aligned_only(fx.aln(spark, d))).select("sample", "qname", "rname", "chrom_num", "pos")


@query
def min_mapq(spark, d):
    return reads.min_mapq(fx.aln(spark, d)).select("sample", "qname", "mapq")


@query
def region_filter(spark, d):
    aln = _aln(spark, d)
    start = aln_sink.region_start(aln_sink.bin_index(aln), "chr7", 100, 500)
    found = reads.region_reads(aln, "chr7", 100, 500, start)
    return found.select("sample", "qname", "rname", "pos", "cigar")


@query
def at_positions(spark, d):
    rows = reads.at_positions(_text(spark, d), fx.positions(spark, d))
    return rows.select(*SITE, "cov")


@query
def pileup_opts(spark, d):
    """Pileup with other settings."""
    options = PileupOptions(min_mapq=15, min_base_qual=25, skip_flags=0x4 | 0x10)
    return pileup_counts(fx.aln(spark, d), options).select("chrom", "pos", "sample", "depth", *COUNTS)


@query
def fragment_pileup(spark, d):
    """Pileup of aligned pairs, each fragment counted once."""
    aligned = materialize(align.seed_align(fx.read_pairs(spark, d), _tiles(spark, d), _contigs(spark, d), scores=None), "pairs")
    options = PileupOptions(min_mapq=0, one_per_fragment=True, count_orphans=True)
    return pileup_counts(aligned, options).select("chrom", "pos", "sample", "depth", *COUNTS)


# Genome axis and tiling --------------------------------------------------------------


@query
def cum_offsets(spark, d):
    return _contigs(spark, d).select("chrom", "chrom_ord", "offset")


@query
def cum_pos(spark, d):
    return _cum(spark, d).select("sample", "qname", "rname", "pos", "cum_pos")


@query
def genome_sort(spark, d):
    # Sorting reads its rows twice, as ranges are found first; the names and places are derived once.
    placed = materialize(_cum(spark, d).select("sample", "qname", "rname", "chrom_ord", "pos"), "placed-names")
    return genome.genome_sort(placed).select("sample", "qname", "chrom_ord", "pos")


@query
def equal_bounds(spark, d):
    return _stored_bounds(spark, d)


@query
def sketch_bounds(spark, d):
    """Whether the ranks of bounds from sketches are within the stated error."""
    rows, n, accuracy = materialize(_cum(spark, d).select("cum_pos"), "cum-pos"), 16, 200
    cuts = materialize(tiling.approximate_bounds(rows, n, accuracy), "sketch-bounds")
    counted = materialize(rows.groupBy("cum_pos").agg(F.count(F.lit(1)).alias("k")), "positions")
    total = counted.agg(F.sum("k")).first()[0]
    ranked = exclusive_prefix(counted, "cum_pos", [], {"k": "before"})
    target, slack = F.col("cut") * total / n, total / accuracy + 1
    near = (F.col("before") <= target + slack) & (F.col("before") + F.col("k") >= target - slack)
    return cuts.join(ranked, F.col("bound") == F.col("cum_pos")).select("cut", near.alias("near"))


@query
def segments(spark, d):
    return tiling.segments(_stored_bounds(spark, d))


@query
def assign_segment(spark, d):
    rows = tiling.assign_segment(_cum(spark, d), _bounds(spark, d), SEGMENTS)
    return rows.select("sample", "qname", "cum_pos", "seg")


@query
def halo_segments(spark, d):
    rows = tiling.halo_segments(_cum(spark, d), _bounds(spark, d), SEGMENTS)
    return rows.select("sample", "qname", "cum_pos", "seg")


# Alignment ---------------------------------------------------------------------------


@query
def kmers(spark, d):
    """Distinct k-mers of the reference with their counts."""
    tiles = materialize(_tiles(spark, d), "tiles")
    # Places are not asked for, so k-mers meet no contigs.
    return align.kmer_counts(align.reference_kmers(tiles, None)).select("kmer", "n")


@query
def kmer_repeats(spark, d):
    tiles, known = _reference(spark, d)
    found = align.kmer_repeats(align.reference_kmers(tiles, known), known)
    return found.select("kmer", "n", F.col("first.chrom").alias("chrom"), F.col("first.pos").alias("pos"))


def _votes(spark, d) -> DataFrame:
    tiles, known = _reference(spark, d)
    reads = align.sequences(align.mates(fx.read_pairs(spark, d)))
    votes = align.diagonal_votes(align.read_seeds(reads), align.reference_kmers(tiles, known))
    return align.vote_places(votes, known)


@query
def diag_votes(spark, d):
    return _votes(spark, d).select("read", "strand", "chrom", "start", "votes")


@query
def mismatches(spark, d):
    """Mismatches of reads aligned without gaps."""
    aln = fx.aln(spark, d).filter(F.col("cigar").rlike("^([0-9]+H)?([0-9]+[M=X])+$"))
    placed = aln.select("sample", F.col("qname").alias("header"), "rname", F.col("pos").cast("bigint").alias("pos"), "seq")
    return align.mismatches(placed, _tiles(spark, d), ["sample", "header"])


@query
def seed_align(spark, d):
    """Without gaps, which SQL can follow; see ``gapped_align``."""
    return align.seed_align(fx.read_pairs(spark, d), _tiles(spark, d), _contigs(spark, d), scores=None)


@query
def gapped_align(spark, d):
    return align.seed_align(fx.read_pairs(spark, d), _tiles(spark, d), _contigs(spark, d))


# Pileup and allele tables ------------------------------------------------------------


@query
def pileup_counts_by_site(spark, d):
    return pileup_counts(fx.aln(spark, d)).select("chrom", "pos", "sample", "depth", *COUNTS)


QUERIES["pileup_counts"] = QUERIES.pop("pileup_counts_by_site")


@query
def pileup_indels(spark, d):
    found = indels.pileup_indels(fx.aln(spark, d), _tiles(spark, d))
    return found.select("chrom", "pos", "sample", "indel", "n")


@query
def parse_pileup_rows(spark, d):
    return parse_pileup(fx.pileup(spark, d)).select(*SITE, "cov", *COUNTS)


QUERIES["parse_pileup"] = QUERIES.pop("parse_pileup_rows")


@query
def allele_counts(spark, d):
    return _text(spark, d).select(*SITE, A.allele_text().alias("alleles"))


@query
def indel_counts(spark, d):
    summary = indels.indel_summary(indels.text_indels(fx.pileup(spark, d)))
    text = F.array_join(F.transform("indels", lambda x: F.concat_ws(":", x["indel"], x["n"].cast("string"))), ",")
    return summary.select("chrom", "pos", "sample", text.alias("indels"))


@query
def depth(spark, d):
    return _text(spark, d).select(*SITE, "cov")


@query
def acgt_counts(spark, d):
    return _text(spark, d).select(*SITE, *COUNTS[:4])


# Per-site expressions ----------------------------------------------------------------


@query
def major_minor(spark, d):
    return _text(spark, d).select(*SITE, A.major().alias("major"), A.minor().alias("minor"))


@query
def purity(spark, d):
    return _text(spark, d).select(*SITE, A.purity().alias("purity"))


@query
def ref_freq(spark, d):
    return _text(spark, d).select(*SITE, A.ref_freq().alias("ref_freq"))


@query
def alt_freq(spark, d):
    return _text(spark, d).select(*SITE, A.alt_freq().alias("alt_freq"))


@query
def site_flags(spark, d):
    return _text(spark, d, True).select(
        *SITE,
        A.covered().alias("covered"),
        A.num_alleles().alias("num_alleles"),
        F.col("n_indels").alias("num_indels"),
        A.has_indel().alias("has_indel"),
    )


@query
def indel_purity(spark, d):
    return _text(spark, d, True).select(*SITE, A.indel_purity().alias("indel_purity"))


@query
def insertion(spark, d):
    return _text(spark, d, True).select(*SITE, A.has_insertion().alias("has_insertion"), A.insertion().alias("insertion"))


@query
def basecall(spark, d):
    return _text(spark, d).select(*SITE, A.basecall(10, 0.7).alias("basecall"))


@query
def basecall_all(spark, d):
    return _text(spark, d).select(*SITE, A.basecall_all().alias("basecall"))


@query
def max_indel(spark, d):
    return _text(spark, d, True).select(*SITE, A.max_indel().alias("max_indel"))


@query
def sample_view(spark, d):
    """All accessors of one sample."""
    return _text(spark, d, True).filter(F.col("sample") == "s1").select(
        "chrom",
        "pos",
        A.covered().alias("covered"),
        "cov",
        A.basecall(10, 0.7).alias("basecall"),
        A.purity().alias("purity"),
        A.major().alias("major"),
        A.minor().alias("minor"),
        A.has_insertion().alias("has_insertion"),
        A.insertion().alias("insertion"),
        A.indel_purity().alias("indel_purity"),
    )


# Predicates and calls ----------------------------------------------------------------


@query
def sample_snp(spark, d):
    return _text(spark, d).filter(A.is_snp(3, 0.98)).select(*SITE)


@query
def sample_het(spark, d):
    return _text(spark, d).filter(A.is_het(10, 0.7)).select(*SITE)


@query
def sample_variant(spark, d):
    return _text(spark, d).filter(A.is_variant(5, 0.5)).select(*SITE)


@query
def sample_indel(spark, d):
    return _text(spark, d, True).filter(A.is_indel(1, 0.5)).select(*SITE)


@query
def site_calls(spark, d):
    found = calls.site_calls(_text(spark, d, True), max_ref_freq=0.5)
    return found.select("chrom", "pos", "ref", "snp", "het", "indel", "variant")


@query
def call_variants(spark, d):
    """Alignments to calls of all three kinds."""
    sites = modes.call_variants(_aln(spark, d), _tiles(spark, d), SAMPLES, LOOSE, hets=True, indels=True)
    return calls.long_rows(sites)


@query
def snp_rows(spark, d):
    sites = modes.call_variants(_aln(spark, d), _tiles(spark, d), SAMPLES)
    return calls.long_rows(sites)


@query
def het_rows(spark, d):
    sites = calls.called_sites(_text(spark, d), SAMPLES, hets=True)
    return calls.long_rows(sites.filter(F.col("type") == "HET"))


@query
def indel_type(spark, d):
    return calls.indel_types(_text(spark, d, True))


@query
def indel_rows(spark, d):
    sites = calls.called_sites(_text(spark, d, True), SAMPLES, indels=True)
    return calls.long_rows(sites.filter(F.col("type").isin("IND", "INS", "DEL")))


@query
def bsa_rows(spark, d):
    return calls.bsa_rows(_text(spark, d), SAMPLES, **BSA)


@query
def site_samples(spark, d):
    # The samples of a site meet where they are counted; rows of sites are not shuffled.
    rows = modes.sample_calls(_aln(spark, d), _tiles(spark, d), samples=SAMPLES)
    return calls.site_samples(rows, SAMPLES, complete=True)


@query
def snarp(spark, d):
    sites = positions.snarp(_text(spark, d), fx.positions(spark, d), _tiles(spark, d), SAMPLES)
    return calls.long_rows(sites)


@query
def genotype_positions(spark, d):
    """Position mode on alignments."""
    listed = fx.positions(spark, d)
    sites = modes.genotype_positions(_aln(spark, d), _tiles(spark, d), listed, SAMPLES)
    return calls.matrix(sites, SAMPLES)


@query
def genotype_likelihood(spark, d):
    found = genotype.genotype_likelihood(_sites(spark, d, quality=True))
    return found.select("chrom", "pos", "ref", "alt", "sample", "pl_rr", "pl_ra", "pl_aa")


@query
def genotypes(spark, d):
    return genotype.genotypes(_sites(spark, d, quality=True)).select("chrom", "pos", "ref", "alt", "sample", "gt", "cov")


@query
def union_positions(spark, d):
    return genotype.union_positions(genotype.genotypes(_sites(spark, d, quality=True))).select("chrom", "pos")


@query
def site_genotypes(spark, d):
    """One row a site and sample, against all alleles of the site."""
    sites = modes.joint_sites_call(_aln(spark, d), _tiles(spark, d), SAMPLES, hets=True)
    return genotype.site_rows(sites)


@query
def joint_genotypes(spark, d):
    sites = modes.joint_call(_aln(spark, d), _tiles(spark, d), SAMPLES)
    return genotype.joint_rows(sites)


# Merge -------------------------------------------------------------------------------


def _segment_sites(spark, d) -> DataFrame:
    """SNP sites called inside each overlapping segment on its own."""
    # The segment copies are read several times below, so they are stored once.
    copies = tiling.halo_segments(_cum(spark, d), _bounds(spark, d), SEGMENTS)
    stored = materialize(copies.select(*fx.aln(spark, d).columns, "seg"), "segments")
    rows = modes.sample_calls(stored, _tiles(spark, d), by=("seg",), differing=True)
    return calls.called_sites(rows, SAMPLES)


@query
def union_samples(spark, d):
    pairs = fx.read_pairs(spark, d)
    return merge.union_samples(*(pairs.filter(F.col("sample") == s) for s in SAMPLES)).select("sample", "header")


@query
def merged_order(spark, d):
    sites = calls.called_sites(_text(spark, d), SAMPLES, hets=True)
    return merge.merged_order(sites, _contigs(spark, d)).select("chrom", "pos", "type", "ref")


@query
def exact_dedupe(spark, d):
    """Calls of overlapping segments, equal rows once."""
    return merge.exact_dedupe(calls.matrix(_segment_sites(spark, d), SAMPLES))


@query
def merge_calls(spark, d):
    return calls.long_rows(merge.merge_calls(_segment_sites(spark, d)))


@query
def merge_vcf(spark, d):
    """VCF rows merged with copies of themselves at the depth of their first sample."""
    rows = vcf_rows(spark, d)
    stored = materialize(rows, "vcf")
    less = F.concat(F.lit("DP="), F.regexp_extract("s0", r":(\d+)$", 1))
    return merge.merge_vcf(stored.unionByName(stored.withColumn("INFO", less)))
