"""Contig order, running sums, segments, merges and file formats."""

import gzip
import random
from bisect import bisect_left

import pytest
from pyspark.sql import functions as F

from genopile.operators import align, genome, merge, tiling
from genopile.operators.prefix import exclusive_prefix
from genopile.sources.reads import fastq_to_pairs
from genopile.sources.reference import fasta_tiles


def test_contig_order_is_numeric_then_by_name(spark):
    table = spark.createDataFrame(
        [("chr10", 5), ("chr2", 7), ("chrX", 11), ("scaffold_2", 13), ("chr99999999999999999999", 1)], "chrom string, len bigint"
    )
    got = genome.contig_dictionary(table).orderBy("chrom_ord").collect()
    assert [(r.chrom, r.offset) for r in got] == [
        ("chr2", 0),
        ("scaffold_2", 7),
        ("chr10", 20),
        ("chr99999999999999999999", 25),
        ("chrX", 26),
    ]


def test_prefix_over_many_buckets(spark):
    rng = random.Random(3)
    keys = sorted(rng.sample(range(1 << 40), 500))
    table = spark.createDataFrame([(k, k % 7 + 1) for k in keys], "k bigint, v bigint").repartition(5)
    got = {r.k: r.before for r in exclusive_prefix(table, "k", [], {"v": "before"}, shifts=(8, 24)).collect()}
    total = 0
    for k in keys:
        assert got[k] == total
        total += k % 7 + 1


@pytest.mark.parametrize("n", [1, 15, 16, 17, 200])
def test_segments_cover_every_record(spark, n):
    rng = random.Random(n)
    spots = sorted(rng.choice([rng.randint(1, 5000), 777]) for _ in range(n))
    table = spark.createDataFrame([(p,) for p in spots], "cum_pos bigint")
    bounds = tiling.equal_bounds(table, 16)
    step = max(1, n // 16)
    want = sorted({p for i, p in enumerate(spots, 1) if i % step == 0})
    assert sorted(r.bound for r in bounds.collect()) == want
    got = tiling.assign_segment(table, bounds, 16).collect()
    assert all(r.seg == bisect_left(want, r.cum_pos) for r in got) and len(got) == n
    copies = sorted((r.cum_pos, r.seg) for r in tiling.halo_segments(table, bounds, 16).collect())
    spans = [(want[i - 1] - 300 if i else float("-inf"), want[i] if i < len(want) else float("inf")) for i in range(len(want) + 1)]
    assert copies == sorted((p, i) for p in spots for i, (lo, hi) in enumerate(spans) if lo < p <= hi)


def test_no_records_no_bounds(spark):
    table = spark.createDataFrame([], "cum_pos bigint")
    assert tiling.segments(tiling.equal_bounds(table, 16)).collect()[0].seg == 0


def test_merge_keeps_positions_of_different_contigs_and_types(spark):
    obs = "array<struct<sample:string,basecall:string,cov:bigint,purity:double>>"
    rows = [
        ("chr1", 5, "SNP", "A", [("s0", "C", 3, 1.0)]),
        ("chr1", 5, "SNP", "A", [("s0", "C", 9, 1.0)]),
        ("chr1", 5, "INS", "A", [("s0", "AG", 2, 1.0)]),
        ("chr2", 5, "SNP", "A", [("s0", "C", 1, 1.0)]),
    ]
    table = spark.createDataFrame(rows, f"chrom string, pos bigint, type string, ref string, obs {obs}")
    got = sorted((r.chrom, r.type, r.obs[0].cov) for r in merge.merge_calls(table).collect())
    assert got == [("chr1", "INS", 2), ("chr1", "SNP", 9), ("chr2", "SNP", 1)]


@pytest.mark.parametrize("packed", [False, True])
def test_fasta_lines_of_any_length(spark, tmp_path, packed):
    rng = random.Random(7)
    seqs = {f"c{i}": "".join(rng.choice("ACGT") for _ in range(n)) for i, n in enumerate((1, 60, 61, 5000, 3333))}
    text = "".join(f">{c} note\n" + "".join(s[i : i + w] + "\n" for i in range(0, len(s), w)) for w, (c, s) in zip((60, 60, 7, 5000, 100), seqs.items()))
    path = tmp_path / ("r.fa.gz" if packed else "r.fa")
    path.write_bytes(gzip.compress(text.encode()) if packed else text.encode())
    # Small splits make contigs and lines cross them.
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        tiles = fasta_tiles(spark, str(path), 64).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    got = {}
    for r in sorted(tiles, key=lambda r: (r.chrom, r.tile)):
        got[r.chrom] = got.get(r.chrom, "") + r.seq
    assert got == seqs


def test_fastq_with_awkward_qualities(spark, tmp_path):
    """Qualities may begin with the characters that begin other lines."""
    n = 300
    for mate in (1, 2):
        lines = [f"@r{i}/{mate}\n{'ACGT' * (i % 5 + 1)}\n+\n{'@+#I' * (i % 5 + 1)}\n" for i in range(n)]
        (tmp_path / f"r{mate}.fastq").write_text("".join(lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        got = fastq_to_pairs(spark, {"s": str(tmp_path / "r1.fastq")}, {"s": str(tmp_path / "r2.fastq")}).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(r.header for r in got) == sorted(f"r{i}" for i in range(n))
    assert all(r.seq1 == r.seq2 and r.qual1 == r.qual2 == "@+#I" * (len(r.seq1) // 4) for r in got)


def test_exact_reads_go_back_to_their_origin(spark):
    rng = random.Random(11)
    seqs = {f"chr{i}": "".join(rng.choice("ACGT") for _ in range(3000)) for i in range(3)}
    tiles = genome.tile_reference(spark.createDataFrame(list(seqs.items()), "chrom string, seq string"))
    contigs = genome.contig_dictionary(genome.contig_lengths(tiles))
    comp = str.maketrans("ACGT", "TGCA")
    data, want = [], {}
    for i in range(200):
        chrom, at = f"chr{i % 3}", rng.randint(0, 2850)
        first, second = seqs[chrom][at : at + 50], seqs[chrom][at + 90 : at + 140].translate(comp)[::-1]
        data.append(("s", f"r{i}", first, "I" * 50, second, "H" * 50))
        want[f"r{i}"] = (chrom, at + 1, at + 91)
    pairs = spark.createDataFrame(data, "sample string, header string, seq1 string, qual1 string, seq2 string, qual2 string")
    got = align.seed_align(pairs, tiles, contigs).collect()
    assert len(got) == 400
    for r in got:
        chrom, p1, p2 = want[r.qname]
        own, other = (p1, p2) if r.flag & 64 else (p2, p1)
        assert (r.rname, r.pos, r.pnext, r.rnext) == (chrom, own, other, "=")
        assert r.flag & 3 == 3 and bool(r.flag & 16) == bool(r.flag & 128)
        assert r.seq == seqs[chrom][own - 1 : own + 49]
        assert abs(r.tlen) == 140


def test_reads_of_repeats_are_placed_not_lost(spark):
    unit = "ACGTTGCATCGGATTACAGCCTGAACTTGGCATCAGTTACCGATGCAAT"
    tiles = genome.tile_reference(spark.createDataFrame([("chr1", unit * 40), ("chr2", "GATC" * 60)], "chrom string, seq string"))
    contigs = genome.contig_dictionary(genome.contig_lengths(tiles))
    read = (unit * 2)[:50]
    pairs = spark.createDataFrame([("s", "r", read, "I" * 50, "", "")], "sample string, header string, seq1 string, qual1 string, seq2 string, qual2 string")
    r = align.seed_align(pairs, tiles, contigs).first()
    assert (r.rname, r.pos, r.mapq, r.flag) == ("chr1", 1, 0, 0)


PAIR = "sample string, header string, seq1 string, qual1 string, seq2 string, qual2 string"


def _single(spark, contigs, reads):
    tiles = genome.tile_reference(spark.createDataFrame(list(contigs.items()), "chrom string, seq string"))
    known = genome.contig_dictionary(genome.contig_lengths(tiles))
    data = [("s", name, seq, "I" * len(seq), "", "") for name, seq in reads]
    return align.seed_align(spark.createDataFrame(data, PAIR), tiles, known).collect()


def test_a_repeat_of_twelve_copies_goes_to_an_exact_one(spark):
    rng = random.Random(5)
    unit = "".join(rng.choice("ACGT") for _ in range(60))
    odd = unit[:30] + ("A" if unit[30] != "A" else "C") + unit[31:]
    contigs = {f"chr{i}": (odd if i == 1 else unit) for i in range(1, 13)}
    got = {r.qname: r for r in _single(spark, contigs, [("u", unit), ("o", odd)])}
    assert (got["u"].rname, got["u"].mapq, got["o"].rname) == ("chr2", 0, "chr1")


def test_reads_with_few_equal_bases_stay_unplaced(spark):
    rng = random.Random(6)
    ref = "".join(rng.choice("ACGT") for _ in range(500))
    junk = ref[100:120] + "".join({"A": "C", "C": "A", "G": "T", "T": "G"}[b] for b in ref[120:160])
    (r,) = _single(spark, {"chr1": ref}, [("j", junk)])
    assert (r.flag, r.rname, r.mapq) == (4, "*", 0)


def test_reads_of_one_name_go_their_own_ways(spark):
    rng = random.Random(7)
    ref = "".join(rng.choice("ACGT") for _ in range(2000))
    got = _single(spark, {"chr1": ref}, [("same", ref[1000:1050]), ("same", ref[1500:1550])])
    assert sorted(r.pos for r in got) == [1001, 1501]


def test_rows_on_unknown_contigs_stay_and_come_last(spark):
    contigs = spark.createDataFrame([("c1", 1, 10, 0), ("c2", 2, 10, 10)], "chrom string, chrom_ord long, len long, offset long")
    reads = spark.createDataFrame([("x9", 3, "r3"), ("c2", 4, "r2"), ("c1", 5, "r1"), ("x1", 1, "r4")], "rname string, pos int, qname string")
    placed = genome.with_cum_pos(reads, contigs)
    assert [(r.qname, r.cum_pos) for r in genome.genome_sort(placed).collect()] == [("r1", 5), ("r2", 14), ("r4", None), ("r3", None)]
    bounds = tiling.equal_bounds(placed, 2)
    assert sorted(r.bound for r in bounds.collect()) == [5, 14]
    assert {r.qname: r.seg for r in tiling.assign_segment(placed, bounds, 2).collect()} == {"r1": 0, "r2": 1, "r3": None, "r4": None}
    halo = sorted((r.qname, r.seg) for r in tiling.halo_segments(placed, bounds, 2, 16).collect() if r.seg is None)
    assert halo == [("r3", None), ("r4", None)]
    calls = reads.select(F.col("rname").alias("chrom"), "pos", F.lit("SNP").alias("type"))
    assert [r.chrom for r in merge.merged_order(calls, contigs).collect()] == ["c1", "c2", "x1", "x9"]


def test_contig_numbers_of_any_size_are_ordered(spark):
    names = ["c2", "c10", f"c{2**48 - 1}", f"c{2**48}", f"c{2**48 + 1}", f"c{2**64}", f"c{10**30}", "cx", "cy"]
    frame = spark.createDataFrame([(n, 5) for n in reversed(names)], "chrom string, len long")
    got = genome.contig_dictionary(frame).orderBy("chrom_ord").collect()
    assert [r.chrom for r in got] == names and [r.offset for r in got] == list(range(0, 45, 5))
