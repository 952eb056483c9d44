"""CIGAR pileup against a plain walk, hot tiles, deep positions and partition independence."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from genopile.config import PileupOptions
from genopile.operators.genome import tile_reference
from genopile.operators.indels import pileup_indels
from genopile.operators.pileup import pileup_counts, with_ref
from genopile.plans.modes import call_variants, sample_calls

READ = "sample string, qname string, flag int, rname string, pos int, mapq int, cigar string, seq string, qual string"
LETTERS = {"A": "n_a", "C": "n_c", "G": "n_g", "T": "n_t", "N": "n_n", "*": "n_del"}


def reads(spark, rows):
    data = [(s, f"q{i}", 0, "chr1", pos, 60, cigar, seq, "I" * len(seq)) for i, (s, pos, cigar, seq) in enumerate(rows)]
    return spark.createDataFrame(data, READ)


def walk(rows):
    """Base by base, the obvious way."""
    seen, events = Counter(), Counter()
    for sample, pos, cigar, seq in rows:
        r, q, prev = pos, 0, ""
        for n, op in re.findall(r"(\d+)([MIDNSHP=X])", cigar):
            n = int(n)
            if op in "M=X":
                for i in range(n):
                    seen[sample, r + i, seq[q + i]] += 1
                r, q = r + n, q + n
            elif op == "D":
                for i in range(n):
                    seen[sample, r + i, "*"] += 1
                if prev in ("M", "=", "X", "D"):
                    events[sample, r - 1, f"-{n}"] += 1
                r += n
            elif op == "I":
                if prev in ("M", "=", "X", "D"):
                    events[sample, r - 1, "+" + seq[q : q + n]] += 1
                q += n
            elif op == "N":
                r += n
            elif op == "S":
                q += n
            prev = op
    return seen, events


def counted(df):
    return {(r.sample, r.pos, b): r[c] for r in df.collect() for b, c in LETTERS.items() if r[c]}


CIGARS = ["3M2I4M", "3M2D4M", "2S5M1S", "3M10N3M", "5H4M", "2=1X3=", "*", "2I5M", "4M1I2D3M", "9M"]


def sample_rows(n, seed=1, span=200):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        cigar = rng.choice(CIGARS)
        size = sum(int(k) for k, op in re.findall(r"(\d+)([MIS=X])", cigar)) or 5
        out.append((f"s{i % 2}", rng.randint(1, span), cigar, "".join(rng.choice("ACGTN") for _ in range(size))))
    return out


@pytest.mark.parametrize("tile", [8, 1024])
@pytest.mark.parametrize("light", [0, 1 << 22])
def test_counts_match_a_walk(spark, tile, light):
    rows = sample_rows(400)
    got = counted(pileup_counts(reads(spark, rows), tile=tile, light=light))
    assert got == dict(walk(rows)[0])


def test_one_hot_tile_holds_most_bases(spark):
    """The hot route gives the same counts as the cold one."""
    rows = sample_rows(300, span=3000) + [("s0", 50, "9M", "ACGTACGTA")] * 2000
    table = reads(spark, rows)
    assert counted(pileup_counts(table, light=0, shares=4, tile=64)) == dict(walk(rows)[0])


@pytest.mark.parametrize("n", [1, 7])
def test_partitioning_does_not_matter(spark, n):
    rows = sample_rows(200, seed=n)
    assert counted(pileup_counts(reads(spark, rows).repartition(n), tile=16)) == dict(walk(rows)[0])


def test_indels_match_a_walk(spark):
    rows = sample_rows(300, seed=5)
    ref = "".join(random.Random(9).choice("ACGT") for _ in range(260))
    tiles = tile_reference(spark.createDataFrame([("chr1", ref)], "chrom string, seq string"), 16)
    want = {}
    for (s, pos, e), n in walk(rows)[1].items():
        text = e if e[0] == "+" else "-" + ref[pos : pos + int(e[1:])]
        want[s, pos, text] = n
    got = {(r.sample, r.pos, r.indel): r.n for r in pileup_indels(reads(spark, rows), tiles, tile=16).collect()}
    assert got == want


def test_deep_positions_keep_every_base(spark):
    rows = [("s0", 10, "1M", "A")] * 500 + [("s0", 10, "1M", "C")] * 500
    r = pileup_counts(reads(spark, rows)).first()
    assert (r.depth, r.n_a, r.n_c) == (1000, 500, 500)


def test_deletions_on_unknown_contigs_are_kept(spark):
    tiles = tile_reference(spark.createDataFrame([("chr1", "ACGTA")], "chrom string, seq string"))
    rows = [("s0", 3, "2M3D2M", "AAAA")] * 2
    known = pileup_indels(reads(spark, rows), tiles).first()
    assert (known.indel, known.n) == ("-ANN", 2)
    other = tile_reference(spark.createDataFrame([("chrX", "ACGTA")], "chrom string, seq string"))
    unknown = pileup_indels(reads(spark, rows), other).first()
    assert (unknown.indel, unknown.n) == ("-NNN", 2)


def test_indels_of_segments_are_counted_apart(spark):
    tiles = tile_reference(spark.createDataFrame([("chr1", "ACGTACGTACGT")], "chrom string, seq string"))
    one = reads(spark, [("s0", 1, "2M1D2M", "ACTA")] * 3)
    both = one.withColumn("seg", F.explode(F.array(F.lit(0), F.lit(1))))
    rows = sample_calls(both, tiles, indels=True, by=("seg",)).filter("n_indels > 0").collect()
    assert [(r.seg, r.indel_total, r.cov) for r in sorted(rows, key=lambda r: r.seg)] == [(0, 3, 3), (1, 3, 3)]


def test_low_quality_and_missing_quality(spark):
    data = [("s0", "a", 0, "chr1", 1, 60, "2M", "AC", "#I"), ("s0", "b", 0, "chr1", 1, 60, "2M", "AC", "*")]
    got = counted(pileup_counts(spark.createDataFrame(data, READ)))
    assert got == {("s0", 1, "A"): 1, ("s0", 2, "C"): 2}


def test_flags_and_orphans(spark):
    flags = [0, 4, 0x100, 0x200, 0x400, 0x1, 0x3]
    data = [("s0", f"q{i}", f, "chr1", 1, 60, "1M", "A", "I") for i, f in enumerate(flags)]
    table = spark.createDataFrame(data, READ)
    assert pileup_counts(table).first().depth == 2
    assert pileup_counts(table, PileupOptions(count_orphans=True)).first().depth == 3


def test_site_past_the_contig_has_unknown_base(spark):
    tiles = tile_reference(spark.createDataFrame([("chr1", "ACG")], "chrom string, seq string"))
    got = with_ref(pileup_counts(reads(spark, [("s0", 2, "4M", "GGGG")])), tiles).orderBy("pos").collect()
    assert [r.ref for r in got] == ["C", "G", "N", "N"]


def test_no_reads_no_calls(spark):
    tiles = tile_reference(spark.createDataFrame([("chr1", "ACG")], "chrom string, seq string"))
    assert call_variants(spark.createDataFrame([], READ), tiles, ["s0"], hets=True, indels=True).count() == 0
