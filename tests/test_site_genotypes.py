"""Genotypes over all alleles of a site against plain code, read by read."""

import itertools
import math
import random

import numpy as np

from genopile.operators.genome import tile_reference
from genopile.operators.genotype import allele_frequencies, site_vcf_rows, with_quality
from genopile.plans.modes import joint_sites_call

SCHEMA = "sample string, qname string, flag int, rname string, pos int, mapq int, cigar string, seq string, qual string"


def pairs_of(k):
    return [(i, j) for j in range(k) for i in range(j + 1)]


def costs(reads, alleles):
    """Phred-scaled costs of every pair of alleles from (base, quality) of all reads."""
    out = []
    for i, j in pairs_of(len(alleles)):
        total = 0
        for base, q in reads:
            if base not in alleles:
                continue
            right = round(-10000 * math.log10(1 - 10 ** (-q / 10)))
            if base in (alleles[i], alleles[j]):
                total += right if i == j else 3010
            else:
                total += q * 1000
        out.append((total + 500) // 1000)
    return [c - min(out) for c in out]


def likelihood(pl, f):
    """Log10 likelihood of all samples, pair by pair."""
    total = 0.0
    for row in pl:
        if any(row):
            total += math.log10(sum(f[i] * f[j] * (1 if i == j else 2) * 10 ** (-c / 10) for (i, j), c in zip(pairs_of(len(f)), row)))
    return total


def test_sites_of_three_alleles(spark):
    rng = random.Random(8)
    samples = [f"s{i}" for i in range(5)]
    genotypes = {2: ["GG", "GG", "GA", "AC", "CC"], 4: ["TT", "TA", "TT", "AA", "TT"], 6: ["CC"] * 5}
    rows, want = [], {}
    for pos, all_of in genotypes.items():
        for sample, g in zip(samples, all_of):
            reads = [(g[i % 2], rng.choice([20, 30, 37])) for i in range(rng.randrange(10, 16))]
            rows += [(sample, f"{sample}.{pos}.{i}", 0, "chr1", pos, 60, "1M", b, chr(q + 33)) for i, (b, q) in enumerate(reads)]
            want[pos, sample] = reads
    tiles = tile_reference(spark.createDataFrame([("chr1", "AGATACA")], "chrom string, seq string"))
    found = joint_sites_call(spark.createDataFrame(rows, SCHEMA), tiles, [*samples, "none"], hets=True)
    sites = {r.pos: r for r in with_quality(found).collect()}
    assert {p: (r.ref, r.alts) for p, r in sites.items()} == {2: ("G", ["A", "C"]), 4: ("T", ["A"])}
    for pos, r in sites.items():
        alleles = [r.ref, *r.alts]
        names = [f"{i}/{j}" for i, j in pairs_of(len(alleles))]
        for o in r.obs:
            if o.sample == "none":
                assert (o.gt, o.cov, set(o.pl)) == ("./.", 0, {0}) and len(o.pl) == len(names)
                continue
            assert list(o.pl) == costs(want[pos, o.sample], alleles)
            truth = sorted(alleles.index(b) for b in genotypes[pos][samples.index(o.sample)])
            assert o.gt == "/".join(map(str, truth)) == names[o.pl.index(0)]
        pl = [list(o.pl) for o in r.obs]
        f, quality = allele_frequencies(np.array(pl, float))
        assert r.qual == round(quality, 1) > 30 and list(r.af) == [round(x, 4) for x in f[1:]]
        assert abs(quality - 10 * (likelihood(pl, f) - likelihood(pl, [1.0] + [0.0] * len(r.alts)))) < 1e-6
    lines = {r.POS: r for r in site_vcf_rows(with_quality(found), [*samples, "none"]).collect()}
    assert lines[2].ALT == "A,C" and lines[2].s3.startswith("1/2:") and lines[2].none == "./.:0,0,0,0,0,0:0"
    assert lines[2].INFO.startswith("DP=") and lines[2].INFO.count(",") == 1 and float(lines[2].QUAL) == sites[2].qual


def test_frequencies_are_the_most_likely_ones():
    rng = np.random.default_rng(4)
    for k, n in itertools.product((2, 3), (1, 3, 9)):
        pl = rng.integers(0, 60, (n, k * (k + 1) // 2)).astype(float)
        pl -= pl.min(1, keepdims=True)
        f, quality = allele_frequencies(pl)
        top = likelihood(pl, f)
        assert abs(f.sum() - 1) < 1e-9 and quality >= 0
        for _ in range(300):
            near = np.abs(f + rng.normal(0, 0.05, k))
            assert likelihood(pl, near / near.sum()) <= top + 1e-5


def test_samples_without_reads_say_nothing():
    f, quality = allele_frequencies(np.zeros((3, 3)))
    assert f.tolist() == [0.5, 0.5] and quality == 0.0
    one = allele_frequencies(np.array([[90.0, 20.0, 0.0]]))
    both = allele_frequencies(np.array([[90.0, 20.0, 0.0], [0.0, 0.0, 0.0]]))
    assert np.allclose(one[0], both[0]) and abs(one[1] - both[1]) < 1e-9
