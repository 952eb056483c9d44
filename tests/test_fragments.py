"""Overlapping mates count once."""

import random
from collections import Counter

import pytest

from genopile.config import PileupOptions
from genopile.operators.pileup import pileup_counts

SCHEMA = "sample string, qname string, flag int, rname string, pos int, mapq int, cigar string, seq string, qual string"


def plain(rows, least=13):
    """Depth and base counts with the best base of every fragment and position."""
    seen = {}
    for sample, name, flag, chrom, pos, _, cigar, seq, qual in rows:
        at, i = pos, 0
        for count, op in ((int(c[:-1]), c[-1]) for c in cigar.replace("M", "M ").replace("D", "D ").replace("I", "I ").split()):
            for _ in range(count):
                if op in "MD":
                    base, q = (seq[i], ord(qual[i]) - 33) if op == "M" else ("*", ord(qual[i]) - 33)
                    mate = flag & 0xC0
                    key = (sample, chrom, at, name if mate else (name, len(seen)))
                    if q >= least:
                        seen[key] = max(seen.get(key, (-1, False, "")), (q, mate == 0x40, base))
                    at += 1
                i += op in "MI"
    return Counter((sample, chrom, at, base) for (sample, chrom, at, _), (_, _, base) in seen.items())


def counts(frame):
    out = Counter()
    for r in frame.collect():
        assert r.depth == sum(r[c] for c in ("n_a", "n_c", "n_g", "n_t", "n_n", "n_del"))
        for base, c in zip("ACGT*", ("n_a", "n_c", "n_g", "n_t", "n_del")):
            if r[c]:
                out[r.sample, r.chrom, r.pos, base] = r[c]
    return out


def drawn(n, seed):
    r = random.Random(seed)
    draw = lambda k: "".join(r.choice("ACGT") for _ in range(k))
    rows = []
    for i in range(n):
        pos, size = r.randrange(1, 200), 30
        quals = lambda k: "".join(chr(33 + r.choice([5, 20, 30, 40])) for _ in range(k))
        other = pos + r.randrange(0, 60)
        sample = r.choice(["s0", "s1"])
        rows.append((sample, f"f{i}", 0x1 | 0x2 | 0x40, "chr1", pos, 60, "30M", draw(size), quals(size)))
        if r.random() < 0.8:
            rows.append((sample, f"f{i}", 0x1 | 0x2 | 0x80, "chr1", other, 60, "10M3D10M2I8M", draw(30), quals(30)))
        if r.random() < 0.3:
            rows.append((sample, f"f{i}", 0, "chr1", pos, 60, "30M", draw(size), quals(size)))
    return [x for x in rows if x[2]] + [(s, f"lone{j}", 0, *rest) for j, (s, _, f, *rest) in enumerate(rows) if not f]


@pytest.mark.parametrize("shares,light", [(4096, 1 << 20), (4, 1)])
def test_pairs_count_once_where_they_overlap(spark, shares, light):
    rows = drawn(150, 3)
    frame = spark.createDataFrame(rows, SCHEMA)
    once = pileup_counts(frame, PileupOptions(one_per_fragment=True), tile=64, shares=shares, light=light)
    assert counts(once) == plain(rows)
    twice = pileup_counts(frame, PileupOptions(), tile=64)
    assert sum(counts(twice).values()) > sum(counts(once).values())


def test_the_better_base_counts(spark):
    rows = [
        ("s", "f", 0x43, "c", 10, 60, "3M", "AAA", "I5I"),
        ("s", "f", 0x83, "c", 11, 60, "3M", "CCC", "IIA"),
        ("s", "g", 0x43, "c", 10, 60, "3M", "GGG", "III"),
    ]
    got = {r.pos: (r.depth, r.n_a, r.n_c, r.n_g) for r in pileup_counts(spark.createDataFrame(rows, SCHEMA), PileupOptions(one_per_fragment=True)).collect()}
    assert got == {10: (2, 1, 0, 1), 11: (2, 0, 1, 1), 12: (2, 1, 0, 1), 13: (1, 0, 1, 0)}
