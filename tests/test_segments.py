"""Results by segment that a later run takes up."""

import random

import pytest

from genopile.plans import modes
from genopile.plans.modes import Run, run, run_in_segments

SCHEMA = "sample string, qname string, flag int, rname string, pos int, mapq int, cigar string, rnext string, pnext int, tlen int, seq string, qual string"


def inputs(spark, folder):
    rng = random.Random(12)
    seqs = {f"chr{i}": "".join(rng.choice("ACGT") for _ in range(900)) for i in (1, 2)}
    (folder / "ref.fa").write_text("".join(f">{n}\n{s}\n" for n, s in seqs.items()))
    rows = []
    for sample, every in (("a", 0), ("b", 60)):
        for chrom, ref in seqs.items():
            hap = "".join({"A": "C", "C": "G", "G": "T", "T": "A"}[x] if every and i % every == 7 else x for i, x in enumerate(ref))
            for i, p in enumerate(range(0, 850, 6)):
                # Reads with a wide gap touch segments far apart.
                cigar, seq = ("20M400N20M", hap[p : p + 20] + hap[p + 420 : p + 440]) if i % 10 == 0 and p < 400 else ("40M", hap[p : p + 40])
                cigar, seq = (f"{len(seq)}M", seq) if len(seq) < 40 else (cigar, seq)
                rows.append((sample, f"{sample}{chrom}{i}", 0, chrom, p + 1, 60, cigar, "*", 0, 0, seq, "I" * len(seq)))
    rows.append(("b", "far", 0, "chr9", 5, 60, "4M", "*", 0, 0, "ACGT", "IIII"))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/aln.parquet")
    return dict(paths="", alignments=f"{folder}/aln.parquet", alignment_format="parquet", reference=f"{folder}/ref.fa", hets=True)


def lines(spark, out):
    return sorted(r.value for r in spark.read.text(f"{out}/variants.txt/records").collect())


def test_a_run_that_stopped_goes_on(spark, tmp_path, monkeypatch):
    job = inputs(spark, tmp_path)
    run(spark, Run(output=f"{tmp_path}/whole", **job))
    want = lines(spark, f"{tmp_path}/whole")
    assert len(want) > 20
    calls, real, loads = [], modes.call_variants, []

    def counted(reads, *rest):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("lost")
        return real(reads, *rest)

    placed = modes._alignments
    monkeypatch.setattr(modes, "call_variants", counted)
    monkeypatch.setattr(modes, "_alignments", lambda *a: loads.append(1) or placed(*a))
    part = Run(output=f"{tmp_path}/parts", **job)
    with pytest.raises(RuntimeError, match="lost"):
        run_in_segments(spark, part, 4)
    done = len(calls) - 1
    rows = run_in_segments(spark, part, 4)
    segments = len(calls) - 1
    assert done == 2 and segments >= 5 and len(loads) == 1
    assert lines(spark, f"{tmp_path}/parts") == want and rows.count() == len(want)


def test_segments_call_whole_genomes_only(spark, tmp_path):
    with pytest.raises(ValueError):
        run_in_segments(spark, Run(paths="", reference="", output=str(tmp_path), vcf=True), 4)
