"""Diploid genotype likelihoods from base qualities.

Model: Li 2011, Bioinformatics 27:2987, two alleles.  A base that equals one allele costs
``-10 log10(1 - e)`` under its own homozygote, ``e`` in Phred units under the other, and
``10 log10 2`` under the heterozygote.  Bases of neither allele cost the same under every
genotype and cancel.  Costs are whole numbers, summed by the pileup itself.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from genopile.functions.dna import fixed4
from genopile.functions.once import with_once
from genopile.operators.calls import fill_samples, site_keys
from genopile.operators.pileup import PHRED_UNITS

# Fixed value: 10 log10(2) in 1/1000 Phred.
_HALF = 3010


def _pick(letter: str, kind: str) -> Column:
    """The counter ``kind_<base>`` of the base named by a column; 0 for any other letter."""
    counters = F.array(*(F.col(f"{kind}_{b}") for b in "acgt"))
    at = F.instr(F.lit("ACGT"), F.upper(letter)) - 1
    return F.coalesce(F.get(counters, at), F.lit(0).cast("bigint"))


def _with_alt(df: DataFrame, counts: dict[str, Column]) -> DataFrame:
    """Add ``alt``: the most frequent base other than the reference (larger letter on a tie).

    It is null where no other base occurs.
    """
    none = F.lit(0).cast("bigint")
    entries = [
        F.struct(F.when(F.upper("ref") == b, none).otherwise(n).alias("n"), F.lit(b).alias("base"))
        for b, n in counts.items()
    ]
    top = with_once(df, {"_top": F.greatest(*entries)})
    return with_once(top, {"alt": F.when(F.col("_top.n") > 0, F.col("_top.base"))}).drop("_top")


def _likelihoods(df: DataFrame) -> DataFrame:
    """``pl_rr, pl_ra, pl_aa`` for columns ``ref`` and ``alt``; the best one is zero."""
    n = {k: _pick(k, "n") for k in ("ref", "alt")}
    costs = {
        "rr": _pick("ref", "ok") + _pick("alt", "err"),
        "ra": (n["ref"] + n["alt"]) * _HALF,
        "aa": _pick("ref", "err") + _pick("alt", "ok"),
    }
    phred = {g: F.floor((c + PHRED_UNITS // 2) / PHRED_UNITS).cast("bigint") for g, c in costs.items()}
    raw = with_once(df, {f"_{g}": c for g, c in phred.items()})
    best = F.least("_rr", "_ra", "_aa")
    return with_once(raw, {f"pl_{g}": F.col(f"_{g}") - best for g in costs}).drop(*(f"_{g}" for g in costs))


def genotype_text() -> Column:
    """Genotype of least cost; the one with fewer alternates on a tie."""
    no_data = (F.col("pl_rr") == 0) & (F.col("pl_ra") == 0) & (F.col("pl_aa") == 0)
    return (
        F.when(no_data, "./.")
        .when(F.col("pl_rr") == 0, "0/0")
        .when(F.col("pl_ra") == 0, "0/1")
        .otherwise("1/1")
    )


def genotype_likelihood(counts: DataFrame) -> DataFrame:
    """Per sample and position, against the sample's own most frequent alternate base.

    Positions where the sample has only the reference base, or whose reference base is
    unknown, have no alternate and no row.
    """
    known = counts.filter(F.upper("ref").isin(*"ACGT"))
    known = _with_alt(known, {b: F.col(f"n_{b.lower()}") for b in "ACGT"}).filter(F.col("alt").isNotNull())
    return _likelihoods(known).withColumn("gt", genotype_text()).select(
        *site_keys(counts), "ref", "alt", "sample", "cov", "pl_rr", "pl_ra", "pl_aa", "gt"
    )


def genotypes(counts: DataFrame) -> DataFrame:
    """Per-sample variant genotypes."""
    return genotype_likelihood(counts).filter(F.col("gt").isin("0/1", "1/1"))


def union_positions(variants: DataFrame, hets: bool = False) -> DataFrame:
    """Distinct positions of the samples' variants; only homozygous ones unless ``hets``."""
    kept = variants if hets else variants.filter(F.col("gt") == "1/1")
    return kept.select(*site_keys(variants)).distinct()


def called_alternates(variants: DataFrame, hets: bool = False) -> DataFrame:
    """Distinct alternates that some sample is called with; only homozygous ones unless ``hets``."""
    kept = variants if hets else variants.filter(F.col("gt") == "1/1")
    return kept.select(*site_keys(variants), "alt").distinct()


def joint_sites(counts: DataFrame, alternates: DataFrame, samples: list[str]) -> DataFrame:
    """All samples against every called alternate: a site has one row per alternate.

    ``chrom, pos, ref, alt, obs`` with an entry ``(sample, gt, pl_rr, pl_ra, pl_aa, cov)``
    for every sample.  A site has at most three alternates, so rows stay few.
    """
    keys = [c for c in site_keys(counts) if c in alternates.columns]
    at = counts.join(alternates.select(*keys, "alt"), keys)
    scored = _likelihoods(at).withColumn("gt", genotype_text())
    entry = F.struct("sample", "gt", "pl_rr", "pl_ra", "pl_aa", "cov")
    back = scored.groupBy(*site_keys(at), "ref", "alt").agg(F.sort_array(F.collect_list(entry)).alias("obs"))
    zero = F.lit(0).cast("bigint")
    blank = {"gt": F.lit("./."), "pl_rr": zero, "pl_ra": zero, "pl_aa": zero, "cov": zero}
    return fill_samples(back, samples, blank)


def joint_rows(sites: DataFrame) -> DataFrame:
    return sites.select("chrom", "pos", "ref", "alt", F.explode("obs").alias("o")).select(
        "chrom", "pos", "ref", "alt", "o.*"
    )


def vcf_rows(sites: DataFrame, samples: list[str]) -> DataFrame:
    """The nine fixed VCF columns, then ``GT:PL:DP`` per sample."""
    depth = F.aggregate("obs", F.lit(0).cast("bigint"), lambda total, o: total + o["cov"])

    def cell(o: Column) -> Column:
        pls = F.concat_ws(",", *(o[p].cast("string") for p in ("pl_rr", "pl_ra", "pl_aa")))
        return F.concat_ws(":", o["gt"], pls, o["cov"].cast("string"))

    dot = F.lit(".")
    return sites.select(
        F.col("chrom").alias("CHROM"),
        F.col("pos").alias("POS"),
        dot.alias("ID"),
        F.col("ref").alias("REF"),
        F.col("alt").alias("ALT"),
        dot.alias("QUAL"),
        dot.alias("FILTER"),
        F.concat(F.lit("DP="), depth).alias("INFO"),
        F.lit("GT:PL:DP").alias("FORMAT"),
        *(cell(F.get("obs", F.lit(i))).alias(name) for i, name in enumerate(samples)),
    )


# All alleles of a site at once ---------------------------------------------------------


def _of_alleles(kind: str) -> Column:
    """The counters of ``alleles``, in their order."""
    counters = F.array(*(F.col(f"{kind}_{b}") for b in "acgt"))
    return F.transform("alleles", lambda a: F.coalesce(F.get(counters, F.instr(F.lit("ACGT"), a) - 1), F.lit(0).cast("bigint")))


def _pairs(of) -> Column:
    """``of(i, j)`` for all pairs of alleles ``i <= j``, in the order of VCF."""
    last = F.size("alleles") - 1
    rows = F.transform(
        F.sequence(F.lit(0), last), lambda j: F.transform(F.sequence(F.lit(0), j), lambda i: of(i, j))
    )
    return F.flatten(rows)


def site_genotypes(counts: DataFrame, alternates: DataFrame, samples: list[str]) -> DataFrame:
    """All samples against all called alleles: one row a site.

    ``chrom, pos, ref, alts, obs`` with an entry ``(sample, gt, pl, cov)`` for every sample; ``pl`` has
    a cost for every pair of alleles in the order of VCF, the best one zero.  A base costs as in
    the model of two alleles: under a pair that holds it 10 log10 2, under its own homozygote
    its chance to be right, else its chance to be wrong.  Of equal costs the genotype with fewer
    alternates is called, then the earlier one; none where all cost the same.
    """
    keys = [c for c in site_keys(counts) if c in alternates.columns]
    found = alternates.groupBy(*keys).agg(F.array_sort(F.collect_set("alt")).alias("alts"))
    at = counts.join(found, keys)
    listed = with_once(at, {"alleles": F.concat(F.array(F.upper("ref")), F.col("alts"))})
    counted = with_once(listed, {f"_{k}": _of_alleles(k) for k in ("n", "ok", "err")})
    zero = F.lit(0).cast("bigint")
    wrong = with_once(counted, {"_all": F.aggregate("_err", zero, lambda s, x: s + x)})

    def cost(i: Column, j: Column) -> Column:
        err = lambda x: F.get("_err", x)
        one = F.get("_ok", i) + F.col("_all") - err(i)
        two = (F.get("_n", i) + F.get("_n", j)) * _HALF + F.col("_all") - err(i) - err(j)
        return F.floor((F.when(i == j, one).otherwise(two) + PHRED_UNITS // 2) / PHRED_UNITS).cast("bigint")

    costs = with_once(wrong, {"_costs": _pairs(cost)})
    scored = with_once(costs, {"pl": F.transform("_costs", lambda c: c - F.array_min("_costs"))})
    names = _pairs(lambda i, j: F.concat_ws("/", i.cast("string"), j.cast("string")))
    ranks = _pairs(lambda i, j: (i > 0).cast("int") + (j > 0).cast("int"))
    entries = F.transform("pl", lambda p, x: F.struct(p.alias("p"), F.get(ranks, x).alias("rank"), x.alias("x")))
    best = F.get(names, F.array_min(entries)["x"])
    unknown = F.aggregate("pl", zero, lambda s, x: s + x) == 0
    called = scored.withColumn("gt", F.when(unknown, "./.").otherwise(best))
    entry = F.struct("sample", "gt", "pl", "cov")
    back = called.groupBy(*site_keys(at), "ref", "alts").agg(F.sort_array(F.collect_list(entry)).alias("obs"))
    k = F.size("alts") + 1
    blank = {"gt": F.lit("./."), "pl": F.array_repeat(zero, (k * (k + 1) / 2).cast("int")), "cov": zero}
    return fill_samples(back, samples, blank)


def site_rows(sites: DataFrame) -> DataFrame:
    """One row per site and sample, alternates and costs as text."""
    return sites.select("chrom", "pos", "ref", F.array_join("alts", ",").alias("alt"), F.explode("obs").alias("o")).select(
        "chrom", "pos", "ref", "alt", "o.sample", "o.gt", F.array_join("o.pl", ",").alias("pl"), "o.cov"
    )


def allele_frequencies(pl: np.ndarray, tolerance: float = 1e-9, most: int = 10_000) -> tuple[np.ndarray, float]:
    """Frequencies of the alleles over samples by expectation-maximisation, and the site's quality.

    ``pl`` has a row a sample and a column a pair of alleles.  Genotypes are drawn from the
    frequencies independently; from equal ones each step counts the alleles expected given the
    costs.  The quality is the Phred-scaled likelihood ratio of the reference alone to these
    frequencies; samples without reads say nothing of either.
    """
    k = int((math.isqrt(8 * pl.shape[1] + 1) - 1) // 2)
    first, second = np.array([(i, j) for j in range(k) for i in range(j + 1)]).T
    held = np.eye(k)[first] + np.eye(k)[second]
    likely = 10.0 ** (-pl[pl.any(1)] / 10.0)
    f = np.full(k, 1.0 / k)
    for _ in range(most if len(likely) else 0):
        weight = likely * (f[first] * f[second] * np.where(first == second, 1, 2))
        share = weight / weight.sum(1, keepdims=True)
        new = (share @ held).sum(0) / (2 * len(likely))
        done = np.abs(new - f).sum() <= tolerance
        f = new
        if done:
            break
    both = (likely * (f[first] * f[second] * np.where(first == second, 1, 2))).sum(1)
    ratio = float((np.log10(both) - np.log10(np.maximum(likely[:, 0], 1e-300))).sum()) if len(likely) else 0.0
    return f, max(0.0, 10.0 * ratio)


def with_quality(sites: DataFrame) -> DataFrame:
    """Add ``qual`` (one decimal) and ``af``, the frequency of every alternate (four decimals)."""
    keys = [*site_keys(sites), "ref"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [allele_frequencies(np.array([o["pl"] for o in obs], np.float64)) for obs in batch.column("obs").to_pylist()]
            added = {
                "qual": pa.array([round(q, 1) for _, q in found], pa.float64()),
                "af": pa.array([[round(float(x), 4) for x in f[1:]] for f, _ in found], pa.list_(pa.float64())),
            }
            yield pa.RecordBatch.from_arrays([*batch.columns, *added.values()], names=[*batch.schema.names, *added])

    shaped = sites.select(*keys, "alts", "obs")
    schema = T.StructType([*shaped.schema.fields]).add("qual", "double").add("af", T.ArrayType(T.DoubleType()))
    return shaped.mapInArrow(run, schema)


def site_vcf_rows(sites: DataFrame, samples: list[str]) -> DataFrame:
    """The nine fixed VCF columns with quality and frequencies, then ``GT:PL:DP`` per sample."""
    depth = F.aggregate("obs", F.lit(0).cast("bigint"), lambda total, o: total + o["cov"])
    shares = F.array_join(F.transform("af", lambda x: fixed4(x)), ",")

    def cell(o: Column) -> Column:
        return F.concat_ws(":", o["gt"], F.array_join(o["pl"], ","), o["cov"].cast("string"))

    dot = F.lit(".")
    return sites.select(
        F.col("chrom").alias("CHROM"),
        F.col("pos").alias("POS"),
        dot.alias("ID"),
        F.col("ref").alias("REF"),
        F.array_join("alts", ",").alias("ALT"),
        F.format_string("%.1f", "qual").alias("QUAL"),
        dot.alias("FILTER"),
        F.concat(F.lit("DP="), depth, F.lit(";AF="), shares).alias("INFO"),
        F.lit("GT:PL:DP").alias("FORMAT"),
        *(cell(F.get("obs", F.lit(i))).alias(name) for i, name in enumerate(samples)),
    )
