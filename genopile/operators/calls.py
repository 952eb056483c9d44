"""Site-level calls over all samples.

Input is one row per position and sample (``ref``, ``cov``, counters, ``alleles`` and, for
indels, the summary columns).  A site collects one small struct per sample, so a group is
never larger than the number of samples.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genopile.config import Cutoffs
from genopile.functions import alleles as A
from genopile.functions.dna import fixed4

KEYS = ("chrom", "tile", "pos", "seg")


def site_keys(df: DataFrame) -> list[str]:
    """Position columns; the tile is kept so that data already hashed on it stays in place."""
    return [c for c in KEYS if c in df.columns]


def site_calls(calls: DataFrame, cutoffs: Cutoffs = Cutoffs(), max_ref_freq: float | None = None) -> DataFrame:
    """Any-sample flags per site; a site without a known reference base has none."""
    known = A.callable_ref()

    def any_sample(flag: Column) -> Column:
        return F.coalesce(F.bool_or(known & flag), F.lit(False))

    flags = {
        "snp": any_sample(A.is_snp(cutoffs.min_cov, cutoffs.min_purity)),
        "het": any_sample(A.is_het(cutoffs.hets_cov, cutoffs.hets_purity)),
    }
    if "n_indels" in calls.columns:
        flags["indel"] = any_sample(A.is_indel(cutoffs.indel_cov, cutoffs.indel_purity))
    if max_ref_freq is not None:
        flags["variant"] = any_sample(A.is_variant(cutoffs.min_cov, max_ref_freq))
    return calls.groupBy(*site_keys(calls), "ref").agg(*(v.alias(c) for c, v in flags.items()))


def site_table(calls: DataFrame, fields: dict[str, Column], flags: dict[str, Column]) -> DataFrame:
    """One row per site: any-sample flags and ``obs``, a struct of ``fields`` per sample."""
    known = A.callable_ref()
    row = F.struct("sample", *(v.alias(c) for c, v in fields.items()))
    return calls.groupBy(*site_keys(calls), "ref").agg(
        F.sort_array(F.collect_list(row)).alias("obs"),
        *(F.coalesce(F.bool_or(known & v), F.lit(False)).alias(c) for c, v in flags.items()),
    )


def fill_samples(sites: DataFrame, samples: list[str], default: dict[str, Column]) -> DataFrame:
    """``obs`` with exactly one entry per sample, in the given order."""
    keyed = sites.withColumn("_by", F.map_from_entries(F.transform("obs", lambda o: F.struct(o["sample"], o))))
    names = F.array(*(F.lit(s) for s in samples))
    blank = F.struct(F.lit("").alias("sample"), *(v.alias(c) for c, v in default.items()))
    filled = F.transform(names, lambda s: F.coalesce(F.try_element_at("_by", s), blank.withField("sample", s)))
    return keyed.withColumn("obs", filled).drop("_by")


def _zero() -> Column:
    return F.lit(0).cast("bigint")


def _call_fields(cutoffs: Cutoffs, indels: bool) -> dict[str, Column]:
    fields = {
        "basecall": A.basecall(cutoffs.hets_cov, cutoffs.hets_purity),
        "cov": F.col("cov"),
        "purity": A.purity(),
    }
    if indels:
        fields |= {
            "has_indel": A.has_indel(),
            "max_indel": A.max_indel(),
            "indel_purity": A.indel_purity(),
            # Only the top indel and those at or above the display share are written, so
            # the list is short even where a site has many rare indels.
            "shown": F.filter(
                F.coalesce(F.col("indels"), F.array().cast("array<struct<n:bigint,indel:string>>")),
                lambda x: (x["indel"] == F.col("top_indel"))
                | ((F.col("cov") > 0) & (x["n"] / F.nullif(F.col("cov"), _zero()) >= cutoffs.indel_perc)),
            ),
        }
    return fields


def _blank(indels: bool) -> dict[str, Column]:
    blank = {"basecall": F.lit("."), "cov": _zero(), "purity": F.lit(0.0)}
    if indels:
        blank |= {
            "has_indel": F.lit(False),
            "max_indel": F.lit(""),
            "indel_purity": F.lit(0.0),
            "shown": F.array().cast("array<struct<n:bigint,indel:string>>"),
        }
    return blank


def called_sites(
    calls: DataFrame,
    samples: list[str],
    cutoffs: Cutoffs = Cutoffs(),
    hets: bool = False,
    indels: bool = False,
) -> DataFrame:
    """Called sites: ``chrom, pos, type, ref, obs``.

    A site gives a SNP row, or else a HET row (with ``hets``), and besides an indel row
    (with ``indels``).  ``obs`` has an entry ``(sample, basecall, cov, purity)`` for every
    sample.
    """
    flags = {
        "snp": A.is_snp(cutoffs.min_cov, cutoffs.min_purity),
        "het": A.is_het(cutoffs.hets_cov, cutoffs.hets_purity) if hets else F.lit(False),
        "ind": A.is_indel(cutoffs.indel_cov, cutoffs.indel_purity) if indels else F.lit(False),
    }
    sites = site_table(calls, _call_fields(cutoffs, indels), flags)
    called = fill_samples(sites.filter(F.col("snp") | F.col("het") | F.col("ind")), samples, _blank(indels))
    base_type = F.when(F.col("snp"), "SNP").when(F.col("het"), "HET")
    base_row = F.struct(base_type.alias("type"), F.col("ref"), _base_obs(F.col("obs")).alias("obs"))
    rows = F.when(base_type.isNotNull(), base_row)
    if indels:
        called = called.withColumn("longest", _longest(F.col("obs")))
        indel_row = F.struct(
            _indel_type(F.col("obs")).alias("type"),
            F.concat("ref", "longest").alias("ref"),
            _indel_obs(F.col("obs")).alias("obs"),
        )
        rows = F.array(rows, F.when(F.col("ind"), indel_row))
    else:
        rows = F.array(rows)
    flat = called.select("chrom", "pos", F.explode(F.array_compact(rows)).alias("row"))
    return flat.select("chrom", "pos", "row.type", "row.ref", "row.obs")


def _base_obs(obs: Column) -> Column:
    return F.transform(obs, lambda o: F.struct(o["sample"], o["basecall"], o["cov"], o["purity"]))


def _longest(obs: Column) -> Column:
    """Longest deletion over the samples; the first sample's on equal length."""
    return F.aggregate(
        obs,
        F.lit(""),
        lambda best, o: F.when(F.length(o["max_indel"]) > F.length(best), o["max_indel"]).otherwise(best),
    )


def _indel_type(obs: Column) -> Column:
    dels = F.exists(obs, lambda o: o["has_indel"] & (o["max_indel"] != ""))
    ins = F.exists(obs, lambda o: o["has_indel"] & (o["max_indel"] == ""))
    return F.when(dels & ins, "IND").when(dels, "DEL").otherwise("INS")


def _indel_obs(obs: Column) -> Column:
    """Alleles re-anchored on ``ref + longest``: an insertion follows the reference base, a
    deletion takes its length off the longest one."""

    def allele(x: Column) -> Column:
        text = F.substr(x["indel"], F.lit(2))
        rest = F.substr(F.col("longest"), F.length(text) + 1)
        return F.concat("ref", F.when(F.left(x["indel"], F.lit(1)) == "+", text).otherwise(rest))

    def row(o: Column) -> Column:
        alleles = F.array_join(F.transform(o["shown"], allele), ",")
        return F.struct(
            o["sample"],
            F.when(o["has_indel"], alleles).otherwise(F.concat("ref", "longest")).alias("basecall"),
            o["cov"],
            F.when(o["has_indel"], o["indel_purity"]).otherwise(o["purity"]).alias("purity"),
        )

    return F.transform(obs, row)


def indel_types(calls: DataFrame) -> DataFrame:
    """Indel class and longest deletion of every site that has an indel."""
    fields = {"has_indel": A.has_indel(), "max_indel": A.max_indel()}
    sites = site_table(calls, fields, {"any_indel": A.has_indel()})
    return sites.filter(F.exists("obs", lambda o: o["has_indel"])).select(
        "chrom", "pos", _indel_type(F.col("obs")).alias("type"), _longest(F.col("obs")).alias("max_indel")
    )


def long_rows(sites: DataFrame) -> DataFrame:
    """One row per site, type and sample."""
    rows = sites.select("chrom", "pos", "type", "ref", F.explode("obs").alias("o"))
    return rows.select("chrom", "pos", "type", "ref", "o.*")


def site_samples(calls: DataFrame, samples: list[str], complete: bool = False) -> DataFrame:
    """Every covered site with every sample; absent samples have depth zero.

    Where the rows are ``complete``, with each sample at each site, as the pileup gives them on demand,
    nothing has to be grouped.
    """
    if complete:
        rows = calls.select("chrom", "pos", "ref", "sample", "cov", A.purity().alias("purity"), A.major().alias("major"))
        return rows.filter(F.col("sample").isin(samples))
    fields = {"cov": F.col("cov"), "purity": A.purity(), "major": A.major()}
    blank = {"cov": _zero(), "purity": F.lit(0.0), "major": F.lit(".")}
    sites = fill_samples(site_table(calls, fields, {}), samples, blank)
    return sites.select("chrom", "pos", "ref", F.explode("obs").alias("o")).select("chrom", "pos", "ref", "o.*")


def bsa_rows(calls: DataFrame, samples: list[str], min_cov: int, max_ref_freq: float) -> DataFrame:
    """Bulk-segregant rows of variant sites: basecall, depth, reference share and A,C,G,T."""
    fields = {
        "basecall": A.basecall_all(),
        "cov": F.col("cov"),
        "ref_freq": A.ref_freq(),
        "acgt": A.acgt_text(),
    }
    blank = {"basecall": F.lit("."), "cov": _zero(), "ref_freq": F.lit(0.0), "acgt": F.lit("0,0,0,0")}
    sites = site_table(calls, fields, {"variant": A.is_variant(min_cov, max_ref_freq)})
    filled = fill_samples(sites.filter("variant"), samples, blank)
    return filled.select("chrom", "pos", F.lit("BSA").alias("type"), "ref", F.explode("obs").alias("o")).select(
        "chrom", "pos", "type", "ref", "o.*"
    )


def matrix(sites: DataFrame, samples: list[str]) -> DataFrame:
    """The genotype matrix: four key columns, then three per sample.

    The entries are already in sample order, so no pivot and no further shuffle is needed.
    """
    columns = []
    for i, name in enumerate(samples):
        o = F.get("obs", F.lit(i))
        purity = F.when(F.col("type") == "UNK", "0.0").otherwise(fixed4(o["purity"]))
        columns += [
            o["basecall"].alias(f"{name}_BASECALL"),
            o["cov"].alias(f"{name}_COV"),
            purity.alias(f"{name}_PURITY"),
        ]
    return sites.select(
        F.col("chrom").alias("CHR"),
        F.col("pos").alias("COORDINATE"),
        F.col("type").alias("TYPE"),
        F.col("ref").alias("REFBASE"),
        *columns,
    )
