"""Genotypes at given positions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genopile.config import TILE
from genopile.functions import alleles as A
from genopile.operators.calls import fill_samples, site_table
from genopile.operators.genome import ref_bases
from genopile.operators.reads import at_positions


def snarp(
    calls: DataFrame, positions: DataFrame, tiles: DataFrame, samples: list[str], tile: int = TILE
) -> DataFrame:
    """One row per distinct listed position: ``chrom, pos, type, ref, obs``.

    A position with pileup is typed ``SNP`` and shows all alleles; one without is ``UNK``
    with the reference base, or ``N`` where the reference has none.
    """
    wanted = positions.select("chrom", "pos").distinct()
    fields = {"basecall": A.basecall_all(), "cov": F.col("cov"), "purity": A.purity()}
    blank = {"basecall": F.lit("."), "cov": F.lit(0).cast("bigint"), "purity": F.lit(0.0)}
    sites = site_table(at_positions(calls, wanted), fields, {})
    joined = ref_bases(wanted, tiles, tile).withColumnRenamed("ref", "known_ref").join(
        sites.select("chrom", "pos", "ref", "obs"), ["chrom", "pos"], "left"
    )
    rows = joined.select(
        "chrom",
        "pos",
        F.when(F.col("obs").isNull(), "UNK").otherwise("SNP").alias("type"),
        F.coalesce("ref", "known_ref").alias("ref"),
        F.coalesce("obs", F.array().cast(sites.schema["obs"].dataType)).alias("obs"),
    )
    return fill_samples(rows, samples, blank)
