"""Ordering and deduplication of calls that several segments report.

Duplicates are resolved by aggregates, not by ranking windows: partial aggregation shrinks
a large group of copies before anything is shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_samples(*tables: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def merged_order(rows: DataFrame, contigs: DataFrame) -> DataFrame:
    """Genome order, then type; calls on contigs that the dictionary lacks come last, by name."""
    lookup = contigs.select("chrom", "chrom_ord")
    placed = rows.join(lookup, "chrom", "left")
    return placed.orderBy(F.col("chrom_ord").asc_nulls_last(), "chrom", "pos", "type").drop("chrom_ord")


def exact_dedupe(rows: DataFrame) -> DataFrame:
    return rows.dropDuplicates()


def merge_calls(sites: DataFrame) -> DataFrame:
    """Of each ``(chrom, pos, type)`` the row with the highest total coverage.

    Equal coverage is settled by the reference text and the entries themselves.
    """
    total = F.aggregate("obs", F.lit(0).cast("bigint"), lambda n, o: n + o["cov"])
    return _keep_best(sites, ["chrom", "pos", "type"], total, ["ref", "obs"])


def merge_vcf(rows: DataFrame) -> DataFrame:
    """Of each ``(CHROM, POS, REF, ALT)`` the row with the highest depth in INFO."""
    depth = F.regexp_extract("INFO", r"DP=(\d+)", 1).try_cast("bigint")
    rest = [c for c in rows.columns if c not in ("CHROM", "POS", "REF", "ALT")]
    best = _keep_best(rows, ["CHROM", "POS", "REF", "ALT"], F.coalesce(depth, F.lit(0)), rest)
    return best.select(*rows.columns)


def _keep_best(rows: DataFrame, keys: list[str], rank: Column, rest: list[str]) -> DataFrame:
    row = F.struct(rank.alias("_rank"), *rest)
    best = rows.groupBy(*keys).agg(F.max(row).alias("_best"))
    return best.select(*keys, *(F.col(f"_best.{c}").alias(c) for c in rest))
