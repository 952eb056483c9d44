"""Allele counters from pileup text rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genopile.functions.alleles import COUNTERS, with_alleles
from genopile.functions.once import with_once
from genopile.functions.pileup_text import count_of, single_bases
from genopile.operators.indels import attach_indels, indel_summary, text_indels


def parse_pileup(rows: DataFrame) -> DataFrame:
    """``(chrom, pos, ref, sample, depth, bases)`` to counters; a row never leaves its task.

    ``.`` and ``,`` count for the reference letter, ``*`` is a deleted base; characters
    that are no base only count in the depth.  A row of depth zero has no bases.
    """
    text = F.when(F.col("depth") > 0, single_bases(F.col("bases"))).otherwise("")
    read = with_once(rows, {"_text": text})
    same = count_of(F.col("_text"), ".,")
    counts = {}
    for letter, counter in COUNTERS.items():
        direct = count_of(F.col("_text"), "*" if letter == "-" else letter)
        as_ref = F.when(F.upper("ref") == letter, same).otherwise(F.lit(0).cast("bigint"))
        counts[counter] = direct if letter == "-" else direct + as_ref
    return with_once(read, counts).withColumnRenamed("depth", "cov").drop("_text", "bases", "quals")


def text_calls(rows: DataFrame, indels: bool = False) -> DataFrame:
    """Per-sample rows ready for the calling expressions."""
    calls = with_alleles(parse_pileup(rows))
    if not indels:
        return calls
    return attach_indels(calls, indel_summary(text_indels(rows)))
