"""Column expressions on sequence text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def reverse_complement(seq: Column) -> Column:
    return F.translate(F.reverse(seq), "ACGTacgt", "TGCAtgca")


def chrom_number(name: Column) -> Column:
    """First digit run of a contig name; null when there is none."""
    digits = F.regexp_extract(name, r"\d+", 0)
    return F.when(digits != "", digits).try_cast("bigint")


def fixed4(x: Column) -> Column:
    """Text of a value in [0, 1] with four decimals, exact ties to even.

    Doubles are binary, so a tie is decided on the double's exact value.  The value is split
    into a high part of 26 bits and the rest; both products with 10000 are then exact.
    """
    high = F.floor(x * (1 << 26)) / F.lit(float(1 << 26))
    low = x - high
    base = F.floor(x * 10000)
    past_half = (high * 10000 - base - 0.5) + low * 10000
    up = (past_half > 0) | ((past_half == 0) & (base % 2 == 1))
    return F.format_string("%.4f", (base + up.cast("int")) / F.lit(10000.0))
