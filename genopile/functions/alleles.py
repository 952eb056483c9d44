"""Column expressions on the allele counts of one sample at one position.

The expressions read the columns ``ref``, ``cov``, ``n_a n_c n_g n_t n_n n_del`` and those
of :func:`with_alleles`, and for indels the columns that
``operators.indels.attach_indels`` adds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genopile.config import MIN_FREQ
from genopile.functions.once import with_once

# The allele alphabet and the counter column of each letter.
COUNTERS = {"A": "n_a", "C": "n_c", "G": "n_g", "T": "n_t", "N": "n_n", "-": "n_del"}


def with_alleles(df: DataFrame) -> DataFrame:
    """Add the allele table and what is read from it most.

    ``alleles`` has six ``(n, allele)`` entries, highest count (then letter) first.  A depth
    without any counted allele is no coverage.  ``major`` is the top allele; on a tie with
    the reference the other one.  ``purity`` is the share of the top allele.
    """
    counted = sum((F.col(c) for c in COUNTERS.values()), F.lit(0))
    # Count and letter in one number, sorted as plain numbers; an unknown count sorts below zero.
    code = F.array(*(-(F.coalesce(F.col(c), F.lit(-1)) * 256 + ord(a)) for a, c in COUNTERS.items()))
    # Most samples of a site may have no base: their table is a constant.
    empty = sorted(COUNTERS, reverse=True)
    coded = with_once(df, {"_counted": counted, "_code": F.when(counted.isNull() | (counted != 0), F.sort_array(code))})
    bare = F.array(*(F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(a).alias("allele")) for a in empty))
    sorted_ = with_once(
        coded,
        {
            "alleles": F.when(F.col("_code").isNull(), bare).otherwise(F.array(*(_entry(i) for i in range(len(empty))))),
            "cov": F.when(F.col("_counted") > 0, F.col("cov")).otherwise(F.lit(0).cast("bigint")),
        },
    ).drop("_counted", "_code")
    tie = (_n(1) > 0) & (_n(0) == _n(1)) & (_allele(0) == _ref())
    top = F.when(tie, _allele(1)).otherwise(_allele(0))
    second = F.when(tie, _allele(0)).otherwise(_allele(1))
    return with_once(
        sorted_,
        {
            "major": F.when(covered(), top).otherwise("."),
            "minor": F.when(covered() & (_n(1) > 0), second).otherwise(""),
            "purity": _share(_n(0)),
        },
    )


def _entry(i: int) -> Column:
    """An entry of the allele table from its number, see :func:`with_alleles`."""
    value = -F.get("_code", F.lit(i))
    n = F.when(value >= 0, F.shiftright(value, 8))
    return F.struct(n.alias("n"), F.chr(value.bitwiseAND(F.lit(255))).alias("allele"))


def _ref() -> Column:
    return F.upper("ref")


def _n(i: int) -> Column:
    return F.get("alleles", F.lit(i))["n"]


def _allele(i: int) -> Column:
    return F.get("alleles", F.lit(i))["allele"]


def _share(n: Column) -> Column:
    return F.when(F.col("cov") > 0, n / F.col("cov")).otherwise(F.lit(0.0))


def covered() -> Column:
    return F.col("cov") > 0


def num_alleles() -> Column:
    return sum(((F.col(c) > 0).cast("bigint") for c in COUNTERS.values()), F.lit(0).cast("bigint"))


def allele_text() -> Column:
    """The allele table as ``A:5,C:2``."""
    shown = F.filter("alleles", lambda x: x["n"] > 0)
    return F.array_join(F.transform(shown, lambda x: F.concat_ws(":", x["allele"], x["n"].cast("string"))), ",")


def major() -> Column:
    return F.col("major")


def minor() -> Column:
    return F.col("minor")


def purity() -> Column:
    return F.col("purity")


def ref_freq() -> Column:
    n = F.lit(0).cast("bigint")
    for letter, counter in COUNTERS.items():
        n = F.when(_ref() == letter, F.col(counter)).otherwise(n)
    return _share(n)


def alt_freq() -> Column:
    return _share(F.when(_allele(0) != _ref(), _n(0)).otherwise(_n(1)))


def basecall(hets_cov: int, hets_purity: float) -> Column:
    het = (F.col("cov") >= hets_cov) & (purity() <= hets_purity)
    return (
        F.when(~covered(), ".")
        .when(het, F.concat_ws("/", major(), minor()))
        .otherwise(major())
    )


def basecall_all() -> Column:
    parts = [_allele(0)]
    parts += [F.when(_share(_n(i)) >= MIN_FREQ, _allele(i)) for i in range(1, len(COUNTERS))]
    return F.when(covered(), F.concat_ws("/", *parts)).otherwise(".")


def acgt_text() -> Column:
    return F.concat_ws(",", *(F.col(COUNTERS[b]).cast("string") for b in "ACGT"))


def _clean() -> Column:
    """The major allele is a base, and the second allele is not a deletion."""
    second_gap = (_n(1) > 0) & (_allele(1) == "-")
    return covered() & ~major().isin("N", "-") & ~second_gap


def is_snp(min_cov: int, min_purity: float) -> Column:
    return (
        _clean()
        & (_ref() != "N")
        & (major() != _ref())
        & (F.col("cov") >= min_cov)
        & (purity() >= min_purity)
    )


def is_het(hets_cov: int, hets_purity: float) -> Column:
    return _clean() & (F.col("cov") >= hets_cov) & (purity() <= hets_purity)


def is_variant(min_cov: int, max_ref_freq: float) -> Column:
    return covered() & (_allele(0) != "N") & (F.col("cov") >= min_cov) & (ref_freq() <= max_ref_freq)


# Indels ------------------------------------------------------------------------------


def has_indel() -> Column:
    return F.col("n_indels") > 0


def indel_purity() -> Column:
    return _share(F.col("indel_total"))


def is_indel(indel_cov: int, min_indel_purity: float) -> Column:
    return covered() & has_indel() & (F.col("cov") >= indel_cov) & (indel_purity() >= min_indel_purity)


def has_insertion() -> Column:
    return F.coalesce(F.col("top_indel").startswith("+"), F.lit(False))


def insertion() -> Column:
    return F.when(has_insertion(), F.expr("substr(top_indel, 2)")).otherwise("")


def max_indel() -> Column:
    """Longest deletion, when more than half of the distinct indels are deletions."""
    mostly = F.when(has_indel(), F.col("n_dels") / F.col("n_indels")).otherwise(0.0) > 0.5
    return F.when(mostly, F.col("longest_del")).otherwise("")


def callable_ref() -> Column:
    """Sites without a known reference base are never called."""
    return ~_ref().isin(".", "N")
