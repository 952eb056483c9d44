"""Thresholds and options of the calling operators."""

from __future__ import annotations

from dataclasses import dataclass

# The smallest share at which a further allele is written in a basecall.
MIN_FREQ = 0.1

# Width of one stored piece of reference sequence, and the unit by which reads are shuffled.
TILE = 1024

# Overlap of neighbouring genome segments, in bases.
HALO = 300


@dataclass(frozen=True)
class Cutoffs:
    """Coverage and purity thresholds for calls; each becomes a literal in the plan."""

    min_cov: int = 3
    min_purity: float = 0.98
    hets_cov: int = 10
    hets_purity: float = 0.7
    indel_cov: int = 1
    indel_purity: float = 0.5
    indel_perc: float = 0.1


@dataclass(frozen=True)
class PileupOptions:
    """Which reads and bases enter the pileup.

    ``skip_flags`` is a SAM flag mask (unmapped, secondary, failed and duplicate reads by
    default).  With ``one_per_fragment`` the reads of a pair count once where they overlap.
    """

    min_mapq: int = 30
    min_base_qual: int = 13
    skip_flags: int = 0x4 | 0x100 | 0x200 | 0x400
    count_orphans: bool = False
    one_per_fragment: bool = False
