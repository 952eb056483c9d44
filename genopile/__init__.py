"""Read-to-variant analytics on Spark DataFrames."""

import sys

from pyspark import cloudpickle

from genopile.config import Cutoffs, PileupOptions
from genopile.plans.modes import call_variants, genotype_positions, joint_call, run

__all__ = [
    "Cutoffs",
    "PileupOptions",
    "call_variants",
    "genotype_positions",
    "joint_call",
    "run",
]

# Functions travel to Python workers by value, so a cluster need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
