"""Column expressions on CIGAR text."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

BLOCKS = T.ArrayType(
    T.StructType()
    .add("op", T.StringType())
    .add("len", T.IntegerType())
    .add("ref_off", T.IntegerType())
    .add("read_off", T.IntegerType())
    .add("prev", T.StringType())
)


def cigar_blocks(cigar: Column) -> Column:
    """One struct per operation, with the reference and read bases consumed before it."""
    return _blocks(cigar)


@F.arrow_udf(BLOCKS)
def _blocks(cigars: pa.Array) -> pa.Array:
    """Every distinct CIGAR of a batch is read once."""
    coded = cigars.dictionary_encode()
    return pa.array([_walk(c) for c in coded.dictionary.to_pylist()], to_arrow_type(BLOCKS)).take(coded.indices)


def _walk(cigar: str) -> list[dict]:
    blocks, ref_off, read_off, prev = [], 0, 0, ""
    for digits, op in re.findall("([0-9]+)([MIDNSHP=X])", cigar):
        size = int(digits)
        blocks.append({"op": op, "len": size, "ref_off": ref_off, "read_off": read_off, "prev": prev})
        ref_off += size if op in "MDN=X" else 0
        read_off += size if op in "MIS=X" else 0
        prev = op
    return blocks


def ref_span(cigar: Column) -> Column:
    """Reference bases covered by an alignment."""
    sizes = F.regexp_extract_all(cigar, F.lit("([0-9]+)[MDN=X]"), F.lit(1))
    return F.aggregate(sizes, F.lit(0), lambda total, n: total + n.cast("int"))
