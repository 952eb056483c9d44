"""Column expressions on the base text of a pileup row.

The text is read with a few regular-expression passes over the whole value, not token by
token: read-start marks (``^`` and the character after it) go first, then indel marks are
taken out; what is left is one character per base.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_START = r"(?s)\^."
_INDEL = r"[+-][0-9]+[A-Za-z]*"


def _body(bases: Column) -> Column:
    return F.regexp_replace(bases, _START, "")


def _size(mark: Column) -> Column:
    return F.regexp_extract(mark, "[0-9]+", 0).cast("int")


def _letters(mark: Column) -> Column:
    return F.regexp_extract(mark, "[A-Za-z]*$", 0)


def indel_marks(bases: Column) -> Column:
    """All indels of the row as ``+AG`` / ``-T``, one entry per read."""
    return F.transform(
        F.regexp_extract_all(_body(bases), F.lit(_INDEL), F.lit(0)),
        lambda m: F.concat(F.left(m, F.lit(1)), F.upper(F.left(_letters(m), _size(m)))),
    )


def single_bases(bases: Column) -> Column:
    """One upper-case character per read base, marks removed.

    Letters after an indel that are beyond its stated size are bases of further reads.
    """
    body = _body(bases)
    after = F.transform(
        F.regexp_extract_all(body, F.lit(_INDEL), F.lit(0)),
        lambda m: F.substr(_letters(m), _size(m) + 1),
    )
    return F.upper(F.concat(F.regexp_replace(body, _INDEL, ""), F.array_join(after, "")))


def count_of(text: Column, letters: str) -> Column:
    """How often any of some characters occurs."""
    return F.length(F.regexp_replace(text, f"[^{letters}]", "")).cast("bigint")
