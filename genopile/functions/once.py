"""Columns that are computed once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Like ``withColumns`` for costly expressions that later steps read many times.

    The optimizer copies an expression into every filter above it that names the column.
    A generator with one output row keeps the values as plain columns instead, inside the
    same generated code.
    """
    values = F.struct(*(c.alias(name) for name, c in columns.items()))
    kept = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(values)))
