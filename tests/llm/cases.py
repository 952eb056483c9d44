"""Rows that every operator must stand: nulls, empty and long texts, ties, repeated rows."""

from __future__ import annotations

import random

import duckdb

SMALL = "/root/testdata/sf0.001"
CLASHES = ["node", "row", "doc", "_text", "host", "rule", "quality", "size", "shard", "key", "_row"]


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdeé") for _ in range(r.randint(2, 6))) for _ in range(n))


def edited(text: str, seed: int, n: int) -> str:
    r = random.Random(seed)
    words = text.split()
    for _ in range(n):
        words[r.randrange(len(words))] = f"w{r.randrange(10**6)}"
    return " ".join(words)


def messy_rows() -> list[tuple]:
    base = prose(1, 300)
    rows = [(i, prose(100 + i, 40), "en", "s1", 5) for i in range(8)]
    rows += [(20 + i, base, "en", "s2", 5) for i in range(4)]
    rows += [(30 + i, edited(base, i, 3), "en", "s2", 5) for i in range(4)]
    rows += [
        (40, None, None, None, None),
        (41, "", "en", "s1", 0),
        (42, " \t\n\x0b\r ", "en", None, 6),
        (43, "one two", "en", "s3", 7),
        (44, "ONE\ttwo", "en", "s3", 7),
        (45, prose(7, 30_000), "en", "s3", 1),
        (None, prose(8, 50), "en", "s3", 1),
        (None, prose(8, 50), "en", "s3", 1),
        (46, "x y z " * 60, "en", "s4", 1),
    ]
    return rows + [rows[0], rows[0], rows[8]]


COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def messy(spark):
    """The rows with extra columns whose names the operators use themselves."""
    schema = COLUMNS + "".join(f", {c} string" for c in CLASHES)
    return spark.createDataFrame([(*r, *CLASHES) for r in messy_rows()], schema)


def none(spark):
    return messy(spark).limit(0)


def documents(sf_dir: str = SMALL) -> dict[int, str]:
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet'").fetchall())
