import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from cases import SMALL, messy, none
from genopile.llm import merkle

COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def digest(parts):
    return hashlib.sha256(parts.encode()).hexdigest()


def leaf(row):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(level):
    levels = [level]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([digest("".join(last[i : i + 8])) for i in range(0, len(last), 8)])
    return levels


def path(levels, place):
    out = []
    for level in levels[:-1]:
        run = place // 8 * 8
        out.append((level[run:place], level[place + 1 : run + 8]))
        place //= 8
    return out


def expected(rows):
    """Rows (doc_id, source, lang, n_chars, text) to the contract's rows, one whole level at a time."""
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(((row[0] is not None, row[0] or 0, leaf(row)), row))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    groups = {g: sorted(groups[g], key=lambda x: x[0]) for g in langs}
    trees = {g: tree([order[2] for order, _ in groups[g]]) for g in langs}
    top = tree([trees[g][-1][0] for g in langs])
    out = []
    for k, g in enumerate(langs):
        for i, (order, row) in enumerate(groups[g]):
            proof = path(trees[g], i) + path(top, k)
            text = row[4]
            if text is not None and row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0:
                text = text.translate({c: c + 32 for c in range(65, 91)})
            found = leaf((*row[:4], text))
            for before, after in proof:
                found = digest("".join(before) + found + "".join(after))
            sibling = digest("".join("".join(a) + "".join(b) for a, b in proof))
            out.append((row[0], order[2], trees[g][-1][0], top[-1][0], sibling, found, found == top[-1][0]))
    return sorted(map(repr, out))


def rows_of(frame):
    return sorted(repr(tuple(r[c] for c in COLUMNS)) for r in frame.collect())


def lowered():
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return {"text": F.when(third, lower).otherwise(F.col("text"))}


def test_query_against_plain_code(spark):
    rows = duckdb.sql(f"SELECT doc_id, source, lang, n_chars, text FROM '{SMALL}/documents.parquet'").fetchall()
    assert rows_of(merkle.query(spark, SMALL)) == expected(rows)


@pytest.mark.parametrize("levels", [1, 2, 4])
def test_messy_rows_in_subtrees_of_any_height(spark, levels):
    docs = messy(spark)
    rows = [tuple(r) for r in docs.select(*merkle.FIELDS).collect()]
    found = merkle.manifest(docs, shown=lowered(), options=merkle.Merkle(levels))
    assert rows_of(found) == expected(rows)


def test_many_groups_and_sizes(spark):
    r = random.Random(2)
    rows = [(i, "s", f"é{g}", None, f"T{i}") for i, g in enumerate(g for g in range(40) for _ in range(r.choice([1, 7, 8, 9, 65])))]
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert rows_of(merkle.manifest(frame, shown=lowered(), options=merkle.Merkle(1))) == expected(rows)


def test_empty_table(spark):
    assert merkle.manifest(none(spark)).count() == 0


def test_proofs_are_paths_of_bounded_queues():
    for n in (1, 2, 8, 9, 64, 65, 513):
        leaves = [digest(str(i)) for i in range(n)]
        inner = merkle.forward(leaves, merkle.height(n))
        top = merkle.height(n)
        root = digest("".join(inner[top, 0])) if top else leaves[0]
        proofs = dict(merkle.backward(inner, top, ""))
        assert sorted(proofs) == list(range(n))
        assert all(merkle.folded(leaves[i], p) == root for i, p in proofs.items())
        assert all(merkle.folded(digest("x"), p) != root for p in proofs.values())
