"""Sequencing-shaped input tables derived from the given tables (see FIXTURES.md)."""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from genopile.functions.dna import reverse_complement
from genopile.functions.once import with_once

SAMPLES = ["s0", "s1", "s2"]

_LETTERS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_BASES = bytes.maketrans(_LETTERS, b"ACGTACGTACGTACGTACGTACGTAC" * 2)
_OTHER = bytes(c for c in range(256) if c not in _LETTERS)
# Reads of one start window reach this far; windows follow each other by the starts they hold.
_WINDOW = 109
_STARTS = 60


@lru_cache(maxsize=256)
def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@lru_cache(maxsize=256)
def _few_splits(spark: SparkSession, sf_dir: str, name: str) -> bool:
    """Whether a table is read by fewer tasks than there are cores."""
    return _table(spark, sf_dir, name).rdd.getNumPartitions() < spark.sparkContext.defaultParallelism


def _spread(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table; a table of few splits is spread over the cores first."""
    table = _table(spark, sf_dir, name).select(*columns)
    if _few_splits(spark, sf_dir, name):
        return table.repartition(spark.sparkContext.defaultParallelism)
    return table


@F.arrow_udf(T.StringType())
def _as_bases(texts: pa.Array) -> pa.Array:
    """The letters A-Z, a-z of each text as bases; no other character holds such a byte."""
    whole = texts.cast(pa.binary()).to_pylist()
    return pa.array([t and t.translate(_BASES, _OTHER) for t in whole], pa.binary()).cast(pa.string())


def contigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(chrom, seq)``: every document's letters, as bases."""
    return (
        _spread(spark, sf_dir, "documents", "doc_id", "text")
        .filter(F.col("text").rlike("[A-Za-z]"))
        .select(F.concat(F.lit("chr"), F.col("doc_id")).alias("chrom"), _as_bases("text").alias("seq"))
    )


def _placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line item with a window of its contig and its start in it.

    Windows cover a contig whole and the last one ends with it.  A contig shorter than a window
    is one window.  Early windows get more line items, so that some positions are deep.
    """
    docs = _table(spark, sf_dir, "documents")
    number = F.substr("chrom", F.lit(4)).cast("bigint")
    size = F.length("seq")
    n_wins = F.when(size < _WINDOW, 1).otherwise(F.ceil((size - _WINDOW) / _STARTS) + 1).cast("bigint")
    base = contigs(spark, sf_dir).select("chrom", number.alias("doc_id"), "seq", size.alias("size"), n_wins.alias("n_wins"))
    held = base.select(F.col("doc_id").alias("_doc"), "chrom", "seq", F.col("size").alias("held"), F.col("n_wins").alias("held_wins"))
    n_docs = docs.agg(F.count(F.lit(1))).scalar()
    columns = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"]
    items = _spread(spark, sf_dir, "lineitem", *columns).select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        F.col("l_quantity").cast("int").alias("qty"),
        F.pmod(F.col("l_partkey"), n_docs).alias("doc_id"),
    )
    # What follows from an item's keys is derived where it meets its contig and not shuffled.
    mark = F.col("l_orderkey") * 31 + F.col("l_linenumber") * 7
    items = items.join(base.select("doc_id", "size", "n_wins"), "doc_id", "left").withColumns(
        {"mark": mark, "h": F.pmod(mark + F.col("l_suppkey") * 13, F.lit(1000000))}
    )
    items = items.withColumns(
        {
            "i": F.expr("(n_wins * ((h * h) div 1000000 * h div 1000000)) div 1000000"),
            "short": F.col("size") < _WINDOW,
            "w0": (F.pmod(F.col("mark"), F.least(F.lit(_STARTS), F.when(F.col("size") < _WINDOW, F.col("size")).otherwise(_STARTS))) + 1).cast("int"),
        }
    )
    off = F.least(F.col("i") * _STARTS, F.greatest(F.lit(0), F.col("held") - _WINDOW)).cast("int")
    # The window is cut out of the contig that the item meets, so items are shuffled once, by contig.
    same = (F.col("_doc") == F.col("doc_id")) & (F.col("i") < F.col("held_wins"))
    items = items.join(held, same, "left").withColumn("off", off)
    items = items.withColumn("win", F.substr("seq", F.col("off") + 1, F.lit(_WINDOW))).drop("seq")
    name = F.concat(F.lit("r"), F.concat_ws(".", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "qty"))
    alt = F.replace("win", F.lit("CGA"), F.lit("CTA"))
    kind = F.pmod(F.col("l_suppkey"), F.lit(3))
    other = (kind == 1) | ((kind == 2) & (F.col("l_linenumber") % 2 == 0))
    return items.select(
        F.concat(F.lit("s"), kind).alias("sample"),
        name.alias("name"),
        "l_linenumber",
        "qty",
        "w0",
        F.coalesce("short", F.lit(False)).alias("short"),
        "chrom",
        "off",
        F.when(other, alt).otherwise(F.col("win")).alias("hap"),
        F.concat(
            F.expr("repeat(substr('+5:?DIN', l_linenumber, 1), 25)"), F.lit("I" * 25)
        ).alias("qual"),
    )


def _cut(skip: int, size: int) -> Column:
    return F.substr("hap", F.col("w0") + skip, F.lit(size))


def aln(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignments in SAM shape, one per line item."""
    placed = _placed(spark, sf_dir)
    kind = F.col("w0") % 8
    lost = (F.col("qty") == 50) | F.col("chrom").isNull()
    cigar = (
        F.when(F.col("short"), F.concat(F.length(_cut(0, 50)), F.lit("M")))
        .when(kind == 1, "20M3D30M")
        .when(kind == 2, "25M2I23M")
        .when(kind == 3, "5S45M")
        .when(kind == 5, "3H50M")
        .when(kind == 6, "10M4N40M")
        .when(kind == 7, "20=1X29M")
        .otherwise("50M")
    )
    seq = (
        F.when(F.col("short"), _cut(0, 50))
        .when(kind == 1, F.concat(_cut(0, 20), _cut(23, 30)))
        .when(kind == 2, F.concat(_cut(0, 25), F.lit("GT"), _cut(25, 23)))
        .when(kind == 3, F.concat(F.lit("AAAAA"), _cut(0, 45)))
        .when(kind == 6, F.concat(_cut(0, 10), _cut(14, 40)))
        .otherwise(_cut(0, 50))
    )
    return with_once(
        placed.select("sample", F.col("name").alias("qname"), "l_linenumber", "qty", "w0", "short", "chrom", "off", "hap", "qual"),
        {
            "flag": F.when(lost, 4).when(F.col("l_linenumber") % 2 == 0, 16).otherwise(0),
            "rname": F.when(lost, "*").otherwise(F.col("chrom")),
            "pos": F.when(lost, 0).otherwise(F.col("off") + F.col("w0")),
            "mapq": F.when(lost, 0).otherwise(F.col("qty") + 10),
            "cigar": F.when(lost, "*").otherwise(cigar),
            "seq": F.coalesce(seq, F.lit("ACGTA" * 10)),
        },
    ).select(
        "sample",
        "qname",
        "flag",
        "rname",
        "pos",
        "mapq",
        "cigar",
        F.lit("*").alias("rnext"),
        F.lit(0).alias("pnext"),
        F.lit(0).alias("tlen"),
        "seq",
        F.substr("qual", F.lit(1), F.length("seq")).alias("qual"),
    )


def read_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read pairs, one per line item; pairs of line 5 are single-end."""
    placed = _placed(spark, sf_dir)
    single = F.col("l_linenumber") == 5
    first = F.coalesce(_cut(0, 50), F.lit("ACGTA" * 10))
    mate = F.when(F.col("short"), _cut(0, 50)).otherwise(_cut(10, 50))
    second = F.coalesce(reverse_complement(mate), F.lit("TACGT" * 10))
    both = placed.select(
        "sample",
        F.col("name").alias("header"),
        "qual",
        first.alias("seq1"),
        F.when(single, "").otherwise(second).alias("seq2"),
    )
    quals = {
        "qual1": F.substr("qual", F.lit(1), F.length("seq1")),
        "qual2": F.reverse(F.substr("qual", F.lit(1), F.length("seq2"))),
    }
    return both.withColumns(quals).select("sample", "header", "seq1", "qual1", "seq2", "qual2")


def pileup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pileup rows in long form, three samples per order."""
    n1 = F.col("o_totalprice").cast("bigint") % 16
    n2 = F.col("o_custkey") % 7
    orders = _spread(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_totalprice").select(
        "o_orderkey",
        n1.cast("int").alias("n1"),
        n2.cast("int").alias("n2"),
        F.explode(F.array(*(F.lit(k) for k in range(len(SAMPLES))))).alias("k"),
    )
    kind = (F.col("o_orderkey") + F.col("k") * 3 * (F.col("n1") % 2)) % 8
    by_kind = [
        ("'^].,$*.+2AG,-1tN>.+2AGC^+,R' || repeat('A', n2)", F.col("n2") + 11),
        ("repeat('A', n1) || repeat('a', n2)", F.col("n1") + F.col("n2")),
        ("repeat('.', n1) || repeat('c', n2)", F.col("n1") + F.col("n2")),
        ("repeat('.+2AG', n1) || repeat(',', n2)", F.col("n1") + F.col("n2")),
        ("repeat(',-3ttg', n1) || repeat('.-1T', n2) || repeat('.', 3)", F.col("n1") + F.col("n2") + 3),
        ("repeat('.', n1) || 'g' || repeat('*', n2)", F.col("n1") + F.col("n2") + 1),
        ("'*'", F.lit(0)),
        ("'<+1A>' || repeat('>', n1)", F.col("n1") + 2),
    ]
    bases, depth = F.lit(""), F.lit(0)
    for i, (text, n) in reversed(list(enumerate(by_kind))):
        bases = F.when(kind == i, F.expr(text)).otherwise(bases)
        depth = F.when(kind == i, n).otherwise(depth)
    ref = F.substr(F.lit("ACGT"), (F.col("o_orderkey") % 4 + 1).cast("int"), F.lit(1))
    shown = (
        F.when(F.col("o_orderkey") % 97 == 0, "N")
        .when(F.col("o_orderkey") % 89 == 0, F.lower(ref))
        .otherwise(ref)
    )
    return orders.select(
        F.concat(F.lit("chr"), F.col("o_orderkey") % 20).alias("chrom"),
        (F.col("o_orderkey") + 1).alias("pos"),
        shown.alias("ref"),
        F.concat(F.lit("s"), F.col("k")).alias("sample"),
        depth.cast("bigint").alias("depth"),
        bases.alias("bases"),
    ).withColumn("quals", F.expr("if(depth = 0, '*', repeat('I', int(depth)))"))


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A position list: one per part (covered) and one per supplier (far off)."""
    parts = _table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), (F.col("p_partkey") + 1).alias("pos"))
    far = _table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), (F.col("s_suppkey") + 100000001).alias("pos"))
    return parts.unionByName(far).select(F.concat(F.lit("chr"), F.col("k") % 20).alias("chrom"), "pos")
