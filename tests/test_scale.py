"""What keeps large inputs in bounds, and equal results beside it."""

import contextlib
import io

from pyspark.sql import functions as F

from catalog.queries import QUERIES
from genopile import fixtures as fx
from genopile.operators.align import mismatches
from genopile.operators.indels import pileup_indels
from genopile.operators.pileup import pileup_counts, with_ref
from genopile.sinks import alignments as sinks

READ = "sample string, qname string, flag int, rname string, pos int, mapq int, cigar string, seq string, qual string"


def _plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("simple")
    return out.getvalue()


def _reads(spark, rows):
    return spark.createDataFrame([("s", f"r{i}", 0, "c", p, 60, c, s, q) for i, (p, c, s, q) in enumerate(rows)], READ)


def test_single_bases_are_no_rows(spark):
    plan = _plan(pileup_counts(_reads(spark, [(1, "4M", "ACGT", "IIII")])))
    assert "posexplode" not in plan


def test_hot_tiles_give_the_same_counts(spark):
    reads = _reads(spark, [(p, "2M1D2M", "ACGT", "IIII") for p in (1, 2, 7, 8, 9)] * 3)
    plain = pileup_counts(reads, quality=True, tile=8)
    dealt = pileup_counts(reads, quality=True, tile=8, shares=10, light=4)
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, plain.collect()))


def test_text_shorter_than_the_cigar(spark):
    rows = pileup_counts(_reads(spark, [(1, "3M", "A", "III"), (1, "1M", "C", "I")])).orderBy("pos").collect()
    assert [(r.pos, r.depth, r.n_a, r.n_c) for r in rows] == [(1, 2, 1, 1), (2, 1, None, None), (3, 1, None, None)]

def test_items_meet_contigs_without_a_table_of_windows(spark, tmp_path):
    docs = [(i, "ab cd " * 60, "en", "x", 360) for i in range(4)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    items = [(o, o % 5, o % 3, 1, 7.0) for o in range(40)]
    columns = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double"
    spark.createDataFrame(items, columns).write.parquet(f"{tmp_path}/lineitem.parquet")
    found = fx.read_pairs(spark, str(tmp_path))
    assert "explode" not in _plan(found)
    seq = fx.contigs(spark, str(tmp_path)).first().seq
    rows = found.collect()
    assert len(rows) == 40
    assert all(r.seq1 in seq for r in rows if r.sample == "s0" and r.seq1 != "ACGTA" * 10)


def test_only_sites_that_may_be_called_leave_the_count(spark):
    tiles = spark.createDataFrame([("c", 0, "ACGTACGT"), ("c", 1, "ACgTACGT"), ("d", 0, "AAAAAAAA")], "chrom string, tile bigint, seq string")
    rows = [(2, "4M", "CGAA", "IIII"), (3, "4M", "GTAC", "IIII"), (9, "2M2D2M", "ACAC", "IIII"), (8, "1M", "T", "I"), (20, "2M", "AC", "II")]
    reads = _reads(spark, rows).unionByName(_reads(spark, [(4, "1M", "A", "I")]).withColumn("sample", F.lit("t")))
    reads = reads.unionByName(reads.limit(1).withColumn("rname", F.lit("e")))
    every = with_ref(pileup_counts(reads, quality=True, tile=8), tiles, 8)
    besides = spark.createDataFrame([("c", 8), ("c", 8), ("d", 3), (None, 1), ("c", None)], "chrom string, pos int")
    got = pileup_counts(reads, quality=True, tile=8, tiles=tiles, differing=True, besides=besides)
    assert got.columns == every.columns
    want = [tuple(r) for r in every.collect() if r.chrom == "e" or r.pos in (4, 8, 20, 21)]
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) == 9
    hot = pileup_counts(reads, quality=True, tile=8, tiles=tiles, differing=True, besides=besides, shares=10, light=2)
    assert sorted(map(tuple, hot.collect())) == sorted(want)
    listed = pileup_counts(reads, quality=True, tile=8, tiles=tiles, positions=besides)
    assert sorted(map(tuple, listed.collect())) == sorted(tuple(r) for r in every.collect() if r.chrom == "c" and r.pos == 8)
    whole = pileup_counts(reads, quality=True, tile=8, tiles=tiles)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, every.collect()))


def test_bounds_derive_the_alignments_once(spark, tmp_path):
    docs = [(i, "ab cd " * 60, "en", "x", 360) for i in range(4)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    items = [(o, o % 5, o % 3, 1, 7.0) for o in range(40)]
    columns = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double"
    spark.createDataFrame(items, columns).write.parquet(f"{tmp_path}/lineitem.parquet")
    bounds = QUERIES["equal_bounds"](spark, str(tmp_path))
    # Letters of the documents are mapped in Python; the bounds read what is stored of it.
    assert "ArrowEvalPython" not in _plan(bounds)
    assert bounds.count() >= 1


def _derived(spark, folder):
    docs = [(i, "ab cd " * 60, "en", "x", 360) for i in range(4)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    items = [(o, o % 5, o % 3, 1, 7.0) for o in range(40)]
    columns = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double"
    spark.createDataFrame(items, columns).write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def test_genome_sort_derives_the_alignments_once(spark, tmp_path):
    found = QUERIES["genome_sort"](spark, _derived(spark, tmp_path))
    assert "ArrowEvalPython" not in _plan(found) and "lineitem" not in _plan(found)
    rows = found.collect()
    assert len(rows) == 40 and rows == sorted(rows, key=lambda r: (r.chrom_ord, r.pos, r.sample, r.qname))


def test_sorted_alignments_are_ranged_from_stored_rows(spark, tmp_path, monkeypatch):
    plans = []
    write = sinks._ordered
    monkeypatch.setattr(sinks, "_ordered", lambda reads, contigs, n: plans.append(_plan(reads) + _plan(contigs)) or write(reads, contigs, n))
    found = QUERIES["sorted_alignments"](spark, _derived(spark, tmp_path))
    assert found.count() == 40
    # Neither documents nor line items are read by the pass that finds the ranges.
    assert len(plans) == 1 and "ArrowEvalPython" not in plans[0] and "lineitem" not in plans[0]


def test_indel_events_are_counted_once(spark):
    tiles = spark.createDataFrame([("c", 0, "ACGTACGTACGT")], "chrom string, tile bigint, seq string")
    found = pileup_indels(_reads(spark, [(1, "2M1I2M", "ACTGT", "IIIII"), (1, "2M2D2M", "ACAC", "IIII")]), tiles)
    assert "ArrowEvalPython" not in _plan(found)
    assert sorted((r.pos, r.indel, r.n) for r in found.collect()) == [(2, "+T", 1), (2, "-GT", 1)]


def test_mismatches_are_counted_without_arrays_of_letters(spark):
    tiles = spark.createDataFrame([("c", 0, "ACGTacgt"), ("c", 1, "AC"), ("c", 2, "")], "chrom string, tile bigint, seq string")
    reads = [("a", 1, "ACGT"), ("b", 2, "cgaacg"), ("c", 7, "GTACGG"), ("d", 8, "TA"), ("e", 17, "ACG"), ("f", 1, "ÄCGT"), ("g", 11, "GG"), ("h", 30, "A"), ("i", 1, None)]
    placed = spark.createDataFrame([("c", *r) for r in reads], "rname string, name string, pos bigint, seq string")
    got = mismatches(placed, tiles, ["name"], 8)
    assert "zip_with" not in _plan(got)
    want = {"a": 0, "b": 1, "c": 0, "d": 0, "e": 1, "f": 1, "g": 1}
    assert {r.name: r.mismatches for r in got.collect()} == want
