"""The whole run from files, and registered queries against their SQL."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from genopile.config import PileupOptions
from catalog.oracle import ORACLES
from catalog.queries import QUERIES
from genopile.__main__ import convert, parse_region
from genopile.operators.genome import tile_reference
from genopile.plans.modes import Run, joint_call, run
from genopile.sources.reads import read_pairs

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_run_from_reads_to_tables(spark, tmp_path):
    rng = random.Random(2)
    ref = "".join(rng.choice("ACGT") for _ in range(2000))
    (tmp_path / "ref.fa").write_text(">chr1\n" + "\n".join(ref[i : i + 60] for i in range(0, 2000, 60)) + "\n")
    other = ref[:500] + ("A" if ref[500] != "A" else "C") + ref[501:]
    for name, hap in (("a", ref), ("b", other)):
        data = [(f"r{i}", hap[p : p + 60], "I" * 60, "", "") for i, p in enumerate(range(400, 560, 5))]
        spark.createDataFrame(data, "header string, seq1 string, qual1 string, seq2 string, qual2 string").write.parquet(f"{tmp_path}/{name}.parquet")
    job = dict(paths=f"{tmp_path}/*.parquet", reference=f"{tmp_path}/ref.fa", read_format="parquet")
    run(spark, Run(output=f"{tmp_path}/o1", index=True, **job))
    head = spark.read.text(f"{tmp_path}/o1/variants.txt/header").collect()
    assert [r.value.split("\t")[:4] for r in head] == [["CHR", "COORDINATE", "TYPE", "REFBASE"]]
    got = [r.value.split("\t") for r in spark.read.text(f"{tmp_path}/o1/variants.txt/records").collect()]
    assert [(*r[:4], r[4], r[7]) for r in got] == [("chr1", "501", "SNP", ref[500], ref[500], other[500])]
    # The stored alignments give the same calls without placing reads again.
    for p in ("o1/variants.alignments",):
        again = Run(output=f"{tmp_path}/o4", alignments=f"{tmp_path}/{p}", alignment_format="parquet", paths="", reference=f"{tmp_path}/ref.fa")
        run(spark, again)
    assert [r.value.split("\t") for r in spark.read.text(f"{tmp_path}/o4/variants.txt/records").collect()] == got
    near = Run(output=f"{tmp_path}/o5", index=True, region=("chr1", 480, 520), **job)
    assert [r.COORDINATE for r in run(spark, near).collect()] == [501]
    assert spark.read.parquet(f"{tmp_path}/o1/variants.bins").agg(F.sum("n")).first()[0] == 64
    run(spark, Run(output=f"{tmp_path}/o2", vcf=True, **job))
    lines = [r.value for r in spark.read.text(f"{tmp_path}/o2/variants.vcf/records").collect()]
    assert [x.split("\t")[:5] for x in lines] == [["chr1", "501", ".", ref[500], other[500]]]
    listed = spark.createDataFrame([("chr1", 501), ("chr1", 1900)], "chrom string, pos bigint")
    rows = run(spark, Run(output=f"{tmp_path}/o3", positions=listed, options=PileupOptions(min_mapq=0), **job)).collect()
    assert [(r.COORDINATE, r.TYPE, r.REFBASE) for r in rows] == [(501, "SNP", ref[500]), (1900, "UNK", ref[1899])]


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


QUICK = ["region_filter", "manifest_calls", "parse_pileup", "indel_rows", "snp_rows", "snarp", "halo_segments", "joint_genotypes", "merge_calls", "fasta_contigs"]


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, sql, name):
    df = contract.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted(map(repr, (tuple(r) for r in df.select(*columns).collect())))
    cursor = sql.execute(contract.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    order = [names.index(c) for c in columns]
    assert got == sorted(repr(tuple(r[i] for i in order)) for r in cursor.fetchall())


def test_two_alternates_of_a_site_are_both_kept(spark):
    tiles = tile_reference(spark.createDataFrame([("chr1", "AAGAA")], "chrom string, seq string"))
    rows = [("s0", f"a{i}", 0, "chr1", 3, 60, "1M", "A", "I") for i in range(9)]
    rows += [("s1", f"c{i}", 0, "chr1", 3, 60, "1M", "C", "I") for i in range(5)]
    schema = "sample string, qname string, flag int, rname string, pos int, mapq int, cigar string, seq string, qual string"
    sites = joint_call(spark.createDataFrame(rows, schema), tiles, ["s0", "s1"]).collect()
    called = {(r.alt, o.sample) for r in sites for o in r.obs if o.gt == "1/1"}
    assert called == {("A", "s0"), ("C", "s1")}


def test_region_forms():
    assert parse_region("chr1") == ("chr1", 1, 2**31 - 1)
    assert parse_region("chr1:100-") == ("chr1", 100, 2**31 - 1)
    assert parse_region("HLA:A:1,000-2,000") == ("HLA:A", 1000, 2000)


def test_fastq_command_writes_pair_tables(spark, tmp_path):
    (tmp_path / "x_1.fq").write_text("@r/1\nACGT\n+\nIIII\n")
    (tmp_path / "x_2.fq").write_text("@r/2\nTTTT\n+\nHHHH\n")
    convert(spark, [f"x={tmp_path}/x_1.fq,{tmp_path}/x_2.fq"], str(tmp_path / "out"))
    (r,) = read_pairs(spark, f"{tmp_path}/out/*.parquet", "parquet").collect()
    assert tuple(r) == ("x", "r", "ACGT", "IIII", "TTTT", "HHHH")


def test_every_query_has_sql():
    # Gapped alignment has none; test_gapped compares it with plain code.
    assert set(QUERIES) == set(ORACLES) | {"gapped_align"}
