"""Manifests and regions."""

import os

import pytest
from pyspark.sql import functions as F

from genopile.operators.reads import region_reads
from genopile.sources import alignments, tables
from genopile.sources.alignments import header_contigs, sam_rows
from genopile.sources.lines import sample_name


def test_manifest_of_paths_names_samples(spark, tmp_path):
    (tmp_path / "list.txt").write_text("#note\ns3a://x/y/one.avro\ns3a://x/two.fastq.gz\n\n")
    got = tables.manifest_of_paths(spark, str(tmp_path / "list.txt")).collect()
    assert sorted((r.sample, r.path) for r in got) == [("one", "s3a://x/y/one.avro"), ("two", "s3a://x/two.fastq.gz")]


def test_region_takes_reads_by_their_span(spark):
    rows = [("a", "chr1", 90, "10M"), ("b", "chr1", 91, "10M"), ("c", "chr1", 80, "5M20D5M"), ("d", "chr1", 111, "5M"), ("e", "chr2", 100, "5M")]
    table = spark.createDataFrame(rows, "qname string, rname string, pos int, cigar string")
    got = sorted(r.qname for r in region_reads(table, "chr1", 100, 110).collect())
    assert got == ["b", "c"]


def test_sam_lines_with_tags_and_header(spark):
    lines = ["@HD\tVN:1.6", "@SQ\tSN:chr2\tLN:77", "@SQ\tSN:chr*\tLN:5", "r\t0\tchr*\t3\t40\t4M\t*\t0\t0\tACGT\tIIII\tNM:i:0\tXX:Z:a"]
    table = spark.createDataFrame([("s", x) for x in lines], "sample string, value string")
    r = sam_rows(table).first()
    assert (r.rname, r.pos, r.tags) == ("chr*", 3, ["NM:i:0", "XX:Z:a"])
    assert sorted((c.chrom, c.len) for c in header_contigs(table).collect()) == [("chr*", 5), ("chr2", 77)]


def test_sample_names(spark):
    cases = {
        "s3a://b/s1.bam": "s1",
        "s3a://b/s1.cram": "s1",
        "s3a://b/s1.fastq.bz2": "s1",
        "s3a://b/s1.vcf.bgz": "s1",
        "s3a://b/run.parquet/s1.avro": "s1",
        "s3a://b/my%20s.fq.gz": "my s",
        "file:/x/a+b.v2.json/part-0000-x.json": "a+b.v2",
        "/x/s.parquet/": "s",
    }
    table = spark.createDataFrame([(p,) for p in cases], "path string")
    got = {r.path: r.name for r in table.select("path", sample_name(table.path).alias("name")).collect()}
    assert got == cases
    with pytest.raises(Exception, match="no sample name"):
        spark.createDataFrame([("/x/.bam",)], "path string").select(sample_name(F.col("path"))).collect()


def test_only_part_files_take_their_folders_name(spark):
    paths = {
        "/d/particle.bam": "particle",
        "/d/part1.fastq": "part1",
        "/d/partner.sam": "partner",
        "/d/_x.sam": "_x",
        "/d/s1/part-00000-0f.c000.snappy.parquet": "s1",
        "/d/s1.parquet/part-00012": "s1",
        "/d/s1/_SUCCESS": "s1",
    }
    table = spark.createDataFrame([(p,) for p in paths], "path string")
    assert {r.path: r.name for r in table.select("path", sample_name(table.path).alias("name")).collect()} == paths


def _record(name, rname="c1", pos=1):
    return "\t".join([name, "0", rname, str(pos), "60", "4M", "*", "0", "0", "ACGT", "IIII"])


def test_manifest_paths_as_people_write_them(spark, tmp_path, monkeypatch):
    for name in ("plain.sam", "with space.sam", "plus+sign.sam", "w1.sam", "w2.sam", "folder/a.sam", "folder/b.sam", "back[1].sam"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(_record(name) + "\n")
    rows = [
        ("plain", "plain.sam"),
        ("absolute", f"{tmp_path}/plain.sam"),
        ("space", f"{tmp_path}/with space.sam"),
        ("plus", f"file://{tmp_path}/plus+sign.sam"),
        ("wild", f"{tmp_path}/w?.sam"),
        ("folder", f"{tmp_path}/folder"),
        ("brackets", f"{tmp_path}/back\\[1\\].sam"),
        ("lost", f"{tmp_path}/none.sam"),
    ]
    rows[0] = ("plain", os.path.relpath(tmp_path / "plain.sam"))
    (tmp_path / "list.tsv").write_text("# sample and path\n" + "".join(f"{a}\t{b}\n" for a, b in rows))
    with pytest.warns(UserWarning, match="none.sam"):
        got = alignments.listed_alignments(spark, str(tmp_path / "list.tsv"))
    want = [("plain", "plain.sam"), ("absolute", "plain.sam"), ("space", "with space.sam"), ("plus", "plus+sign.sam")]
    want += [("wild", "w1.sam"), ("wild", "w2.sam"), ("folder", "folder/a.sam"), ("folder", "folder/b.sam"), ("brackets", "back[1].sam")]
    assert sorted((r.sample, r.qname) for r in got.collect()) == sorted(want)
    (tmp_path / "none.tsv").write_text(f"lost\t{tmp_path}/none.sam\n")
    with pytest.warns(UserWarning):
        assert alignments.listed_alignments(spark, str(tmp_path / "none.tsv")).count() == 0
