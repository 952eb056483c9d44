"""What stays on disk, and how often inputs are stored or read."""

import contextlib
import io
import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from catalog import queries as Q
from genopile.operators import calls, pileup, tiling
from genopile.plans import modes
from genopile.sources.lines import numbered_lines, read_lines
from genopile.sources.reads import fastq_to_pairs
from genopile.storage import shared_folder


def _derived(spark, folder):
    docs = [(i, "ab cd " * 60 + "xyz" * i, "en", "x", 360 + 3 * i) for i in range(4)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    items = [(o, o % 5, o % 4, 1 + o % 5, 30.0) for o in range(60)]
    columns = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double"
    spark.createDataFrame(items, columns).write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def _new_tables(spark, before=()):
    """Kinds of tables in the session's folder that were not there before."""
    folder = f"{shared_folder(spark).removeprefix('file:')}/genopile"
    there = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    return there if before == () else {n.rsplit("-", 1)[0] for n in there - before}


def test_fastq_is_read_without_a_stored_copy(spark, tmp_path):
    folder, before = _derived(spark, tmp_path), _new_tables(spark)
    found = Q.QUERIES["fastq_to_pairs"](spark, folder)
    # Neither the pairs that the files were written from nor the lines of the files.
    assert _new_tables(spark, before) == {"fastq"}
    got = sorted((r.sample, r.header, r.seq1, r.seq2) for r in found.collect())
    pairs = Q.fx.read_pairs(spark, folder).collect()
    want = [(r.sample, r.header, r.seq1, r.seq2) for r in pairs]
    want += [("single", r.header, r.seq1, "") for r in pairs if r.seq2 == ""]
    assert got == sorted(want)


def test_lines_are_numbered_over_many_splits(spark, tmp_path):
    for name in ("b 1.fq", "a.fq"):
        (tmp_path / name).write_text("".join(f"{name} {i}\n" for i in range(500)))
    names = spark.createDataFrame([("s", f"{tmp_path}/a.fq"), ("s", f"{tmp_path}/b 1.fq")], "sample string, path string")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        lines = read_lines(spark, [f"{tmp_path}/a.fq", f"{tmp_path}/b 1.fq"])
        got = {r.line: r.value for r in numbered_lines(lines, names, ["sample"]).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {i: f"a.fq {i}" for i in range(500)} | {500 + i: f"b 1.fq {i}" for i in range(500)}


def test_fastq_mates_of_another_order_still_fail(spark, tmp_path):
    for mate, names in ((1, "ab"), (2, "ba")):
        (tmp_path / f"r{mate}.fq").write_text("".join(f"@{n}/{mate}\nACGT\n+\nIIII\n" for n in names))
    found = fastq_to_pairs(spark, {"s": str(tmp_path / "r1.fq")}, {"s": str(tmp_path / "r2.fq")})
    try:
        found.select(F.max("header")).collect()
    except Exception as e:
        assert "FASTQ mates differ" in str(e)
    else:
        raise AssertionError


def _plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("simple")
    return out.getvalue()


def test_sites_of_all_samples_are_not_grouped_again(spark, tmp_path):
    folder = _derived(spark, tmp_path)
    found = Q.QUERIES["site_samples"](spark, folder)
    # Pieces and the reference are shuffled by tile; nothing is shuffled by site.
    assert "hashpartitioning(chrom" in _plan(found)
    assert not [line for line in _plan(found).splitlines() if "Exchange" in line and "pos#" in line]
    rows = modes.sample_calls(Q._aln(spark, folder), Q._tiles(spark, folder))
    want = calls.site_samples(rows, Q.SAMPLES)
    assert found.schema.simpleString() == want.schema.simpleString()
    got = sorted(map(tuple, found.collect()))
    assert got == sorted(map(tuple, want.collect())) and len(got) > 3


def test_samples_that_are_not_asked_for_leave_their_sites(spark):
    reads = [("s", "r", 0, "c", 2, 60, "2M", "AC", "II"), ("x", "q", 0, "c", 3, 60, "2M", "GT", "II"), ("x", "p", 0, "d", 9, 60, "1M", "G", "I")]
    columns = "sample string, qname string, flag int, rname string, pos int, mapq int, cigar string, seq string, qual string"
    tiles = spark.createDataFrame([("c", 0, "AAcA")], "chrom string, tile bigint, seq string")
    table = spark.createDataFrame(reads, columns)
    got = calls.site_samples(modes.sample_calls(table, tiles, samples=["s", "t"]), ["s", "t"], complete=True).collect()
    want = calls.site_samples(modes.sample_calls(table, tiles), ["s", "t"]).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(got) == 8


def test_contigs_that_repeat_are_an_error_where_samples_meet(spark):
    columns = "sample string, qname string, flag int, rname string, pos int, mapq int, cigar string, seq string, qual string"
    table = spark.createDataFrame([("s", "r", 0, "c", 2, 60, "2M", "AC", "II")], columns)
    for second, fails in (("AAAA", True), ("TTTT", False)):
        tiles = spark.createDataFrame([("c", 0, "AAAA"), ("c", 0, second)], "chrom string, tile bigint, seq string")
        found = calls.site_samples(modes.sample_calls(table, tiles, samples=["s"]), ["s"], complete=True)
        if fails:
            with pytest.raises(Exception, match="there twice"):
                found.collect()
        else:
            assert sorted((r.pos, r.ref) for r in found.collect()) == [(2, "A"), (2, "T"), (3, "A"), (3, "T")]


def _files(spark, before, kind):
    folder = f"{shared_folder(spark).removeprefix('file:')}/genopile"
    made = [n for n in set(os.listdir(folder)) - before if n.startswith(kind)]
    return [f for n in made for _, _, names in os.walk(f"{folder}/{n}") for f in names if f.startswith("part-")]


def test_tables_of_pairs_are_packed_and_the_pairs_not_kept(spark, tmp_path):
    folder, before = _derived(spark, tmp_path), _new_tables(spark)
    found = Q.QUERIES["tag_samples"](spark, folder)
    assert _new_tables(spark, before) == {"pairs"}
    files = _files(spark, before, "pairs-")
    assert files and all(f.endswith(".json.gz") for f in files)
    want = sorted((r.sample, r.header) for r in Q.fx.read_pairs(spark, folder).collect())
    assert sorted(map(tuple, found.collect())) == want


def test_sorted_sam_is_packed_and_its_input_not_kept(spark, tmp_path):
    folder, before = _derived(spark, tmp_path), _new_tables(spark)
    found = Q.QUERIES["sorted_sam"](spark, folder)
    assert _new_tables(spark, before) == {"sorted", "contigs"}
    assert any(f.endswith(".txt.gz") for f in _files(spark, before, "sorted-"))
    want = Q.fx.aln(spark, folder).select(*found.columns)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))


def test_sorted_alignments_keep_only_the_result(spark, tmp_path):
    folder, before = _derived(spark, tmp_path), _new_tables(spark)
    found = Q.QUERIES["sorted_alignments"](spark, folder)
    assert _new_tables(spark, before) == {"sorted", "contigs"}
    want = Q.fx.aln(spark, folder).select(*found.columns)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))


def test_written_sam_is_packed_and_its_input_not_kept(spark, tmp_path):
    folder, before = _derived(spark, tmp_path), _new_tables(spark)
    found = Q.QUERIES["sam_rows"](spark, folder)
    assert _new_tables(spark, before) == {"sam"}
    files = _files(spark, before, "sam-")
    assert files and all(f.endswith(".txt.gz") for f in files)
    want = Q.fx.aln(spark, folder).select(*found.columns)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))


def test_few_bounds_are_compared_in_turn_many_by_halving(spark):
    axis = spark.createDataFrame([(x,) for x in [None, *range(0, 60, 3)]], "cum_pos bigint")
    bounds = spark.createDataFrame([(b,) for b in (40, 6, 6, 27, 9)], "bound bigint")
    found = {}
    for n in (4, tiling._FEW + 1):
        rows = tiling.halo_segments(axis, bounds, n, halo=7)
        found[n] = sorted(((r.cum_pos, r.seg) for r in rows.collect()), key=str)
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        # Halving a range is an interpreted loop of several steps for each row.
        assert ("aggregate(" in plan.replace("Aggregate", "")) == (n > tiling._FEW)
    assert found[4] == found[tiling._FEW + 1]
    want = [(None, None)] + [(x, s) for x in range(0, 60, 3) for s in range(sum(b < x for b in (6, 6, 9, 27, 40)), sum(b < x + 7 for b in (6, 6, 9, 27, 40)) + 1)]
    assert found[4] == sorted(want, key=str)


def test_quality_sums_are_made_in_one_pass(monkeypatch):
    made = []
    count = pileup.np.bincount
    monkeypatch.setattr(pileup.np, "bincount", lambda *a, **b: made.append(len(a) > 1 and a[1] is not None) or count(*a, **b))
    names = pileup._counters(True)
    kind = pa.struct([("at", pa.int32()), ("bases", pa.string()), ("quals", pa.string()), ("ready", pa.list_(pa.int64()))])
    groups = pa.array([[{"at": 1, "bases": "ACGTN*X", "quals": "I5I5III", "ready": None}, {"at": 2, "bases": "CA", "quals": "+I", "ready": None}]], pa.list_(kind))
    rows = pileup._counter(names, True, 0, 8)(groups)
    assert sum(made) == 2
    got = {r[0]: dict(zip(names, r[1:])) for r in pileup.np.array(rows[0].as_py()).reshape(-1, 1 + len(names)).tolist()}
    costs = pileup._match_costs()
    assert (got[2]["n_c"], got[2]["ok_c"], got[2]["err_c"]) == (2, costs[20] + costs[10], 30_000)
    assert (got[3]["ok_a"], got[3]["err_g"], got[3]["err_t"], got[1]["err_a"]) == (costs[40], 40_000, 0, 40_000)
    assert [got[p]["depth"] for p in range(1, 8)] == [1, 2, 2, 1, 1, 1, 1] and got[7]["ok_a"] == 0
