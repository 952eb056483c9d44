"""Pileup text: every token, ties, and the calling rules at their edges."""

from pyspark.sql import functions as F

from genopile.functions import alleles as A
from genopile.operators.calls import called_sites, long_rows
from genopile.operators.indels import indel_summary, text_indels
from genopile.operators.text_pileup import parse_pileup, text_calls

COUNTS = ["n_a", "n_c", "n_g", "n_t", "n_n", "n_del"]


def rows(spark, *cells, ref="A"):
    data = [("chr1", i + 1, ref, "s0", depth, bases, "") for i, (depth, bases) in enumerate(cells)]
    return spark.createDataFrame(data, "chrom string, pos bigint, ref string, sample string, depth bigint, bases string, quals string")


def test_tokens(spark):
    cases = [
        ("^].", [1, 0, 0, 0, 0, 0], {}),
        (".$", [1, 0, 0, 0, 0, 0], {}),
        ("*", [0, 0, 0, 0, 0, 1], {}),
        (".+2AGC", [1, 1, 0, 0, 0, 0], {"+AG": 1}),
        (",-3ttgt", [1, 0, 0, 1, 0, 0], {"-TTG": 1}),
        (">", [0, 0, 0, 0, 0, 0], {}),
        ("^+.", [1, 0, 0, 0, 0, 0], {}),
        ("^^,", [1, 0, 0, 0, 0, 0], {}),
        ("R", [0, 0, 0, 0, 0, 0], {}),
        (".+10ACGTACGTACG", [1, 0, 1, 0, 0, 0], {"+ACGTACGTAC": 1}),
        ("..+1a,+1A.-1g", [4, 0, 0, 0, 0, 0], {"+A": 2, "-G": 1}),
    ]
    table = rows(spark, *((1, c[0]) for c in cases))
    got = {r.pos: [r[c] for c in COUNTS] for r in parse_pileup(table).collect()}
    indels = {}
    for r in text_indels(table).collect():
        indels.setdefault(r.pos, {})[r.indel] = r.n
    for i, (text, counts, marks) in enumerate(cases, 1):
        assert got[i] == counts, text
        assert indels.get(i, {}) == marks, text


def test_counts_survive_rendering(spark):
    """Text made from counts gives the counts back, long texts included."""
    data = [(7, 0, 3, 1, 2, 4), (0, 1, 0, 0, 0, 0), (50000, 2, 1, 0, 0, 9)]
    cells = []
    for a, c, g, t, n, d in data:
        text = "." * a + "c" * c + "G" * g + "t" * t + "N" * n + "*" * d
        cells.append((len(text), text))
    got = sorted(parse_pileup(rows(spark, *cells)).collect(), key=lambda r: r.pos)
    assert [tuple(r[c] for c in COUNTS) for r in got] == data
    assert all(sum(r[c] for c in COUNTS) <= r.cov for r in got)


def test_major_swaps_only_on_a_tie_with_the_reference(spark):
    for ref, text, want in [("A", "..cc", ("C", "A")), ("T", "..cc", ("C", "T")), ("T", "...cc", ("T", "C")), ("G", "ttcc", ("T", "C"))]:
        r = text_calls(rows(spark, (4, text), ref=ref)).select(A.major().alias("a"), A.minor().alias("b")).first()
        assert (r.a, r.b) == want, (ref, text)


def test_coverage_without_bases_is_none(spark):
    r = text_calls(rows(spark, (2, "<+1A>")), indels=True).select(
        "cov", A.purity().alias("p"), A.indel_purity().alias("ip"), A.has_indel().alias("h"), A.basecall_all().alias("b")
    ).first()
    assert (r.cov, r.p, r.ip, r.h, r.b) == (0, 0.0, 0.0, True, ".")


def test_predicates(spark):
    cells = {
        "gggg": (True, False),  # pure alternate
        "gg": (False, False),  # too few
        "ggggggggg*": (False, False),  # second allele is a gap
        "ggggg.....": (False, True),  # heterozygous
        "nnnnn": (False, False),
        "**********": (False, False),
    }
    table = text_calls(rows(spark, *((len(t), t) for t in cells)))
    got = table.orderBy("pos").select(A.is_snp(3, 0.98).alias("s"), A.is_het(10, 0.7).alias("h")).collect()
    assert [tuple(r) for r in got] == list(cells.values())


def test_max_indel_is_the_longest_deletion_when_deletions_prevail(spark):
    cells = [(4, ".-1T.-1T,-3ttg."), (3, ".+1A.-2TT,"), (2, ".+2AG,")]
    got = text_calls(rows(spark, *cells), indels=True).orderBy("pos").select(A.max_indel().alias("m")).collect()
    assert [r.m for r in got] == ["TTG", "", ""]


def test_indel_row_re_anchors_alleles(spark):
    data = [
        ("chr1", 5, "A", "s0", 2, ".-3ttg.-3ttg", ""),
        ("chr1", 5, "A", "s1", 4, ".+2GG,+2gg.-1T,", ""),
        ("chr1", 5, "A", "s2", 3, "...", ""),
    ]
    table = spark.createDataFrame(data, "chrom string, pos bigint, ref string, sample string, depth bigint, bases string, quals string")
    got = long_rows(called_sites(text_calls(table, True), ["s0", "s1", "s2", "s3"], indels=True)).orderBy("sample").collect()
    assert [(r.type, r.ref, r.sample, r.basecall, r.cov) for r in got] == [
        ("IND", "ATTG", "s0", "A", 2),
        ("IND", "ATTG", "s1", "AGG,ATG", 4),
        ("IND", "ATTG", "s2", "ATTG", 3),
        ("IND", "ATTG", "s3", "ATTG", 0),
    ]


def test_unknown_reference_is_never_called(spark):
    for ref in ("N", "n", "."):
        assert called_sites(text_calls(rows(spark, (5, "ggggg"), ref=ref)), ["s0"], hets=True).count() == 0


def test_indel_summary_counts(spark):
    r = indel_summary(text_indels(rows(spark, (4, ".+1A.+1A.-2TT.-3TTT")))).first()
    assert (r.n_indels, r.indel_total, r.top_indel, r.n_dels, r.longest_del) == (3, 4, "+A", 2, "TTT")
    assert [(i.n, i.indel) for i in r.indels] == [(2, "+A"), (1, "-TTT"), (1, "-TT")]


def test_four_decimals_round_like_the_exact_value(spark):
    from genopile.functions.dna import fixed4

    pairs = [(n, c) for c in (1, 3, 7, 32, 96, 160, 800, 1600, 20000) for n in range(0, c + 1, max(1, c // 97))]
    table = spark.createDataFrame([(n / c,) for n, c in pairs], "x double").select("x", fixed4(F.col("x")).alias("t"))
    assert [r for r in table.collect() if r.t != "%.4f" % r.x] == []
