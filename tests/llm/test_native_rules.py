import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cases import SMALL, documents, messy, messy_rows, none
from genopile.llm import credentials, host_rules, link_trust
from genopile.llm.common import dense_index

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    w = WORD.findall(text)
    at = {}
    for i in range(len(w) - 7):
        at.setdefault(tuple(w[i : i + 8]), []).append(i)
    covered = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), failed


def test_rule_counts_of_whole_table(spark):
    docs = documents()
    rows = host_rules.query(spark, SMALL).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert tuple(r)[1:7] == counts(docs[r.doc_id])


def test_rules_on_messy_rows(spark):
    rows = host_rules.judge(messy(spark)).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    got = sorted(((r.doc.doc_id, r.doc.text, *tuple(r.quality)[:6]) for r in rows), key=key)
    want = sorted(((r[0], r[1], *counts(r[1])) for r in messy_rows()), key=key)
    assert got == want
    assert host_rules.judge(none(spark)).count() == 0


def test_bad_host_takes_its_documents_along(spark):
    good = " ".join(f"w{i}" for i in range(30))
    rows = [(i, "too short", "bad") for i in range(90)] + [(i, good, "bad") for i in range(10)]
    rows += [(i, good, "good") for i in range(100)] + [(1, good, "small"), (2, "short", "small")]
    judged = host_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    kept = {(r.doc.source, r.quality.base_failed, r.quality.kept) for r in judged.collect()}
    assert ("bad", False, False) in kept and ("bad", False, True) not in kept
    assert ("good", False, True) in kept and ("small", True, False) in kept


ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A
)


def base_spans(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


SECRETS = [
    "é password = \"hunter22\" and token:ab:secret99 Api_Key='Zz9/Zz9+'",
    "AKIA" + "A" * 12 + " AKIA" + "B" * 16 + "AKIAX 0123456789abcdef01234567",
    "password=abc password=abcdef secret=password=abcdef passwd : x",
    "😀 deadbeef" * 30,
    "",
    None,
]


@pytest.mark.parametrize("text", SECRETS)
def test_base_spans(spark, text):
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    (row,) = credentials.scan(frame).collect()
    assert sorted((s.start, s.kind, s.end) for s in row.secrets.base) == base_spans(text or "")


def test_base_spans_of_whole_table(spark):
    docs = documents()
    names = ("assign", "access", "hex")
    for r in credentials.query(spark, SMALL).collect():
        spans = base_spans(docs[r.doc_id] or "")
        listed = ",".join(f"{names[k]}:{a}:{b}" for a, k, b in spans)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()


def test_weak_parts_need_each_other(spark):
    key = "Qm9" * 14
    near = f"user=alice {key} https://db.example.com/x"
    far = "user=alice " + "pad " * 400 + key
    frame = spark.createDataFrame(
        [(1, near), (2, key), (3, far), (4, "user=alice https://db.example.com/x")],
        "doc_id long, text string",
    )
    found = {r.doc.doc_id: {s.kind for s in r.secrets.spans} for r in credentials.scan(frame).collect()}
    assert found == {1: {3, 4, 5}, 2: set(), 3: set(), 4: set()}
    masked = credentials.scan(frame).filter("doc.doc_id = 1")
    text = masked.select(credentials.masked(F.col("doc.text"), F.col("secrets.spans"))).first()[0]
    assert text == "<ident> <key> <endpoint>"


def test_scan_on_messy_rows(spark):
    assert credentials.scan(messy(spark)).count() == len(messy_rows())
    assert credentials.scan(none(spark)).count() == 0


def test_url_parts_and_rules(spark):
    urls = [
        "http://A.Example.NET/en/x?q#f", "https://example.com", "https://x.example.com/de/1",
        "ftp://fr.org?x=/fr/", "http://a.org/fr/", "no scheme", None, "http://net/", "http://anet/x",
        "http://example.net:80/en/", "a://b://c/d",
    ]
    rows = [(i, u, None, "x", "y") for i, u in enumerate(urls)]
    schema = "page_id long, url string, html string, host string, page string"
    got = {}
    for r in link_trust.judge(spark.createDataFrame(rows, schema)).collect():
        got[r.page.page_id] = tuple(r.filter)[:4]
    assert got[0] == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert got[1][:3] == ("example.com", "", None)
    assert got[2] == ("x.example.com", "/de/1", "example.com/de/", "block")
    assert got[3][:3] == ("fr.org", "", None)
    assert got[4] == ("a.org", "/fr/", "org/fr/", "allow")
    assert got[5] == got[6] == ("", "", None, "allow")
    assert got[7] == ("net", "/", "net/", "block")
    assert got[8][:3] == ("anet", "/x", None)
    assert got[9][:3] == ("example.net:80", "/en/", None)
    assert got[10][:3] == ("b:", "//c/d", None)
    assert link_trust.judge(spark.createDataFrame([], schema)).count() == 0


def test_distrust_reaches_hosts_that_link_to_blocked_ones(spark):
    link = lambda *hosts: "".join(f'<a href="http://{h}/x">' for h in hosts)
    rows = [(i, f"http://bad{i}.net/x", "") for i in range(3)]
    rows += [(10, "http://farm.io/a", link("bad0.net", "bad1.net", "bad2.net", "bad2.net"))]
    rows += [(20 + i, f"http://n{i}.io/a", link("n1.io")) for i in range(20)]
    rows += [(50, "http://good.org/fr/", link("n2.io")), (51, "http://n2.io/", link("bad0.net"))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page.page_id: r.filter.verdict for r in link_trust.judge(pages).collect()}
    assert got[10] == "block" and got[51] == "allow"
    assert all(got[20 + i] == "allow" for i in range(20))


def test_dense_index_has_no_gaps(spark):
    rows = spark.range(500).withColumn("k", F.when(F.col("id") < 400, 0).otherwise(F.col("id") % 3))
    for buckets in (1, 7):
        got = dense_index(rows, ["k"], F.xxhash64("id"), "at", buckets).collect()
        for k in {r.k for r in got}:
            at = sorted(r.at for r in got if r.k == k)
            assert at == list(range(len(at)))


def test_weak_spans_around_strong_ones_are_kept(spark):
    key = "Qm9" * 10 + "0123456789abcdef01234567" + "Zz/+"
    texts = [
        "user=alice near mongodb://admin:Pw1@db.example.com/x?token=abcdef12",
        f"user=alice {key}.",
        "user=alice token=" + "Qm9" * 14,
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = credentials.scan(frame).select(
        "doc.doc_id", "secrets.spans", credentials.masked(F.col("doc.text"), F.col("secrets.spans")).alias("clean")
    )
    by = {r.doc_id: r for r in got.collect()}
    kinds = {i: {s.kind for s in r.spans} for i, r in by.items()}
    assert kinds == {0: {0, 3, 5}, 1: {2, 3, 4}, 2: {0, 3}}
    assert by[0].clean == "<ident> near <endpoint>"
    assert by[1].clean == "<ident> <key>."
    assert by[2].clean == "<ident> <assign>"


def ranks(links, seeds, damping=0.85):
    """Personalised PageRank by a dense solve; mass without an edge goes back to the seeds."""
    hosts = sorted({h for e in links for h in e} | set(seeds))
    at = {h: i for i, h in enumerate(hosts)}
    move = np.zeros((len(hosts), len(hosts)))
    for (a, b), n in links.items():
        move[at[b], at[a]] += n / sum(m for (x, _), m in links.items() if x == a)
    y = np.linalg.solve(np.eye(len(hosts)) - damping * move, [seeds.get(h, 0.0) for h in hosts])
    return dict(zip(hosts, y / y.sum()))


def test_ranks_equal_a_dense_solve_far_from_the_seeds(spark):
    """A chain longer than any fixed number of rounds, a cycle, links without a scheme, repeats."""
    chain = [f"c{i}.io" for i in range(14)]
    links = {(a, b): 1 for a, b in zip(chain, [*chain[1:], "bad.net"])}
    links |= {("x.io", "y.io"): 1, ("y.io", "x.io"): 1, ("y.io", "bad.net"): 1, ("good.org", "x.io"): 1}
    urls = {"bad.net": "http://bad.net/", "good.org": "http://good.org/fr/"}
    rows = []
    for host in sorted({h for e in links for h in e}):
        html = "".join(f'<img src="//{b}/i">' if b == "bad.net" else f"<a href='http://{b}/x'>" for a, b in links if a == host)
        rows.append((len(rows), urls.get(host, f"http://{host}/p"), f"{html} <form action=/local>" + "text " * 30_000 * (host == "x.io")))
    pages = spark.createDataFrame([*rows, rows[0]], "page_id long, url string, html string")
    got = {r["filter"].host: (r["filter"].trust, r["filter"].distrust) for r in link_trust.judge(pages).collect()}
    trust = ranks(links, {"good.org": 1.0})
    back = {}
    for (a, b), n in links.items():
        back[b, a] = back.get((b, a), 0) + n * (2 if a == "bad.net" else 1)
    distrust = ranks(back, {"bad.net": 1.0})
    for host, (good, bad) in got.items():
        assert abs(good - trust.get(host, 0.0)) < 1e-4 and abs(bad - distrust.get(host, 0.0)) < 1e-4
    assert all(got[a][1] < got[b][1] for a, b in zip(chain, chain[1:]))
    assert got["c0.io"][1] > 0


def linked(text, reach=200):
    """Weak spans in scopes by plain code: all parts against all scopes."""
    def spans(kind, pattern):
        return [(m.start(), m.end(), kind) for m in re.finditer(pattern, text)]

    strong = [(a, b, k) for a, b, k in (
        [(m.start(), m.end(), 0) for m in re.finditer(credentials.ASSIGN, text) if len(m.group(2)) >= 6]
        + spans(1, credentials.ACCESS) + spans(2, credentials.HEX)
    )]
    if not re.search(credentials.ACCESS, text) and not re.search(credentials.IDENT, text):
        return set()
    weak = spans(3, credentials.IDENT) + spans(4, credentials.KEY) + spans(5, credentials.ENDPOINT)
    weak = [w for w in weak if not any(a <= w[0] and w[1] <= b for a, b, _ in strong)]
    scopes = []
    for a, b, _ in sorted((max(0, a - reach), b + reach, k) for a, b, k in strong + weak if k in (1, 3)):
        if scopes and a <= scopes[-1][1]:
            scopes[-1][1] = max(scopes[-1][1], b)
        else:
            scopes.append([a, b])
    out = set()
    for low, high in scopes:
        inside = [s for s in strong + weak if s[0] <= high and s[1] >= low]
        if any(k in (0, 2, 4) for _, _, k in inside):
            out |= {w for w in weak if w in inside}
    return out


def test_linked_spans_against_plain_code(spark):
    r = random.Random(9)
    parts = ["user=alice", "AKIAABCDEFGH12", "Qm9" * 14, "Zz9/" * 120, "https://h.example/x", "token=abcdef12", "words", "Account: bob_1"]
    texts = ["".join(r.choice(parts) + " " * r.choice([1, 5, 90, 210]) for _ in range(r.randrange(1, 9))) for _ in range(150)]
    texts += ["Qm9/" * 100 + " user=alice", "user=alice" + " " * 195 + "Qm9/" * 30, "user=bob1 " + "x" * 300 + " " + "Qm9/" * 30]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in credentials.scan(frame).collect():
        got = {(s.start, s.end, s.kind) for s in row.secrets.spans if s.kind > 2}
        assert got == linked(texts[row.doc.doc_id]), texts[row.doc.doc_id]
    assert any(linked(t) for t in texts[-3:])
