import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from cases import SMALL
from genopile.llm import conversation_repair as cr

LEGAL = re.compile(r"(s?(ua)+)?")
FULL = {"u": "user", "a": "assistant"}
COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        words = text.strip(cr.BLANKS)
        if not words:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if words[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows):
    """Least (cost, audit) with the repaired messages, by all prefixes of the legal sentences."""
    # What has been written so far as initials, folded to what decides the rest.
    def state(s):
        return {"": "", "s": "s"}.get(s, s[-1])

    def inserts(items):
        todo = list(items.items())
        while todo:
            s, (cost, audit, out) = todo.pop(0)
            for x in "ua":
                if (s, x) in {("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}:
                    new = (cost + 5, audit + "I", [*out, (FULL[x], "")])
                    if x not in items or new[:2] < items[x][:2]:
                        items[x] = new
                        todo.append((x, new))
        return items

    items = {"": (0, "", [])}
    for (_, role, text), fault in zip(rows, faults(rows)):
        after = {}

        def offer(s, item):
            if s not in after or item[:2] < after[s][:2]:
                after[s] = item

        for s, (cost, audit, out) in inserts(items).items():
            offer(s, (cost + 2, audit + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            more = 5 if fault == "truncated" else 0
            for x, extra, edit, name in [(role[:1], 0, "K", role), ("u", 1, "R", "user"), ("a", 1, "R", "assistant")]:
                if (s, x) in {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}:
                    offer(x, (cost + more + extra, audit + edit, [*out, (name, text)]))
        items = after
    return min((v for s, v in inserts(items).items() if s in ("", "a")), key=lambda v: v[:2])


def everything(rows, most=2):
    """As ``cheapest``, by trying all edits of very short conversations."""
    best = None
    kinds = faults(rows)
    gaps = [p for n in range(most + 1) for p in itertools.product("ua", repeat=n)]
    options = [["D"] if k in ("blank", "duplicate") else ["K", "Ru", "Ra", "D"] for k in kinds]
    for edits in itertools.product(*options):
        for filled in itertools.product(gaps, repeat=len(rows) + 1):
            cost, audit, line = 0, "", ""
            for i, edit in enumerate([*edits, ""]):
                cost, audit, line = cost + 5 * len(filled[i]), audit + "I" * len(filled[i]), line + "".join(filled[i])
                if edit:
                    cost += {"K": 0, "R": 1, "D": 2}[edit[0]] + (5 if edit != "D" and kinds[i] == "truncated" else 0)
                    audit += edit[0]
                    line += {"D": "", "K": rows[i][1][:1]}.get(edit, edit[1:])
            if LEGAL.fullmatch(line) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


def expected(rows):
    """Contract columns of one conversation, rows (turn, role, text) in order."""
    turns = [t for t, _, _ in rows if t is not None]
    kinds = faults(rows)
    initials = [r[:1] for _, r, _ in rows]
    cost, audit, out = cheapest(rows)
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *(kinds.count(k) for k in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        cost,
        audit,
        hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest(),
    )


def talk(r, n):
    texts = ["Fine.", "Why?", "so it goes", "", "  ", "Ok!", "well,"]
    return [(i, r.choice(["user", "assistant", "system", "tool", "user", "assistant"]), r.choice(texts) + (f" {r.random()}." if r.random() < 0.6 else "")) for i in range(n)]


def test_plain_search_tries_everything():
    r = random.Random(3)
    for _ in range(60):
        rows = talk(r, r.randrange(1, 4))
        assert cheapest(rows)[:2] == everything(rows)


def test_parser_against_plain_search():
    r = random.Random(4)
    for _ in range(3000):
        rows = talk(r, r.randrange(1, 14))
        packed = [(t, role, text, not text.strip(cr.BLANKS), text.rstrip(cr.BLANKS)[-1:] in ".!?") for t, role, text in rows]
        found = cr._whole(packed, cr.Costs(), False)
        assert tuple(found[c] for c in COLUMNS) == expected(rows)


def test_pieces_join_to_the_whole():
    r = random.Random(5)
    costs = cr.Costs()
    for _ in range(400):
        rows = talk(r, r.randrange(2, 12))
        kinds = [cr.Kind(role[:1], k in ("blank", "duplicate"), k == "truncated") for (_, role, _), k in zip(rows, faults(rows))]
        cut = r.randrange(1, len(rows))
        ways = {}
        for e, entry in enumerate(cr.ENTRIES):
            parse = cr.Parse(kinds[cut:], entry, costs)
            for x, (cost, rank) in parse.exits().items():
                _, base, origins = cr.advance(((cr.ENTRIES[x], 0),), cr.END, costs)
                ways[e] = min(ways.get(e, (10**9, "")), (cost + base, "".join(parse.edits(rank)) + origins[0][1]))
        head = cr.Parse(kinds[:cut], (0,), costs)
        joined = min(
            (cost + ways[x][0], "".join(head.edits(rank)) + ways[x][1]) for x, (cost, rank) in head.exits().items()
        )
        assert joined == cheapest(rows)[:2]


def damage(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        show = lambda v: " " if v is None else str(v)
        hit = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = "user" if hit == 4 else show(role), show(text)
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        out[conv] += [] if hit == 0 else [(turn, role, text)] * (2 if hit == 3 else 1)
    for conv, found in out.items():
        found.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode()))
    return out


def wanted(rows):
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    return {conv: expected(found) if found else empty for conv, found in damage(rows).items()}


@pytest.mark.parametrize("ranges", [1, 5, 64])
def test_query_against_plain_code(spark, ranges, monkeypatch):
    monkeypatch.setattr(cr, "table", lambda s, d, n: s.read.parquet(f"{d}/{n}.parquet"))
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in cr.query(spark, SMALL).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{SMALL}/conversations.parquet'").fetchall()
    assert found == wanted(rows)


def messy(spark):
    r = random.Random(6)
    rows = [(1, t, role, text) for t, role, text in talk(r, 400)]
    rows += [(2, None, "user", "Hm."), (2, None, "user", "Hm."), (2, 2**60, "assistant", "Yes.")]
    rows += [(None, 1, "user", "A."), (None, 0, None, None), (None, None, "user", None), (3, None, None, None)]
    rows += [(4, 7, "user", "long " * 50_000 + "."), (5, 1, "", "x."), (5, 1, "user", "tie."), (5, 1, "assistant", "tie.")]
    rows += [(6, 1, "user", "Same.")] * 300
    return rows, spark.createDataFrame(
        [(*x, "extra", "extra") for x in rows], "conv_id long, turn long, role string, text string, key string, message string"
    )


@pytest.mark.parametrize("ranges", [1, 9])
def test_messy_rows(spark, ranges):
    rows, frame = messy(spark)
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = cr.repair(frame, with_messages=True)
        got = {r.key: tuple(r[c] for c in COLUMNS) for r in found.conversations.collect()}
        messages = defaultdict(list)
        for m in found.messages.orderBy("key", "piece", "place", "at").collect():
            messages[m.key].append((m.role, m.text))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn, " " if role is None else role, " " if text is None else text))
    for found in by.values():
        found.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode()))
    assert got == {conv: expected(x) for conv, x in by.items()}
    assert {k: v for k, v in messages.items()} == {conv: out for conv, x in by.items() if (out := cheapest(x)[2])}


def test_empty_table(spark):
    _, frame = messy(spark)
    found = cr.repair(frame.filter(F.lit(False)), with_messages=True)
    assert found.conversations.count() == 0 and found.messages.count() == 0
