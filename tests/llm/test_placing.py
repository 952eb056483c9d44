import collections
import json
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cases import SMALL, documents, messy, messy_rows, none, prose
from genopile.llm import mixing, packing, sharding, tool_calls
from genopile.llm.mixing import Mixing
from genopile.llm.packing import Packing
from genopile.llm.sharding import Shards


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.tokenizer_path())


def check_packing(rows, texts, tokenizer, size=4096):
    """Pieces rebuild every document; sequences have no gaps and fit."""
    pieces = collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    want = collections.Counter()
    for i, t in texts:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        for n, at in enumerate(range(0, len(ids), size)):
            part = ids[at : at + size]
            want[i, n, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert pieces == want
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return len(sequences)


def test_packing_of_whole_table(spark, tokenizer):
    docs = documents()
    rows = packing.query(spark, SMALL).collect()
    n = check_packing(rows, docs.items(), tokenizer)
    assert n <= 1.05 * sum(r.length for r in rows) / 4096 + 1


def test_packing_in_rounds(spark, tokenizer):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    options = Packing(group_tokens=1 << 15, open_bins=4)
    rows = packing.pack(docs, packing.tokenizer_path(), options=options).collect()
    check_packing(rows, documents().items(), tokenizer)


def test_packing_messy_rows(spark, tokenizer):
    rows = packing.pack(messy(spark), packing.tokenizer_path()).collect()
    check_packing(rows, [(r[0], r[1]) for r in messy_rows()], tokenizer)
    assert packing.pack(none(spark), packing.tokenizer_path()).count() == 0


ODD = [
    "a <|endoftext|> B<|startoftext|>x <|ENDOFTEXT|>", "It's I'M don't ''s 'll", "Å İ i̇ ΑΣ ﬁ K",
    "1.2,3 (x) --- a-b_c !!. —. é. ≠ a≠ ≮ ≠", "foo\x0bbar\x85baz\u00a0q\u3000w\x1cz\u2028v", "日本語 テスト", "\x00 \ufffd",
]


@pytest.mark.parametrize("text", ODD)
def test_chunks_give_the_same_ids(text, tokenizer):
    ids = packing.ChunkIds(packing.tokenizer_path(), limit=2)
    for _ in range(2):
        (got,) = ids.of([text.encode()])
        assert got.tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_best_fit_takes_the_tightest_and_closes_the_fullest():
    options = Packing(size=10, open_bins=2)
    bins, offsets, _ = packing.best_fit([6, 7, 3, 4, 8, 1], options)
    # 3 fills the bin of 7, 4 the bin of 6, 1 joins 8.
    assert (bins, offsets) == ([0, 1, 1, 0, 2, 2], [0, 0, 7, 6, 0, 8])
    bins, _, free = packing.best_fit([6, 7, 8, 2], options)
    assert bins == [0, 1, 2, 1] and free[2] == 2


def placed(spark, frame, options=Shards()):
    rows = sharding.assign(frame, options=options).collect()
    counts = collections.Counter(r.place.shard for r in rows)
    held = [counts.get(i, 0) for i in range(options.count)]
    assert max(held) - min(held) <= 1
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r.place.shard].append(r.place.slot)
        raw = (r.doc.text or "").encode()
        assert (r.place.size, r.place.text_crc32) == (len(raw) + 1, zlib.crc32(raw))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return rows


def test_shards_keep_copies_together(spark):
    texts = [prose(i, 5) for i in range(900)] + [f"copy {i % 40}" for i in range(200)] + ["hot"] * 550
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = placed(spark, frame, Shards(group_rows=100))
    where = collections.defaultdict(set)
    for r in rows:
        where[r.doc.text].add(r.place.shard)
    assert sum(len(where[f"copy {i}"]) > 1 for i in range(40)) <= 2
    assert len(where["hot"]) <= 8


def test_shards_of_messy_rows(spark):
    assert len(placed(spark, messy(spark))) == len(messy_rows())
    assert sharding.assign(none(spark)).count() == 0
    assert len(sharding.query(spark, SMALL).collect()) == len(documents())


def test_mixing_uses_every_row_and_meets_the_limit(spark):
    rows = [(i, prose(i, 20), "big" if i % 10 else "small") for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(frame, options=Mixing(max_epochs=2.5, block_tokens=400, group_rows=50)).collect()
    seen = collections.Counter(r.doc.doc_id for r in got)
    assert set(seen) == set(range(400))
    assert {seen[i] for i in range(400) if i % 10} == {1}
    assert {seen[i] for i in range(0, 400, 10)} == {2, 3}
    tokens = collections.Counter()
    for r in got:
        tokens[r.doc.source] += r.mix.tokens
    weights = {r.doc.source: r.mix.weight for r in got}
    assert abs(tokens["small"] / sum(tokens.values()) - weights["small"]) < 0.01
    # Every block holds each source in proportion, within one document.
    blocks = collections.defaultdict(collections.Counter)
    for r in got:
        blocks[r.mix.block][r.doc.source] += r.mix.tokens
    per = sum(tokens.values()) / len(blocks)
    for b in blocks.values():
        assert all(abs(b[s] - per * weights[s]) <= 41 for s in weights)


def test_entropy_target(spark):
    rows = [(i, prose(i, 10), f"s{min(i % 16, 3)}") for i in range(320)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(frame, options=Mixing(target_entropy=0.9)).collect()
    w = np.array(list({r.doc.source: r.mix.weight for r in got}.values()))
    assert abs(-(w * np.log(w)).sum() / np.log(len(w)) - 0.9) < 1e-3


def test_mixing_messy_rows(spark):
    got = mixing.mix(messy(spark)).collect()
    first = collections.Counter((r.doc.doc_id, r.doc.text) for r in got if r.mix.epoch == 0)
    assert first == collections.Counter((r[0], r[1]) for r in messy_rows())
    assert mixing.mix(none(spark)).count() == 0
    assert {r.doc_id for r in mixing.query(spark, SMALL).collect()} == set(documents())


CHAT = "conv_id string, turn long, role string, text string, id string, event string, kind string"


def chat(spark, rows):
    frame = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], CHAT)
    return tool_calls.link(frame, tool_calls.REPLY).collect()


def test_calls_are_linked_ordered_and_checked(spark):
    call = lambda i, name, args, after=(): {"id": i, "name": name, "arguments": args, "after": list(after)}
    rows = [
        ("c", 0, "assistant", json.dumps({"tool_calls": [
            call("a", "reply", {"words": 1, "text": 'x\n"é'}, ["b"]),
            call("b", "note", {"text": 1, "z": [1, {"b": 1, "a": 2.5}]}),
            call("b", "gone", {}),
            call("e", "gone", {}),
            call("f", "note", "q"),
        ]})),
        ("c", 1, "tool", json.dumps({"tool_call_id": "a", "content": {"k": [1, 2]}})),
        ("c", 2, "tool", json.dumps({"tool_call_id": "a", "content": "again"})),
        ("c", 3, "tool", json.dumps({"tool_call_id": "q", "content": None})),
        ("c", 4, "user", None),
        ("d", 0, "assistant", json.dumps({"tool_calls": [call("x", "note", {}, ["y"]), call("y", "note", {}, ["x"])]})),
        (None, None, None, "{bad"), ("c", 5, "assistant", "{bad"), ("c", 6, "tool", ""),
    ]
    got = chat(spark, rows)
    by = {(r.row.conv_id, r.chat.ord): r.chat for r in got}
    step = 1 << 20
    assert by["c", 0].status == "linked" and by["c", 0].errors == []
    assert by["c", 0].level > by["c", 1].level
    assert by["c", 1].errors == ["type:text", "extra:z"] and by["c", 1].status == "pending"
    assert by["c", 2].status == "duplicate" and by["c", 2].errors == ["unknown tool"]
    assert by["c", 4].errors == ["bad arguments"]
    assert [by["c", i * step].status for i in (1, 2, 3, 4)] == ["linked", "duplicate", "orphan", "message"]
    assert by["d", 0].status == by["d", 1].status == "cyclic"
    assert by["c", 5 * step].kind == by["c", 6 * step].kind == "message"
    for r in got:
        line = json.loads(r.chat.json)
        assert json.dumps(line, sort_keys=True, separators=(",", ":"), ensure_ascii=False) == r.chat.json
    assert chat(spark, []) == []


def test_long_chains_against_the_order(spark):
    n = 12
    calls = [{"id": f"k{i}", "name": "note", "arguments": {"text": "t"}, "after": [f"k{i + 1}"]} for i in range(n)]
    got = chat(spark, [("c", 0, "assistant", json.dumps({"tool_calls": calls}))] * 2)
    first = {r.chat.call_id: r.chat.level for r in got if r.chat.status != "duplicate"}
    assert all(first[f"k{i}"] > first[f"k{i + 1}"] for i in range(n - 1))


def test_chat_of_whole_table(spark):
    talks = spark.read.parquet(f"{SMALL}/conversations.parquet").collect()
    got = tool_calls.query(spark, SMALL).collect()
    assert len(got) == len(talks)
    text = {(r.conv_id, r.turn): r.text for r in talks}
    roles = {(r.conv_id, r.turn): r.role for r in talks}
    for r in got:
        line = json.loads(r.json)
        said = line["arguments"]["text"] if r.kind == "call" else line["content"]
        assert said == (text[r.conv_id, r.turn] or ("" if r.kind != "message" else None))
        if r.kind == "result":
            linked = roles.get((r.conv_id, r.turn - 1)) == "assistant"
            assert r.status == ("linked" if linked else "orphan")


def limited(monkeypatch, most):
    """Lets the operator write so many tables, which bounds its rounds."""
    write, names = tool_calls.materialize, []

    def counted(frame, name):
        names.append(name)
        assert len(names) <= most
        return write(frame, name)

    monkeypatch.setattr(tool_calls, "materialize", counted)


def noted(*calls):
    made = [{"id": i, "name": "note", "arguments": {"text": "t"}, "after": list(after)} for i, after in calls]
    return json.dumps({"tool_calls": made})


def test_cycle_in_a_conversation_of_several_turns(spark, monkeypatch):
    limited(monkeypatch, 30)
    rows = [
        ("c", 0, "assistant", noted(("x", ["y"]), ("y", ["x"]), ("w", ["x"]), ("p", ["q"]))),
        ("c", 1, "assistant", noted(("z", ["p"]), ("q", []))),
        ("c", 2, "tool", json.dumps({"tool_call_id": "p", "content": 1})),
        ("c", 3, "tool", json.dumps({"tool_call_id": "w", "content": 1})),
    ]
    by = {(r.chat.kind, r.chat.call_id): r.chat for r in chat(spark, rows)}
    step = 1 << 20
    assert {k for k, c in by.items() if c.status == "cyclic"} == {
        ("call", "x"), ("call", "y"), ("call", "w"), ("result", "w")
    }
    assert all(c.level == c.ord for c in by.values() if c.status == "cyclic")
    levels = [by["call", i].level for i in "qpz"] + [by["result", "p"].level]
    assert levels == [step + 1, step + 2, step + 3, 2 * step]


def test_levels_against_plain_code(spark, monkeypatch):
    limited(monkeypatch, 60)
    r = np.random.default_rng(3)
    rows, want = [], {}
    for conv in range(40):
        n = int(r.integers(2, 9))
        turn = np.sort(r.integers(0, 3, n))
        after = {i: [int(x) for x in r.integers(0, n, int(r.integers(0, 3))) if x != i] for i in range(n)}
        place = {}
        for t in sorted(set(turn.tolist())):
            held = np.flatnonzero(turn == t).tolist()
            place |= {i: (t << 20) + k for k, i in enumerate(held)}
            rows.append((f"c{conv}", t, "assistant", noted(*((f"k{i}", [f"k{x}" for x in after[i]]) for i in held))))
        level = {}
        for _ in range(n):
            for i in set(after) - set(level):
                if all(x in level for x in after[i]):
                    level[i] = max([place[i], *(level[x] + 1 for x in after[i])])
        want |= {(f"c{conv}", f"k{i}"): (level.get(i, place[i]), i not in level) for i in after}
    got = {(x.row.conv_id, x.chat.call_id): (x.chat.level, x.chat.status == "cyclic") for x in chat(spark, rows)}
    assert got == want and 20 < sum(c for _, c in want.values()) < len(want) - 20
