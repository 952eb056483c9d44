import collections
import hashlib
import re

import duckdb

from cases import SMALL, messy, none, prose
from genopile.llm import decontamination as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def expected(docs, items, size=10):
    """Contract columns by (key, text) and (item, text), window by window."""
    windows = collections.defaultdict(set)
    for item, text in items:
        w = words(text)
        n = min(size, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[i : i + n])].add("" if item is None else str(item))
    lengths = {len(w) for w in windows}
    out = []
    for key, text in docs:
        w, hit, names = words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if found := windows.get(tuple(w[i : i + n])):
                    names |= found
                    hit.update(range(i, i + n))
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((key, len(w), len(hit), len(names), digest, bool(hit)))
    return sorted(map(repr, out))


def digests(frame):
    out = []
    for r in frame.collect():
        names = r.leak["items"]
        assert names == sorted(set(names))
        digest = hashlib.sha256(",".join(names).encode()).hexdigest()
        out.append((r.doc.doc_id, r.leak.n_words, r.leak.n_hit, len(names), digest, r.leak.n_hit > 0))
    return sorted(map(repr, out))


def test_query_against_plain_code(spark):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall()
    items = duckdb.sql(f"SELECT item_id, text FROM '{SMALL}/benchmark.parquet'").fetchall()
    rows = d.query(spark, SMALL)
    assert rows.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted(repr(tuple(r)) for r in rows.collect()) == expected(docs, items)


def items_of(texts):
    return [
        (1, texts[0]),
        (1, texts[0]),
        (10, texts[0]),
        (2, "One, TWO"),
        (3, "x y z x y z x y z x y z"),
        (None, " ".join(texts[1].split()[5:17])),
        (4, None),
        (5, " .,! "),
        (6, "é"),
    ]


def test_messy_rows_and_slices(spark):
    docs = messy(spark)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    items = items_of([prose(100, 40), prose(1, 300)])
    benchmark = spark.createDataFrame([(*x, "extra") for x in items], "item_id long, text string, doc string")
    want = expected(rows, items)
    for options in (d.Decontamination(), d.Decontamination(slice_words=20), d.Decontamination(slice_words=200)):
        found = d.contamination(docs, benchmark, options=options)
        assert found.columns == ["doc", "leak"]
        assert digests(found) == want


def test_empty_tables(spark):
    docs = messy(spark)
    benchmark = spark.createDataFrame(items_of([prose(1, 20)] * 2), "item_id long, text string")
    assert d.contamination(none(spark), benchmark).count() == 0
    rows = d.contamination(docs, benchmark.limit(0)).collect()
    assert len(rows) == docs.count() and not any(r.leak.n_hit for r in rows)


def test_hits_are_cut_out_or_documents_removed(spark):
    leak = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
    rows = [
        (1, f"Clean start, {leak.upper().replace(' ', ', ')}! And a clean end that goes on for many more words than that."),
        (2, f"{leak} and little else"),
        (3, "nothing here"),
        (4, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame([(7, leak)], "item_id long, text string")
    left = {r.doc_id: r.text for r in d.decontaminated(docs, benchmark).collect()}
    assert left == {
        1: "Clean start, ! And a clean end that goes on for many more words than that.",
        3: "nothing here",
        4: None,
    }


def test_hashes_of_a_set_do_not_collide():
    rows = [(" ".join(prose(i, 10).split()), str(i % 7)) for i in range(2000)]
    found = d.WindowSet(rows, 5)
    _, hashes, words_, bounds, items = found.lengths[10]
    assert len(set(hashes.tolist())) == len(hashes) == len(words_)
    assert bounds[-1] == len(items)
