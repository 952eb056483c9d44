import random

import numpy as np
import pytest

from cases import SMALL, documents, edited, messy, messy_rows, none, prose
from genopile.llm import shingle_join
from genopile.llm.count_vectors import Bands, Jaccard, RTree, U, count_vector, points
from genopile.llm.shingle_join import Joining, without


def sets_of(texts):
    out = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        grams = {tuple(w[j : j + 4]) for j in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)}
        out[i] = grams if w else set()
    return out


def brute(texts):
    """id -> (set size, smallest id reachable by links)."""
    sets = sets_of(texts)
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and both and 100 * both >= 85 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def joined(spark, texts, options=Joining()):
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = shingle_join.join(frame, options=options).collect()
    assert len(rows) == len(texts)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in rows}


def family(seed, copies, words, edits):
    base = prose(seed, words)
    return [base, *(edited(base, seed * 1000 + i, edits) for i in range(copies))]


def test_whole_table(spark):
    docs = documents()
    rows = shingle_join.query(spark, SMALL).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute(docs)


@pytest.mark.parametrize("block", [512, 8])
def test_near_threshold_families(spark, block):
    """Pairs on both sides of the threshold, groups that hang together by chains, small blocks."""
    texts = []
    for seed, (copies, words, edits) in enumerate(
        [(30, 200, 2), (30, 200, 4), (30, 200, 5), (12, 60, 1), (12, 30, 1), (8, 12, 1), (6, 8, 1), (20, 900, 15)]
    ):
        texts += family(seed, copies, words, edits)
    chain = prose(99, 150)
    for i in range(15):
        texts.append(chain)
        chain = edited(chain, i, 2)
    random.Random(5).shuffle(texts)
    texts = dict(enumerate(texts + ["a", "A", "a b", "", None, " ", "a b c d", "a b c d"]))
    assert joined(spark, texts, Joining(block=block, task_rows=64)) == brute(texts)


def test_shared_passage_links_nothing(spark):
    passage = prose(3, 40)
    texts = {i: prose(500 + i, 20) + " " + passage for i in range(60)}
    assert joined(spark, texts) == brute(texts)


def test_messy_rows(spark):
    rows = shingle_join.join(messy(spark)).collect()
    assert len(rows) == len(messy_rows())
    want = brute({r[0]: r[1] for r in messy_rows() if r[0] is not None})
    for r in rows:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id) == want[r.doc_id]
    assert shingle_join.join(none(spark)).count() == 0


def test_one_id_with_several_texts(spark):
    a, b = prose(1, 100), prose(2, 100)
    rows = [(1, a), (1, b), (2, edited(a, 1, 1)), (3, edited(b, 1, 1)), (3, edited(b, 1, 1))]
    got = shingle_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(1, 1), (1, 1), (2, 1), (3, 1), (3, 1)]


def test_linked_sets_share_a_signature():
    """The pigeonhole bound: random pairs at the edge of the threshold, of any size."""
    rule, bands, r = Jaccard(), Bands(Jaccard()), np.random.default_rng(1)
    for _ in range(3000):
        n = int(r.integers(1, 400)) if r.random() < 0.8 else int(r.integers(400, 3000))
        a = np.unique(r.integers(0, 2**63, n).astype(np.uint64))
        drop = int(r.integers(0, 1 + n // 8))
        extra = r.integers(0, 2**63, int(r.integers(0, 1 + n // 8))).astype(np.uint64)
        b = np.unique(np.concatenate([a[drop:], extra]))
        both = len(np.intersect1d(a, b))
        if not len(b) or not rule.links(len(a), len(b), both) or np.array_equal(a, b):
            continue
        assert both >= rule.overlap(len(a) + len(b))
        assert np.intersect1d(bands.signatures(a), bands.signatures(b)).size


def telling(sigs, drops, order):
    """Signatures left when the first ones of either bit, in a common order, are dropped."""
    left = set()
    for bit in (0, 1):
        mine = sorted((s for s in sigs.tolist() if s & 1 == bit), key=lambda s: order.setdefault(s, len(order)))
        left.update(mine[max(0, drops[bit]) :])
    return left


def test_linked_sets_share_a_signature_after_the_common_ones_went():
    """Shared signatures come first in the order, so as many of them go as may."""
    r = np.random.default_rng(3)
    for rule in (Jaccard(), Jaccard(80, 100)):
        bands = Bands(rule)
        for _ in range(1500):
            n = int(r.integers(1, 400)) if r.random() < 0.8 else int(r.integers(400, 3000))
            a = np.unique(r.integers(0, 2**63, n).astype(np.uint64))
            drop = int(r.integers(0, 1 + n // 6))
            extra = r.integers(0, 2**63, int(r.integers(0, 1 + n // 6))).astype(np.uint64)
            b = np.unique(np.concatenate([a[drop:], extra]))
            if not len(b) or not rule.links(len(a), len(b), len(np.intersect1d(a, b))) or np.array_equal(a, b):
                continue
            (x, few_x), (y, few_y) = bands.signed(a), bands.signed(b)
            order = {s: i for i, s in enumerate(np.intersect1d(x, y).tolist())}
            assert telling(x, few_x, order) & telling(y, few_y, order)


def test_tree_loses_no_pair():
    rule, r = Jaccard(), np.random.default_rng(2)
    base = r.integers(0, 2**63, 200).astype(np.uint64)
    sets = []
    for _ in range(150):
        keep = base[r.random(200) > r.choice([0.02, 0.1, 0.3])]
        sets.append(np.unique(np.r_[keep, r.integers(0, 2**63, int(r.integers(0, 20))).astype(U)]))
    at = points([count_vector(s) for s in sets])
    sizes = np.array([len(s) for s in sets])
    tree = RTree(at, sizes, np.arange(150))
    query, row, bound = tree.search(at, sizes, np.arange(150), rule)
    found = set(zip(query.tolist(), row.tolist()))
    assert all(np.minimum(at[i], at[j]).sum() == b for i, j, b in zip(query, row, bound))
    for i, s in enumerate(sets):
        for j, t in enumerate(sets):
            if j != i and rule.links(len(s), len(t), len(np.intersect1d(s, t))):
                assert (i, j) in found
    # Within one component nothing is returned.
    assert not len(RTree(at, sizes, np.zeros(150, int)).search(at, sizes, np.zeros(150, int), rule)[0])


def hot_texts():
    """Very many texts that share most of their words and are not linked, and a few linked pairs."""
    passage = prose(3, 40)
    texts = [f"{prose(500 + i, 24)} {passage}" for i in range(500)]
    return dict(enumerate(texts + [edited(t, i, 1) for i, t in enumerate(texts[:40])]))


@pytest.mark.parametrize("options", [{}, {"hot": 1000}])
def test_no_group_grows_with_a_hot_head(spark, monkeypatch, options):
    search = shingle_join._search_trees

    def bounded(*args):
        run = search(*args)

        def checked(rows):
            keys = [c for c in ("head", "block", "part") if c in rows]
            assert rows.groupby([*keys, "asks"]).size().max() <= 32
            return run(rows)

        return checked

    monkeypatch.setattr(shingle_join, "_search_trees", bounded)
    texts = hot_texts()
    assert joined(spark, texts, Joining(block=8, task_rows=64, **options)) == brute(texts)


def test_rare_tokens_part_a_hot_head(spark):
    texts, options = hot_texts(), Joining()
    frame = spark.createDataFrame([(i, t.encode(), False) for i, t in texts.items()], "id long, text binary, many boolean")
    schema = "id long, many boolean, node long, n long, counts binary, tokens binary"
    tokens = frame.mapInArrow(shingle_join._tokens(options), schema)
    node = {r.id: r.node for r in tokens.select("id", "node").collect()}
    nodes = tokens.select("node", tokens["node"].alias("comp"))
    heads = {}
    for r in shingle_join._by_rare_tokens(nodes, tokens, options).collect():
        heads.setdefault(r.head, set()).add(r.node)
    assert max(map(len, heads.values())) <= 4
    for i in range(40):
        if brute({0: texts[i], 1: texts[500 + i]})[1][1] == 0:
            assert any({node[i], node[500 + i]} <= h for h in heads.values())


def test_rows_left_out_are_told_by_a_bitmap_and_compared(spark):
    import contextlib
    import io

    rows = spark.range(400).selectExpr("if(id % 50 = 0, null, id) as k", "repeat('x', 50) as text")
    gone = spark.createDataFrame([(None,), (7,), (7,), (11,), (900,)], "k long")
    want = sorted(r.k for r in rows.collect() if r.k not in (None, 7, 11))
    for options in (Joining(), Joining(few=0), Joining(few=0, filter_bits=0)):
        got = without(rows, gone, "k", options)
        assert sorted(r.k for r in got.collect()) == want and got.columns == ["k", "text"]
    plan = io.StringIO()
    with contextlib.redirect_stdout(plan):
        without(rows, gone, "k", Joining(few=0)).explain()
    # Only rows that the bitmap lets pass meet the join.
    assert "maybe" in plan.getvalue() and "Union" in plan.getvalue()
    empty = gone.filter("k > 1000")
    assert without(rows, empty, "k", Joining(few=0)).count() == 400
