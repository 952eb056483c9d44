import collections

import corpus_pipeline
from cases import SMALL, documents, messy, none, prose
from genopile.llm import packing
from test_native_rules import base_spans, counts
from test_placing import check_packing
from test_shingle_join import brute


def staged(spark, docs, folder, sf_dir=SMALL):
    out = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{folder}/{i}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def test_stages_against_plain_code(spark, tmp_path):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rules, near, secrets, mixed, packed = staged(spark, docs, tmp_path)
    assert all(d.columns == docs.columns for d in (rules, near, secrets, mixed))
    texts = documents()
    kept = {i for i, t in texts.items() if not counts(t)[5]}
    assert {r.doc_id for r in rules.collect()} == kept
    groups = brute({i: texts[i] for i in kept})
    left = [r.doc_id for r in near.collect()]
    assert collections.Counter(groups[i][1] for i in left) == collections.Counter(
        {c: 1 for _, c in groups.values()}
    )
    clean = {r.doc_id: r.text for r in secrets.collect()}
    assert sorted(clean) == sorted(left)
    assert all(not base_spans(t) for t in clean.values())
    assert all(clean[i] == texts[i] for i in left if not base_spans(texts[i]))
    draws = mixed.collect()
    assert {r.doc_id for r in draws} == set(left)
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    check_packing(packed.collect(), [(r.doc_id, r.text) for r in draws], tokenizer)


def test_run_is_the_stages(spark):
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert rows and set(rows[0].asDict()) >= {"doc_id", "piece", "sequence_id", "offset"}


def test_messy_and_empty_tables(spark, tmp_path):
    for name, docs in (("messy", messy(spark)), ("none", none(spark))):
        *kept, packed = staged(spark, docs, tmp_path / name)
        assert all(d.columns == docs.columns for d in kept)
        assert (packed.count() > 0) == (name == "messy")


def test_near_copies_of_five_word_shingles_from_080(spark):
    def similarity(a, b):
        x, y = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a.split(), b.split()))
        return len(x & y) / len(x | y)

    texts = []
    for seed in range(4):
        for more in (58, 62):
            base = prose(10 * seed + more, 240)
            texts += [base, f"{base} {prose(1000 + 10 * seed + more, more)}"]
        base = prose(2000 + seed, 240)
        words = base.split()
        words[30::45] = [f"w{i}" for i in range(len(words[30::45]))]
        texts += [base, " ".join(words)]
    pairs = list(zip(texts[::2], texts[1::2]))
    linked = sum(similarity(*p) >= 0.8 for p in pairs)
    assert linked == 8
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    left = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, frame, SMALL).collect()}
    for i, p in enumerate(pairs):
        assert len(left & {2 * i, 2 * i + 1}) == (1 if similarity(*p) >= 0.8 else 2)


def test_rows_alike_leave_one_and_rows_without_words_all(spark):
    rows = [(1, "same words here"), (1, "same words here"), (None, "same words here"), (2, "other text"), (2, "more of it")]
    rows += [(3, ""), (3, ""), (3, None), (None, None), (None, None), (4, " \t"), (5, "alone"), (5, "alone")]
    frame = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, _row int")
    left = corpus_pipeline.near_duplicates(spark, frame, SMALL)
    assert left.columns == frame.columns
    kept = [(r.doc_id, r.text) for r in left.collect()]
    same = [r for r in kept if r[1] == "same words here"]
    assert same == [(None, "same words here")]
    want = [r for r in rows if r[1] != "same words here"]
    want.remove((5, "alone"))
    assert sorted(map(repr, kept)) == sorted(map(repr, [*want, *same]))


def test_stages_leave_only_their_result(spark, tmp_path):
    import os

    from genopile.storage import shared_folder

    folder = f"{shared_folder(spark).removeprefix('file:')}/genopile"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    corpus_pipeline.run(spark, SMALL)
    assert [n.rsplit("-", 1)[0] for n in set(os.listdir(folder)) - before] == ["packing"]
