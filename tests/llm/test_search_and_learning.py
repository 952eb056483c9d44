import numpy as np
import pytest
from pyspark.sql import functions as F

from cases import SMALL, messy, messy_rows, none
from genopile.llm import pivot_search, pu_quality
from genopile.llm.common import of_lowest
from genopile.llm.pivot_search import Pivots


def brute(rows, k=5):
    vectors = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        v = np.floor(256 * np.array(v, np.float32).astype(float)).astype(np.int64)
        vectors[i] = min(vectors.get(i, v.tolist()), v.tolist())
    out = set()
    for q, v in vectors.items():
        if q % 50:
            continue
        scores = sorted(
            (-sum(a * b for a, b in zip(v, w)), i)
            for i, w in vectors.items()
            if i != q and len(w) == len(v)
        )
        out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])}
    return out


def searched(spark, rows, options=Pivots()):
    frame = spark.createDataFrame(
        [(*r, "x", "y") for r in rows], "vec_id long, embedding array<float>, far string, asks string"
    )
    return {tuple(r) for r in pivot_search.search(frame, F.col("vec_id") % 50 == 0, "vec_id", "embedding", options).collect()}


@pytest.mark.parametrize("blocks", [(1024, 8192), (2, 37)])
def test_search_is_exact(spark, blocks):
    r = np.random.default_rng(3)
    rows = [(i, r.normal(size=8).round(2).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(20)]  # ties
    rows += [rows[3], (50, None), (100, [1.0, None]), (150, [float("nan")] * 8), (7, [float("inf")] * 8)]
    rows += [(2000, []), (2050, []), (2051, [1.0]), (2100, [0.5]), (None, [1.0] * 8)]
    options = Pivots(query_block=blocks[0], candidate_block=blocks[1], step=16)
    assert searched(spark, rows, options) == brute(rows)


def test_search_of_nothing(spark):
    assert searched(spark, [(1, [1.0])]) == set()
    assert searched(spark, [(50, None)]) == set()


def test_prior_of_a_known_mixture():
    r = np.random.default_rng(4)
    p, n = r.normal(2, 1, 3000), r.normal(-2, 1, 3000)
    u = np.concatenate([r.normal(2, 1, 1400), n[:600]])
    assert abs(pu_quality.estimate_prior(p, u) - 0.7) < 0.08


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    scored = pu_quality.query(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = scored.join(labels, "doc_id").filter("held_out").select("score", "predicted", "quality").collect()
    good = [r.score for r in rows if r.quality == 1]
    bad = [r.score for r in rows if r.quality == 0]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.97
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.9


def test_classifier_on_messy_rows(spark):
    labels = spark.createDataFrame(
        [(i, 1) for i in range(8)] + [(0, 1), (41, 0), (46, None), (None, 1)], "doc_id long, quality int"
    )
    rows = pu_quality.classify(messy(spark), labels).collect()
    assert len(rows) == len(messy_rows())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert pu_quality.classify(none(spark), labels).count() == 0
    without = pu_quality.classify(messy(spark), labels.limit(0)).collect()
    assert {r.score for r in without} == {0.5}


def test_held_out_labels_do_not_matter(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    flipped = labels.withColumn(
        "quality",
        F.when(pu_quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")),
    )
    one, two = (
        sorted((r.doc_id, r.score) for r in pu_quality.classify(docs, x).collect()) for x in (labels, flipped)
    )
    assert one == two


def test_samples_leave_the_lowest_hashes(spark):
    rows = spark.range(40_000).withColumn("h", F.xxhash64("id"))
    for n in (1, 50, 3000, 50_000):
        few = of_lowest(rows, F.col("h"), n)
        want = [r.id for r in rows.orderBy("h").limit(n).collect()]
        assert [r.id for r in few.orderBy("h").limit(n).collect()] == want
        assert few.count() <= max(1.3 * n + 1200, n) or n > 30_000
    same = rows.withColumn("h", F.lit(2**62))
    assert of_lowest(same, F.col("h"), 10).count() == 40_000
