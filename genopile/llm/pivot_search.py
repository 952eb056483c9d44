"""Exact top-k inner products by pivot elimination.

Distances to a fixed number of pivots are stored with every vector.  By the triangle inequality
the largest difference of two vectors' pivot distances is a lower bound of their own distance,
which gives an upper bound of their inner product.  Blocks of queries meet blocks of candidates;
in each meeting a query's candidates are evaluated in the order of their bounds until its k-th
score beats every bound that is left.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from genopile.llm.common import of_lowest, table
from genopile.storage import materialize


@dataclass(frozen=True)
class Pivots:
    k: int = 5
    pivots: int = 16
    # Rows the pivots are chosen from (those of the smallest hashes): a bounded sample, which
    # decides speed only.
    sample: int = 512
    query_block: int = 1024
    candidate_block: int = 8192
    # Candidates evaluated together.
    step: int = 256


def integer_vector(vector: Column) -> Column:
    """``floor(256 * x)`` of every component; null where the vector takes no part."""
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")),
    )
    scaled = F.transform(vector, lambda x: F.floor(F.lit(256.0) * x.cast("double")).cast("bigint"))
    return F.when(finite, scaled)


def choose_pivots(vectors: DataFrame, options: Pivots) -> np.ndarray:
    """Far-apart vectors of a bounded sample: each next one is farthest from those chosen."""
    few = of_lowest(vectors, F.xxhash64("id"), options.sample)
    rows = few.orderBy(F.xxhash64("id"), "id").limit(options.sample).collect()
    if not rows:
        return np.empty((0, 0))
    width = max(len(r["v"]) for r in rows)
    sample = np.array([r["v"] for r in rows if len(r["v"]) == width], dtype=np.float64)
    chosen = [sample[0]]
    near = ((sample - chosen[0]) ** 2).sum(1)
    while len(chosen) < min(options.pivots, len(sample)):
        chosen.append(sample[int(near.argmax())])
        near = np.minimum(near, ((sample - chosen[-1]) ** 2).sum(1))
    return np.array(chosen)


def _distances(pivots: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            out = []
            for v in batch.column(1).to_pylist():
                v = np.array(v, dtype=np.float64)
                same = pivots.size and len(v) == pivots.shape[1]
                out.append(np.sqrt(((pivots - v) ** 2).sum(1)) if same else np.empty(0))
            yield pa.RecordBatch.from_pydict(
                {
                    "id": batch.column(0),
                    "v": batch.column(1),
                    "q": batch.column(2),
                    "far": pa.array([x.tolist() for x in out], pa.list_(pa.float64())),
                }
            )

    return run


def best(
    queries: pd.DataFrame, candidates: pd.DataFrame, options: Pivots
) -> Iterator[tuple[int, int, int]]:
    """(query, candidate, score) of the k best of every query; vectors of one width."""
    ids = candidates["id"].to_numpy(np.int64)
    x = np.array(candidates["v"].tolist(), dtype=np.int64)
    far = np.array(candidates["far"].tolist(), dtype=np.float64)
    norms = (x * x).sum(1)
    # Whole products are exact in doubles below 2**53.
    exact = float(np.abs(x).max(initial=0)) ** 2 * max(1, x.shape[1]) < 2**52
    fast = x.astype(np.float64) if exact else x
    for query, v, q_far in zip(queries["id"], queries["v"], queries["far"]):
        q = np.array(v, dtype=np.int64)
        bound = np.full(len(ids), np.inf)
        if len(q_far) and far.size:
            least = np.zeros(len(ids))
            for p in range(far.shape[1]):
                np.maximum(least, np.abs(far[:, p] - q_far[p]), out=least)
            # Distances carry rounding errors, far below this slack.
            least = np.maximum(0.0, least * (1 - 1e-9) - 1e-6)
            bound = (float((q * q).sum()) + norms - least * least) / 2 + 1e-3
        order = np.argsort(-bound, kind="stable")
        top: list[tuple[int, int]] = []  # (-score, id), best first
        fit = exact and float(np.abs(q).max(initial=0)) ** 2 * max(1, len(q)) < 2**52
        for at in range(0, len(order), options.step):
            if len(top) >= options.k and -top[-1][0] > bound[order[at]]:
                break
            part = order[at : at + options.step]
            scores = (fast[part] @ q.astype(np.float64)).astype(np.int64) if fit else x[part] @ q
            for place in np.lexsort((ids[part], -scores)):
                one = (-int(scores[place]), int(ids[part[place]]))
                if one[1] == query:
                    continue
                if len(top) >= options.k and one >= top[-1]:
                    break
                top.append(one)
                top.sort()
                del top[options.k :]
        for score, other in top:
            yield int(query), other, -score


def _meet(options: Pivots):
    schema = {"query_id": "int64", "vec_id": "int64", "score": "int64"}

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        queries, candidates = rows[rows["asks"]], rows[~rows["asks"]]
        found = list(best(queries, candidates, options)) if len(queries) and len(candidates) else []
        return pd.DataFrame(found, columns=list(schema)).astype(schema)

    return run


def _range(n: int) -> Column:
    return F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint"))


def search(
    vectors: DataFrame, is_query: Column, id: str, vector: str, options: Pivots = Pivots()
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the k highest integer inner products.

    Vectors that are null, or hold null or non-finite components, and rows with a null id take no
    part.  Vectors meet only vectors of their own length; two empty vectors score 0.  Repeated
    rows of one id count once (the smallest vector).  An empty table gives an empty result.

    The number of blocks follows from counts; a block is bounded, whatever the ids.  Queries
    are a stated set, met with all candidates in blocks; each meeting returns k rows a query.
    """
    held = F.col(f"`{vector}`")
    rows = (
        vectors.withColumn("_q", F.coalesce(is_query, F.lit(False)))
        .select(
            F.col(f"`{id}`").cast("bigint").alias("id"), integer_vector(held).alias("v"), "_q"
        )
        .filter("id is not null and v is not null")
        .groupBy("id")
        .agg(F.min("v").alias("v"), F.max("_q").alias("q"))
    )
    rows = materialize(rows, "vectors")
    pivots = choose_pivots(rows, options)
    far = materialize(
        rows.select("id", "v", "q").mapInArrow(
            _distances(pivots), "id long, v array<long>, q boolean, far array<double>"
        ),
        "pivot-distances",
    )
    row = rows.agg(F.count(F.lit(1)), F.count_if("q")).first()
    n_candidates = max(1, -(-row[0] // options.candidate_block))
    n_queries = max(1, -(-(row[1] or 0) // options.query_block))
    columns = ["id", "v", "far", F.size("v").alias("width")]
    asked = far.filter("q").select(
        *columns,
        F.lit(True).alias("asks"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(n_queries)).alias("qb"),
        F.explode(_range(n_candidates)).alias("cb"),
    )
    given = far.select(
        *columns,
        F.lit(False).alias("asks"),
        F.explode(_range(n_queries)).alias("qb"),
        F.pmod(F.xxhash64("id", F.lit(2)), F.lit(n_candidates)).alias("cb"),
    )
    found = (
        asked.unionByName(given)
        .groupBy("width", "qb", "cb")
        .applyInPandas(_meet(options), "query_id long, vec_id long, score long")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= options.k)
        .select("query_id", "rank", "vec_id", "score")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return search(vectors, F.col("vec_id") % 50 == 0, "vec_id", "embedding")
