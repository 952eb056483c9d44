"""Quality classifier by positive-unlabelled learning.

Trusted positives are labelled documents; the unlabelled set stands for all documents.  An
additive model over binned text features is fitted by the non-negative unbiased risk: the
negative part of the risk, estimated from unlabelled minus positive documents, is kept from
falling below zero.  The class prior is estimated from how much of the unlabelled set the best
scores of a first classifier hold, compared with the positives.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from genopile.llm.common import of_lowest, table
from genopile.storage import materialize

LONG_RUN = re.compile(rb"([^\x20\x09-\x0D0-9])\1\1")


LETTER = re.compile(rb"[A-Za-z0-9\x80-\xff]")
MARKED = re.compile(rb"[^\x20\x09-\x0D](?:[#*$%&|<>]|!!)(?=[\x20\x09-\x0D])")


@dataclass(frozen=True)
class Learning:
    # Bounds of the samples that the model is fitted on; rows of the smallest hashes are taken.
    positives: int = 8192
    unlabelled: int = 16384
    # Inner borders of a feature's bins, as quantiles; closer at both ends, where junk stands out.
    borders: tuple[float, ...] = (
        0.005, 0.01, 0.02, 0.04, 0.07, 0.1, 0.15, 0.25, 0.5, 0.75, 0.8, 0.84, 0.87, 0.9, 0.92, 0.94,
        0.96, 0.98, 0.99, 0.995,
    )
    steps: int = 1500
    rate: float = 0.1
    decay: float = 1e-5
    threshold: float = 0.3
    seed: int = 11


_CLASS = np.zeros(256, np.int64)
for _i, _group in enumerate(
    (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b"#*$%&|<>",
     b"!", b".", b",", b"\n", b" \t\x0b\x0c\r", b"?;:'\"()[]{}-_/\\+=@^~`"), start=1
):
    _CLASS[list(_group)] = _i
_CLASS[128:] = 11

NAMES = (
    *(f"share_{i}" for i in range(12)), "log_bytes", "log_words", "word_length", "distinct_words",
    "top_word", "distinct_grams", "distinct_lines", "line_words", "long_runs", "upper_words",
    "bare_marks", "marked_words",
)


def text_features(raw: bytes) -> list[float]:
    """Numbers that describe a whole text; an empty text gives zeros."""
    counts = np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=12)
    size = max(1, len(raw))
    words = raw.split()
    n = len(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    seen: dict[bytes, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    ids = np.fromiter(map(hash, words), np.int64, n)
    grams = ids[:-3] * 3 + ids[1:-2] * 5 + ids[2:-1] * 7 + ids[3:] if n > 3 else ids
    upper = sum(w.isupper() for w in seen)
    return [
        *(counts / size).tolist(),
        float(np.log1p(len(raw))),
        float(np.log1p(n)),
        len(raw) / max(1, n),
        len(seen) / max(1, n),
        max(seen.values(), default=0) / max(1, n),
        len(np.unique(grams)) / max(1, len(grams)),
        len(set(lines)) / max(1, len(lines)),
        n / max(1, len(lines)),
        len(LONG_RUN.findall(raw)) / max(1, n),
        upper / max(1, len(seen)),
        sum(k for w, k in seen.items() if not LETTER.search(w)) / max(1, n),
        len(MARKED.findall(raw)) / max(1, n),
    ]


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [text_features(x.as_py() or b"") for x in batch.column(1)]
        yield pa.RecordBatch.from_pydict(
            {"id": batch.column(0), "x": pa.array(out, pa.list_(pa.float64()))}
        )


@dataclass
class Model:
    """Weights of every bin of every feature; ``edges`` are the bins' inner borders."""

    edges: np.ndarray
    weights: np.ndarray
    base: float

    def columns(self, x: np.ndarray) -> np.ndarray:
        """The weight index of every feature of every row."""
        width = self.edges.shape[1] + 1
        bins = np.stack(
            [np.searchsorted(e, x[:, i], side="right") for i, e in enumerate(self.edges)], 1
        )
        return bins + np.arange(len(self.edges)) * width

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = self.weights[self.columns(x)].sum(1) + self.base
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _fit(model: Model, p: np.ndarray, u: np.ndarray, prior: float, options: Learning, pu: bool):
    """Gradient steps (Adam) on the non-negative risk, or on plain positive-against-unlabelled."""
    cp, cu = model.columns(p), model.columns(u)
    size = len(model.weights) + 1
    m, v = np.zeros(size), np.zeros(size)

    def pull(columns: np.ndarray, slopes: np.ndarray) -> np.ndarray:
        flat = np.bincount(
            columns.ravel(), np.repeat(slopes, columns.shape[1]), minlength=size - 1
        )
        return np.append(flat, slopes.sum())

    for step in range(1, options.steps + 1):
        zp, zu = (model.weights[c].sum(1) + model.base for c in (cp, cu))
        sp, su = (1 / (1 + np.exp(-np.clip(z, -40, 40))) for z in (zp, zu))
        if pu:
            # Logistic loss: log(1 + exp(-z)) for positives, log(1 + exp(z)) for negatives.
            negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
            down = pull(cu, su / len(su)) - pull(cp, prior * sp / len(sp))
            if negative >= 0:
                slope = pull(cp, prior * (sp - 1) / len(sp)) + down
            else:
                # Below zero the estimate has been overfitted: step back along it.
                slope = -down
        else:
            slope = pull(cp, (sp - 1) / len(sp)) + pull(cu, su / len(su))
        slope[:-1] += options.decay * model.weights
        m = 0.9 * m + 0.1 * slope
        v = 0.999 * v + 0.001 * slope * slope
        move = options.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        model.weights -= move[:-1]
        model.base -= move[-1]
    return model


def estimate_prior(p: np.ndarray, u: np.ndarray) -> float:
    """The share of positives among ``u`` from scores of held-back positives and of ``u``.

    Above any threshold the unlabelled share is at least the prior times the positive share; the
    least ratio, allowing for sampling error, is attained where no negatives are left.
    """
    cuts = np.unique(np.quantile(p, np.linspace(0.0, 0.95, 200)))
    qp = np.array([(p >= c).mean() for c in cuts])
    qu = np.array([(u >= c).mean() for c in cuts])
    slack = np.sqrt(np.log(20) / (2 * len(u))) + np.sqrt(np.log(20) / (2 * len(p)))
    best = int(((qu + slack) / qp).argmin())
    return float(np.clip(qu[best] / qp[best], 0.05, 0.98))


def train(p: np.ndarray, u: np.ndarray, options: Learning) -> tuple[Model, float]:
    """The model and the prior from features of positives and of unlabelled documents."""
    both = np.concatenate([p, u])
    edges = np.quantile(both, options.borders, axis=0).T.copy()

    def fresh() -> Model:
        return Model(edges, np.zeros(edges.shape[0] * (edges.shape[1] + 1)), 0.0)

    order = np.random.default_rng(options.seed).permutation(len(p))
    held, used = order[: max(1, len(p) // 4)], order[max(1, len(p) // 4) :]
    used = used if len(used) else held
    first = _fit(fresh(), p[used], u, 0.5, options, pu=False)
    prior = estimate_prior(first.scores(p[held]), first.scores(u))
    return _fit(fresh(), p, u, prior, options, pu=True), prior


def held_out(id: Column) -> Column:
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _score(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            x = values.reshape(batch.num_rows, len(NAMES))
            score = model.scores(x) if model else np.full(batch.num_rows, 0.5)
            yield pa.RecordBatch.from_pydict({"id": batch.column(0), "score": pa.array(score)})

    return run


def classify(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    options: Learning = Learning(),
) -> DataFrame:
    """``id``, ``held_out``, ``score``, ``predicted`` of every row.

    Positives are rows labelled 1 that are not held out; the unlabelled set is taken from all
    rows that are not held out, whatever their labels.  Labelled negatives are not used.  Only
    the text makes features.  Without positives or documents to learn from every score is 0.5.
    Null and empty texts are scored like others; repeated rows get the same score; an id with
    several labels is positive if one of them is; an empty table gives an empty result.

    Features are stored once.  The model is fitted on two samples of bounded size on the driver
    and travels with the scoring function; both are documented options.
    """
    kind = docs.schema[id].dataType.simpleString()
    body = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").cast("string").cast("binary"))
    rows = materialize(body.mapInArrow(_features, f"id {kind}, x array<double>"), "text-features")
    learned = rows.filter(~held_out(F.col("id")))
    good = (
        labels.filter(F.col(f"`{label}`") == 1)
        .select(F.col(f"`{id}`").alias("id"))
        .filter("id is not null")
        .distinct()
    )

    def sample(frame: DataFrame, n: int) -> np.ndarray:
        order = F.xxhash64("id", F.lit(options.seed)), F.xxhash64("x")
        found = of_lowest(frame, order[0], n).orderBy(*order).limit(n).select("x").collect()
        return np.array([r["x"] for r in found], dtype=np.float64).reshape(-1, len(NAMES))

    p = sample(learned.join(good, "id", "left_semi"), options.positives)
    u = sample(learned, options.unlabelled)
    model = train(p, u, options)[0] if len(p) and len(u) else None
    scored = rows.mapInArrow(_score(model), f"id {kind}, score double")
    return scored.select(
        F.col("id").alias(id),
        held_out(F.col("id")).alias("held_out"),
        "score",
        (F.col("score") >= options.threshold).cast("int").alias("predicted"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
