"""Benchmark decontamination: a broadcast hash set of test n-grams meets every training window.

The words of benchmark items are normalised and cut into windows; their hashes are a sorted array
that every task holds.  A task numbers the words of its texts by the benchmark's vocabulary, hashes
each run of known words window by window, looks the hashes up, and verifies every hit word by word.
Documents are not shuffled.  The set is broadcast only in slices of a bounded number of words;
a larger benchmark takes one pass over the documents a slice, and hits are merged by document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genopile.llm.common import table, whole
from genopile.storage import materialize

# Fixed value: what separates words once A-Z is lower case.
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "abcdefghijklmnopqrstuvwxyz"
# A-Z to a-z and separators to blanks, byte by byte; bytes from 0x80 on belong to words.
NORMAL = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c) in _LOWER or 48 <= c <= 57 else 32
    for c in range(256)
)


@dataclass(frozen=True)
class Decontamination:
    words: int = 10
    # Words in the windows, and items named by them, of one broadcast slice.
    slice_words: int = 1 << 23
    # A document of which this share of words is hit is removed, else the hit stretches are.
    drop_share: float = 0.5
    seed: int = 5


def benchmark_windows(benchmark: DataFrame, text: str, item: str, options: Decontamination) -> DataFrame:
    """``window`` (words joined by blanks), ``n`` (their number) and ``item`` (text), distinct.

    A null item is named by the empty string; texts without words have no window.
    """
    lower = F.translate(F.coalesce(F.col(f"`{text}`"), F.lit("")), _LOWER.upper(), _LOWER)
    split = benchmark.select(
        F.coalesce(F.col(f"`{item}`").cast("string"), F.lit("")).alias("item"),
        F.array_remove(F.split(lower, NO_WORD), "").alias("w"),
    ).filter(F.size("w") > 0)
    n = F.least(F.size("w"), F.lit(options.words))
    starts = F.sequence(F.lit(1), F.size("w") - n + 1)
    return split.select(
        "item", n.alias("n"), F.explode(F.transform(starts, lambda i: F.array_join(F.slice("w", i, n), " "))).alias("window")
    ).distinct()


class WindowSet:
    """Windows of one slice: vocabulary, sorted hashes, the words they stand for, their items."""

    def __init__(self, rows: list[tuple[str, str]], seed: int) -> None:
        self.items = sorted({item for _, item in rows})
        place = {item: i for i, item in enumerate(self.items)}
        named: dict[bytes, list[int]] = {}
        for window, item in rows:
            named.setdefault(window.encode(), []).append(place[item])
        self.vocabulary: dict[bytes, int] = {}
        by_length: dict[int, list[tuple[list[int], list[int]]]] = {}
        for window, items in named.items():
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in window.split(b" ")]
            by_length.setdefault(len(ids), []).append((ids, items))
        self.lengths = {n: self._indexed(n, windows, seed) for n, windows in sorted(by_length.items())}

    def _indexed(self, n: int, windows: list, seed: int) -> tuple:
        ids = np.array([w for w, _ in windows], np.uint64)
        random = np.random.default_rng([seed, n])
        while True:  # factors that give every window of the set a hash of its own
            factors = random.integers(1, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1)
            hashes = (ids * factors).sum(axis=1, dtype=np.uint64)
            order = np.argsort(hashes)
            if len(np.unique(hashes)) == len(hashes):
                break
        ends = np.cumsum([0, *(len(windows[i][1]) for i in order)])
        items = np.fromiter(chain.from_iterable(windows[i][1] for i in order), np.int64, int(ends[-1]))
        return factors, hashes[order], ids[order].astype(np.int64), ends, items

    def hits(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and length of every verified window, and place and number of its items."""
        known = np.flatnonzero(np.diff(np.r_[0, ids > 0, 0]))
        begins, ends = known[::2], known[1::2]
        found = []
        for n, (factors, hashes, words, bounds, items) in self.lengths.items():
            long = ends - begins >= n
            counts = (ends - begins - n + 1)[long]
            if not len(counts):
                continue
            at = np.repeat(begins[long] - np.r_[0, np.cumsum(counts)[:-1]], counts) + np.arange(counts.sum())
            h = np.zeros(len(at), np.uint64)
            for j in range(n):
                h += ids[at + j].astype(np.uint64) * factors[j]
            place = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            same = hashes[place] == h
            at, place = at[same], place[same]
            same = (ids[at[:, None] + np.arange(n)] == words[place]).all(axis=1)
            at, place = at[same], place[same]
            sizes = bounds[place + 1] - bounds[place]
            spread = np.repeat(bounds[place] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            found.append((at, np.full(len(at), n), np.repeat(at, sizes), items[spread]))
        if not found:
            none = np.empty(0, np.int64)
            return none, none, np.empty((2, 0), np.int64)
        starts, lengths, at, item = (np.concatenate(x) for x in zip(*found))
        return starts, lengths, np.stack([at, item])


def _blocks(texts: list[bytes | None], most: int = 1 << 21) -> Iterator[list[list[bytes]]]:
    block, size = [], 0
    for t in texts:
        block.append((t or b"").translate(NORMAL).split())
        size += len(t or b"")
        if size >= most:
            yield block
            block, size = [], 0
    if block:
        yield block


def _scan(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows: WindowSet = shared.value
        get = windows.vocabulary.get
        for batch in (b.slice(i, 512) for b in batches for i in range(0, b.num_rows, 512)):
            n_words, spans, names = [], [], []
            for block in _blocks(batch.column(1).to_pylist()):
                counts = np.fromiter(map(len, block), np.int64, len(block))
                # A word number of 0 between texts, so that no window crosses them.
                ends = np.cumsum(counts + 1)
                ids = np.fromiter(
                    chain.from_iterable(chain(map(get, w, repeat(0)), (0,)) for w in block),
                    np.int64,
                    int(ends[-1]),
                )
                starts, lengths, named = windows.hits(ids)
                n_words += counts.tolist()
                hit = np.zeros(len(ids) + 1, np.int64)
                np.add.at(hit, starts, 1)
                np.add.at(hit, starts + lengths, -1)
                edges = np.flatnonzero(np.diff(np.r_[0, np.cumsum(hit[:-1]) > 0, 0]))
                begins = ends - counts - 1
                of_span = np.searchsorted(ends, edges[::2], "right")
                own_spans = [[] for _ in block]
                for d, a, b in zip(of_span, edges[::2] - begins[of_span], edges[1::2] - begins[of_span]):
                    own_spans[d].append({"start": int(a), "end": int(b)})
                own_items = [[] for _ in block]
                docs = np.searchsorted(ends, named[0], "right")
                for d, i in np.unique(np.stack([docs, named[1]], axis=1), axis=0).tolist():
                    own_items[d].append(windows.items[i])
                spans += own_spans
                names += own_items
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n_words, pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                    pa.array(names, pa.list_(pa.string())),
                ],
                names=["doc", "n_words", "spans", "items"],
            )

    return run


def _merged(spans):
    """Disjoint stretches that cover the same words, in order."""
    ordered = F.array_sort(spans)
    none = F.array().cast("array<struct<start:int,end:int>>")
    def step(a, s):
        last = F.element_at(a, -1)
        grown = F.concat(
            F.slice(a, 1, F.size(a) - 1),
            F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))),
        )
        return F.when((F.size(a) > 0) & (F.try_element_at(a, F.lit(-1))["end"] >= s["start"]), grown).otherwise(
            F.concat(a, F.array(s))
        )

    return F.when(F.size(spans) > 0, F.aggregate(ordered, none, step)).otherwise(none)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    keep: list[str] | None = None,
    options: Decontamination = Decontamination(),
) -> DataFrame:
    """One row per input row: ``doc`` (a struct of the columns ``keep``, all by default) and
    ``leak``: ``n_words``, ``n_hit``, ``spans`` (hit stretches in word places, end exclusive,
    disjoint, in order) and ``items`` (names of items with a window in the text, sorted).

    Null and empty texts have no words and no hits; so have items without words.  Repeated rows
    are judged each on its own; benchmark rows with one id are one item, equal windows name all their
    items; an empty table on either side gives no hits; extra columns ride along inside ``doc``.
    """
    spark = docs.sparkSession
    kept_columns = docs.select(*(f"`{c}`" for c in keep)) if keep else docs
    body = docs.select(whole(kept_columns), F.col(f"`{text}`").cast("binary").alias("t"))
    windows = materialize(benchmark_windows(benchmark, item_text, item, options), "test-windows")
    size = windows.agg(F.sum(F.col("n") + 1)).first()[0] or 0
    slices = max(1, -(-2 * size // options.slice_words)) if size > options.slice_words else 1
    schema = (
        f"doc {body.schema['doc'].dataType.simpleString()}, n_words long, "
        "spans array<struct<start:int,end:int>>, items array<string>"
    )
    dealt = windows.withColumn("slice", F.pmod(F.xxhash64("window"), F.lit(slices)))

    def shared(i: int):
        rows = dealt.filter(F.col("slice") == i).select("window", "item").collect()
        return spark.sparkContext.broadcast(WindowSet([tuple(r) for r in rows], options.seed))

    if slices == 1:
        found = body.mapInArrow(_scan(shared(0)), schema)
    else:
        rows = materialize(body.withColumn("row", F.monotonically_increasing_id()), "scan-rows")
        named = rows.select(F.struct("row").alias("doc"), "t")
        schema = schema.replace(schema.split(", n_words")[0], "doc struct<row:bigint>")
        hits = None
        for i in range(slices):
            one = named.mapInArrow(_scan(shared(i)), schema).select("doc.row", "n_words", "spans", "items")
            hits = one if hits is None else hits.unionByName(one)
        merged = hits.groupBy("row").agg(
            F.first("n_words").alias("n_words"),
            _merged(F.flatten(F.collect_list("spans"))).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        )
        found = rows.select("row", "doc").join(merged, "row").drop("row")
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"])
    return found.select("doc", F.struct("n_words", n_hit.alias("n_hit"), "spans", "items").alias("leak"))


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import re

    word = re.compile(rb"[^ ]+")
    for batch in batches:
        out = []
        for t, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            if spans:
                places = [m.span() for m in word.finditer(t.translate(NORMAL))]
                cuts = [(places[s["start"]][0], places[s["end"] - 1][1]) for s in spans]
                kept = zip([0, *(b for _, b in cuts)], [*(a for a, _ in cuts), len(t)])
                t = b"".join(t[a:b] for a, b in kept)
            out.append(None if t is None else t.decode("utf-8", "replace"))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["doc", "text"])


def decontaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    options: Decontamination = Decontamination(),
) -> DataFrame:
    """The documents without benchmark passages, in the columns they came with.

    Documents of which ``drop_share`` of the words are hit are removed; from others the hit
    stretches are, from a stretch's first word to its last.  Texts without hits stay as they are.
    """
    judged = contamination(docs, benchmark, text, item, item_text, None, options)
    few = F.col("leak.n_hit") < options.drop_share * F.col("leak.n_words")
    left = judged.filter((F.col("leak.n_hit") == 0) | few)
    chosen = left.select("doc", F.col(f"doc.`{text}`").cast("binary").alias("t"), "leak.spans")
    cut = chosen.mapInArrow(_without, f"doc {chosen.schema['doc'].dataType.simpleString()}, text string")
    return cut.select(*((F.col("text") if c == text else F.col(f"doc.`{c}`")).alias(c) for c in docs.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    items = F.col("leak.items")
    return found.select(
        "doc.doc_id",
        "leak.n_words",
        "leak.n_hit",
        F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (F.col("leak.n_hit") > 0).alias("contaminated"),
    )
