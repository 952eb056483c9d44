"""N-gram Jaccard join: groups of texts whose sets of word n-grams are similar.

Tokens (word n-grams) are hashed into groups.  Linked sets differ in a bounded number of tokens,
each of which spoils one group, so they agree in the whole content of some groups: an equi-join on
group signatures, less the most common ones of each set, finds every linked pair and few others.  Group counts are points; the summed
minima of two points' coordinates bound an overlap.  Every set is compared with the smallest set
of each of its buckets first; where a bucket still holds sets of several components, an R-tree of
its points yields the pairs whose bound reaches the threshold.  Survivors are verified exactly.

Equal sets are one node, so groups of copies cost one node whatever their size, and pairs inside
one component are never spelled out.  Held and asking sets of a bucket are both cut into blocks of
bounded size.  Where very many sets ask in one bucket, its members are first dealt anew by their
rarest tokens, of which linked sets share one; a passage that all of them hold is not among these.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from genopile.llm.common import table
from genopile.llm.components import components
from genopile.llm.count_vectors import Bands, Jaccard, RTree, U, count_vector, mix, points, token_set
from genopile.storage import materialize, release


@dataclass(frozen=True)
class Joining:
    words: int = 4
    rule: Jaccard = Jaccard(85, 100)
    # Points of one R-tree, and rows that one task handles, in whole trees.
    block: int = 512
    task_rows: int = 1 << 13
    # Blocks of asking sets from which on a head's members are dealt anew by rare tokens.
    hot: int = 4
    # Most bits of the broadcast filter that keeps other documents' texts out of a shuffle.
    filter_bits: int = 1 << 27
    # Keys to leave out up to which they are joined as they are, which the planner does in place.
    few: int = 1 << 13


def _sets(batch: pa.RecordBatch, n: int) -> Iterator[np.ndarray]:
    """The token set of the text in column 1 of every row."""
    for value in batch.column(1):
        raw = value.as_py()
        words = raw.lower().split() if raw else []
        hashes = {w: xxhash.xxh64_intdigest(w) for w in set(words)}
        yield token_set(np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words)), n)


def _node(tokens: np.ndarray) -> int:
    """A 64-bit fingerprint of a set."""
    total = mix(tokens).sum(dtype=np.uint64) + U(len(tokens))
    return int(mix(np.array([total]))[0].astype(np.int64))


def _small(batch: pa.RecordBatch, rows: int = 1024) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def _sketches(options: Joining):
    """Set size, fingerprint, count vector and group signatures of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(options.rule)
        for large in batches:
            for batch in _small(large):
                n, node, counts, sigs, drops = [], [], [], [], []
                for tokens in _sets(batch, options.words):
                    n.append(len(tokens))
                    node.append(_node(tokens) if len(tokens) else None)
                    counts.append(count_vector(tokens) if len(tokens) else None)
                    hashes, few = bands.signed(tokens)
                    sigs.append(hashes.astype(np.int64))
                    drops.append(few)
                ends = np.cumsum([0, *map(len, sigs)]).astype(np.int32)
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": batch.column(0),
                        "n": pa.array(n, pa.int64()),
                        "node": pa.array(node, pa.int64()),
                        "counts": pa.array(counts, pa.binary()),
                        "drops": pa.array(drops, pa.list_(pa.int64())),
                        "sigs": pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sigs))),
                    }
                )

    return run


def _tokens(options: Joining):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for large in batches:
            for batch in _small(large, 256):
                sets = list(_sets(batch, options.words))
                full = pa.array([len(t) > 0 for t in sets], pa.bool_())
                sets = [t for t in sets if len(t)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": batch.column(0).filter(full),
                        "many": batch.column(2).filter(full),
                        "node": pa.array([_node(t) for t in sets], pa.int64()),
                        "n": pa.array([len(t) for t in sets], pa.int64()),
                        "counts": pa.array([count_vector(t) for t in sets], pa.binary()),
                        "tokens": pa.array([t.tobytes() for t in sets], pa.binary()),
                    }
                )

    return run


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (sig, node): those whose sig another node has, each once.

    A partition's first and last signatures may go on in its neighbours and are kept as well.
    """
    held: tuple[int, int, bool] | None = None  # the last row, and whether to keep it
    first = None
    for batch in batches:
        if not batch.num_rows:
            continue
        sig = batch.column(0).to_numpy(zero_copy_only=False)
        node = batch.column(1).to_numpy(zero_copy_only=False)
        first = sig[0] if first is None else first
        keep_first = False
        if held:
            sig, node = np.r_[np.int64(held[0]), sig], np.r_[np.int64(held[1]), node]
            keep_first = held[2]
        new = np.r_[True, (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])]
        sig, node = sig[new], node[new]
        same = sig[1:] == sig[:-1]
        keep = np.r_[False, same] | np.r_[same, False] | (sig == first)
        keep[0] |= keep_first
        held = (int(sig[-1]), int(node[-1]), bool(keep[-1]))
        sig, node = sig[:-1][keep[:-1]], node[:-1][keep[:-1]]
        yield pa.RecordBatch.from_pydict({"sig": pa.array(sig), "node": pa.array(node)})
    if held:
        yield pa.RecordBatch.from_pydict(
            {"sig": pa.array([held[0]], pa.int64()), "node": pa.array([held[1]], pa.int64())}
        )


def _telling(members: DataFrame, drops: DataFrame) -> DataFrame:
    """``sig``, ``node`` without each set's most common signatures, as many as it may drop.

    Linked sets share more signatures of a band than either drops there.  Both drop by one order
    of all signatures, so the rarest shared one stays with both.  A passage that many texts hold
    makes a few groups of each agree; these are the ones that go.
    """
    common = members.groupBy("sig").agg(F.count(F.lit(1)).alias("k")).filter("k > 1")
    of_node = drops.dropDuplicates(["node"])
    rows = members.join(common, "sig").join(of_node, "node")
    bit = F.col("sig").bitwiseAND(F.lit(1))
    order = Window.partitionBy("node", bit).orderBy(F.col("k").desc(), "sig")
    ranked = rows.withColumn("place", F.row_number().over(order))
    return ranked.filter(F.col("place") > F.get("drops", bit)).select("sig", "node")


def _bits(ids: DataFrame, most: int) -> np.ndarray:
    """A bitmap of hashed ids with 16 bits an id, up to ``most``; a full one lets every id pass.

    Each task fills pieces of 4 KB; only these pieces come to the driver.
    """
    wanted = ids.count() * 16
    size = 1 << 16
    while size < min(wanted, most):
        size *= 2

    def fill(rows: pd.DataFrame) -> pd.DataFrame:
        piece = np.zeros(1 << 15, bool)
        piece[rows["bit"].to_numpy() & ((1 << 15) - 1)] = True
        return pd.DataFrame({"piece": rows["piece"].iloc[:1], "bits": [np.packbits(piece).tobytes()]})

    bit = F.pmod(F.xxhash64("id"), F.lit(size))
    set_bits = ids.select(bit.alias("bit")).distinct().withColumn("piece", F.shiftright("bit", 15))
    pieces = set_bits.groupBy("piece").applyInPandas(fill, "piece long, bits binary").collect()
    out = np.zeros((size >> 15, 1 << 12), np.uint8)
    for row in pieces:
        out[row["piece"]] = np.frombuffer(row["bits"], np.uint8)
    return out.reshape(-1)


def _passing(shared):
    """Rows (id, text, hash) whose hash has its bit set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            at = batch.column(2).to_numpy(zero_copy_only=False) % (8 * len(bits))
            keep = (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0
            yield batch.select(["id", "text"]).filter(pa.array(keep))

    return run


def _maybe(spark: SparkSession, ids: DataFrame, most: int):
    """A condition on a column of 64-bit hashes: true for those of all ``id`` of ``ids`` and some others."""
    shared = spark.sparkContext.broadcast(_bits(ids, most))

    @F.arrow_udf("boolean")
    def maybe(hashes: pa.Array) -> pa.Array:
        bits = shared.value
        at = hashes.to_numpy(zero_copy_only=False) % (8 * len(bits))
        return pa.array((bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0)

    return maybe


def without(rows: DataFrame, gone: DataFrame, key: str, options: Joining = Joining()) -> DataFrame:
    """``rows`` whose ``key`` is not among that of ``gone`` (stored); a null key meets a null one.

    Rows are wide.  Those whose hash misses a broadcast bitmap of bounded size stay where they are;
    the others, which are little more than those that go, are shuffled and compared.
    """
    gone = gone.select(key)
    if gone.count() <= options.few:
        return rows.join(gone, rows[key].eqNullSafe(gone[key]), "left_anti")
    maybe = _maybe(rows.sparkSession, gone.select(F.col(key).alias("id")), options.filter_bits)
    hit = maybe(F.xxhash64(key))
    some = rows.filter(hit)
    left = some.join(gone, some[key].eqNullSafe(gone[key]), "left_anti")
    return rows.filter(~hit).unionByName(left)


class Tokens:
    """Token sets of nodes, made from the texts when they are asked for and kept.

    A node is read from one of its documents.  Texts of other documents are kept out of the join
    by a broadcast bitmap of bounded size, so few texts are shuffled.
    """

    def __init__(self, body: DataFrame, prints: DataFrame, options: Joining) -> None:
        self.body, self.prints, self.options = body, prints, options
        self.repeated = prints.groupBy("id").agg((F.count(F.lit(1)) > 1).alias("many"))
        spark = body.sparkSession
        self.made = spark.createDataFrame([], "node long, n long, tokens binary")

    def of(self, nodes: DataFrame) -> DataFrame:
        """``node``, ``n``, ``tokens`` of at least these nodes (distinct, stored).

        Where several rows share an id, the join by id also brings sets that were not asked for
        and brings sets twice; only these rows are sorted out.
        """
        nodes = materialize(nodes.join(self.made, "node", "left_anti"), "new-nodes")
        if not nodes.limit(1).count():
            return self.made
        ids = self.prints.join(nodes, "node").groupBy("node").agg(F.min("id").alias("id"))
        same = ids["id"].eqNullSafe(self.repeated["id"])
        ids = materialize(ids.join(self.repeated, same).select("node", ids["id"], "many"), "candidates")
        asked = ids.select(F.col("id").alias("_id"), "many").distinct()
        spark = self.body.sparkSession
        bits = spark.sparkContext.broadcast(_bits(ids, self.options.filter_bits))
        kind = self.body.schema["id"].dataType.simpleString()
        some = self.body.select("id", "text", F.xxhash64("id").alias("h")).mapInArrow(
            _passing(bits), f"id {kind}, text binary"
        )
        # Joined by sorting at every size: the list of ids grows with the documents.
        rows = some.join(asked.hint("merge"), F.col("id").eqNullSafe(F.col("_id"))).select("id", "text", "many")
        schema = f"id {kind}, many boolean, node long, n long, counts binary, tokens binary"
        made = materialize(rows.mapInArrow(_tokens(self.options), schema), "tokens")
        columns = ["node", "n", "tokens"]
        wanted = ids.filter("many").select(F.col("node").alias("_node"), F.col("id").alias("_id"))
        sorted_out = (
            made.filter("many")
            .join(
                wanted,
                (F.col("node") == F.col("_node")) & F.col("id").eqNullSafe(F.col("_id")),
                "left_semi",
            )
            .select(*columns)
            .dropDuplicates(["node"])
        )
        repeats = materialize(sorted_out, "tokens-of-repeated-ids")
        self.made = self.made.unionByName(made.filter("not many").select(*columns)).unionByName(repeats)
        return self.made


def _bounded(options: Joining):
    """Pairs whose summed minima reach the overlap that a link needs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for large in batches:
            for batch in _small(large, 1024):
                a, b = (points(batch.column(c).to_pylist()) for c in ("a_counts", "b_counts"))
                total = batch.column("a_n").to_numpy() + batch.column("b_n").to_numpy()
                good = np.minimum(a, b).sum(1) >= options.rule.overlap(total)
                yield batch.select(["a", "b"]).filter(pa.array(good))

    return run


def _verified(options: Joining):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column("a_tokens"), batch.column("b_tokens")):
                x, y = (np.frombuffer(z.as_buffer(), np.uint64) for z in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(options.rule.links(len(x), len(y), both))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


def _of(tokens: DataFrame, side: str, columns: list[str]) -> DataFrame:
    return tokens.select(
        F.col("node").alias(side), *(F.col(c).alias(f"{side}_{c}") for c in columns)
    )


def _links(pairs: DataFrame, vectors: DataFrame, tokens: Tokens, options: Joining, name: str) -> DataFrame:
    """The pairs (``a``, ``b``) that are linked, stored.

    ``b`` may be in very many pairs and is looked up first, while rows are narrow.  Token sets are
    made and moved only for pairs that the bound leaves.
    """
    bound = pairs.join(_of(vectors, "b", ["n", "counts"]), "b").join(
        _of(vectors, "a", ["n", "counts"]), "a"
    )
    bound = bound.select("a", "b", "a_n", "b_n", "a_counts", "b_counts")
    left = materialize(bound.mapInArrow(_bounded(options), "a long, b long"), "bounded-pairs")
    nodes = left.select(F.col("a").alias("node")).union(left.select("b")).distinct()
    nodes = materialize(nodes, "bounded-nodes")
    some = tokens.of(nodes).join(nodes, "node", "left_semi")
    full = left.join(_of(some, "b", ["tokens"]), "b").join(_of(some, "a", ["tokens"]), "a")
    return materialize(
        full.select("a", "b", "a_tokens", "b_tokens").mapInArrow(_verified(options), "a long, b long"),
        name,
    )


def _verified_together(options: Joining):
    """The linked pairs of a group; each of its sets comes once, however many pairs it is in."""

    def run(pairs: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        sets = {n: np.frombuffer(t, np.uint64) for n, t in zip(rows["node"], rows["tokens"])}
        good = []
        for a, b in zip(pairs["a"], pairs["b"]):
            x, y = sets[a], sets[b]
            good.append(options.rule.links(len(x), len(y), len(np.intersect1d(x, y, assume_unique=True))))
        return pairs.loc[good, ["a", "b"]]

    return run


def _group_links(pairs: DataFrame, tokens: Tokens, options: Joining, name: str) -> DataFrame:
    """The pairs (``a``, ``b``) of trees that are linked, stored.

    A tree has compared count vectors already.  ``task`` names the tree of a pair, which holds a
    bounded number of sets, so token sets are moved once a tree and not once a pair.
    """
    pairs = pairs.select("task", "a", "b")
    sets = materialize(pairs.select("task", F.explode(F.array("a", "b")).alias("node")).distinct(), "tree-sets")
    made = tokens.of(sets.select("node").distinct()).select("node", "tokens")
    met = pairs.groupBy("task").cogroup(sets.join(made, "node").groupBy("task"))
    return materialize(met.applyInPandas(_verified_together(options), "a long, b long"), name)


def _search_trees(options: Joining, best: bool):
    schema = {"a": "int64", "b": "int64", "more": "bool", "tree": "int64"}

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for key, part in rows.groupby(["head", "block", "part"], sort=False):
            held, asks = part[~part["asks"]], part[part["asks"]]
            if not len(held) or not len(asks):
                continue
            node, comps = held["node"].to_numpy(), held["comp"].to_numpy()
            minor = held["minor"].to_numpy()
            tree = RTree(points(held["counts"].tolist()), held["n"].to_numpy(), comps)
            names = asks["node"].to_numpy()
            ask, at, bound = tree.search(
                points(asks["counts"].tolist()), asks["n"].to_numpy(), asks["comp"].to_numpy(), options.rule
            )
            if best:
                # The highest bound of every asking set and component.
                order = np.lexsort((node[at], -bound, comps[at], ask))
                ask, at, bound = ask[order], at[order], bound[order]
                first = np.r_[True, (ask[1:] != ask[:-1]) | (comps[at[1:]] != comps[at[:-1]])]
                keep = first[: len(ask)]
                # Sets with further candidates, which have to ask again.
                more = np.bincount(ask, ~keep, minlength=len(names))[ask] > 0
            else:
                # Two asking sets find each other twice; the smaller one reports it.
                keep = ~minor[at] | (node[at] > names[ask])
                more = np.zeros(len(ask), bool)
            tree_name = np.full(int(keep.sum()), xxhash.xxh64_intdigest(repr(key)) >> 1)
            out.append(np.stack([names[ask[keep]], node[at[keep]], more[keep], tree_name], 1))
        found = np.concatenate(out) if out else np.empty((0, 4), np.int64)
        return pd.DataFrame(found, columns=list(schema)).astype(schema)

    return run


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``node`` and ``token`` of every token in column 1."""
    for large in batches:
        for batch in _small(large, 64):
            sets = [np.frombuffer(z.as_buffer(), np.int64) for z in batch.column(1)]
            node = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), [len(z) for z in sets])
            token = np.concatenate(sets) if sets else np.empty(0, np.int64)
            yield pa.RecordBatch.from_pydict({"node": pa.array(node), "token": pa.array(token)})


def _by_rare_tokens(nodes: DataFrame, tokens: DataFrame, options: Joining) -> DataFrame:
    """``head`` (a token), ``node``, ``comp``: every linked pair of ``nodes`` has a common head.

    A set of ``n`` tokens shares at least ``n * num / den`` with a linked one.  With tokens in one
    order, rare ones first, the first common token of the two is among the first
    ``n - n * num / den + 1`` of both.  Tokens of one set only are counted but not sorted.
    """
    rule = options.rule
    full = tokens.join(nodes, "node", "left_semi")
    listed = materialize(full.select("node", "tokens").mapInArrow(_listed, "node long, token long"), "hot-tokens")
    rare = listed.groupBy("token").agg(F.count(F.lit(1)).alias("k")).filter("k > 1")
    ordered = (
        listed.join(materialize(rare, "repeated-tokens"), "token")
        .groupBy("node")
        .agg(F.array_sort(F.collect_list(F.struct("k", "token"))).alias("ordered"))
        .join(full.select("node", "n"), "node")
    )
    first = F.floor(F.col("n") * (rule.den - rule.num) / rule.den) + 1
    left = F.greatest(F.lit(0), first - (F.col("n") - F.size("ordered"))).cast("int")
    heads = ordered.select("node", F.explode(F.slice("ordered", F.lit(1), left)).alias("t"))
    heads = materialize(
        heads.select(F.col("t.token").alias("head"), "node").join(nodes, "node"), "rare-heads"
    )
    apart = heads.groupBy("head").agg((F.min("comp") != F.max("comp")).alias("apart")).filter("apart")
    return heads.join(apart.select("head"), "head", "left_semi").select("head", "node", "comp")


def _marked(rows: DataFrame, again: DataFrame | None, options: Joining) -> DataFrame:
    """``rows`` with ``minor`` (the set asks) and the numbers of blocks of held and asking sets."""
    if again is None:
        per = rows.groupBy("head", "comp").agg(F.count(F.lit(1)).alias("size"))
        major = per.groupBy("head").agg(F.max(F.struct("size", "comp"))["comp"].alias("major"))
        rows = rows.join(materialize(major, "open-heads"), "head")
        rows = rows.select("head", "node", "comp", (F.col("comp") != F.col("major")).alias("minor"))
    else:
        rows = rows.join(again.withColumn("minor", F.lit(True)), "node", "left")
        rows = rows.select("head", "node", "comp", F.coalesce("minor", F.lit(False)).alias("minor"))
    rows = materialize(rows, "open-rows")
    heads = rows.groupBy("head").agg(
        F.ceil(F.count(F.lit(1)) / options.block).cast("int").alias("blocks"),
        F.ceil(F.sum(F.col("minor").cast("int")) / options.block).cast("int").alias("parts"),
    )
    return rows.join(materialize(heads.filter("parts > 0"), "head-blocks"), "head")


def _tree_pairs(
    members: DataFrame,
    comps: DataFrame,
    vectors: DataFrame,
    tokens: Tokens,
    options: Joining,
    again: DataFrame | None = None,
) -> DataFrame:
    """Pairs across components, in buckets that star comparisons left open, by R-tree search.

    ``members`` has ``sig``, ``head``, ``node`` of buckets of three or more.  Open buckets of one
    head are searched together, each set once; all are held.  Held and asking sets are dealt to
    blocks by hashes, and each block of the one meets each of the other, so no group grows with
    its head.  Heads in which more than ``hot`` blocks ask are searched by rare tokens instead.

    At first the sets outside a head's largest component ask, and of each asking set, component
    and block only the pair of the highest bound is returned; ``more`` marks sets that had further
    candidates.  These (``again``) ask a second time and get all pairs that are still apart.
    """
    placed = members.join(comps, "node")
    apart = placed.groupBy("sig").agg((F.min("comp") != F.max("comp")).alias("apart")).filter("apart")
    rows = placed.join(apart.select("sig"), "sig", "left_semi")
    rows = materialize(rows.select("head", "node", "comp").distinct(), "open-members")
    rows = _marked(rows, again, options)
    hot = F.col("parts") > options.hot
    nodes = materialize(rows.filter(hot).select("node", "comp").distinct(), "hot-nodes")
    if nodes.limit(1).count():
        thin = _marked(_by_rare_tokens(nodes, tokens.of(nodes.select("node")), options), again, options)
        rows = rows.filter(~hot).unionByName(thin)
    rows = materialize(rows, "asked-rows")

    def own(seed: int, n: str):
        return F.pmod(F.xxhash64("node", F.lit(seed)), F.col(n)).cast("int")

    def every(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    columns = ["head", "block", "part", "node", "comp", "minor"]
    held = rows.withColumn("block", own(1, "blocks")).withColumn("part", every("parts"))
    asks = rows.filter("minor").withColumn("part", own(2, "parts")).withColumn("block", every("blocks"))
    both = held.select(*columns, F.lit(False).alias("asks")).unionByName(
        asks.select(*columns, F.lit(True).alias("asks"))
    )
    n = rows.agg(F.sum(F.col("parts") + F.col("minor").cast("int") * F.col("blocks"))).first()[0] or 0
    tasks = max(1, -(-n // options.task_rows))
    dealt = both.join(vectors, "node").withColumn(
        "task", F.pmod(F.xxhash64("head", "block", "part"), F.lit(tasks))
    )
    found = dealt.groupBy("task").applyInPandas(
        _search_trees(options, again is None), "a long, b long, more boolean, tree long"
    )
    pairs = found.groupBy("a", "b").agg(F.max("more").alias("more"), F.min("tree").alias("task"))
    return materialize(pairs, "tree-pairs")


def join(docs: DataFrame, id: str = "doc_id", text: str = "text", options: Joining = Joining()):
    """``id``, ``n_shingles`` and ``component_id`` of every row.

    Words are runs other than the six blanks, with A to Z lower-cased.  A null or empty text, or
    one without words, has an empty set and is linked with nothing: its component is its own id.
    A component's id is the smallest id in it; rows of equal ids stay apart rows, each with the
    component of its own text, and null ids never name a component that has another id.  Equal
    sets are linked.  An empty table gives an empty result; other columns are not read.

    Tokens and sets are told apart by 64-bit hashes.  The text is read for fingerprints, count
    vectors and signatures, which are stored, and again for the tokens of sets in pairs that the
    bound leaves.
    """
    body = docs.select(
        F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").cast("string").cast("binary").alias("text")
    )
    kind = docs.schema[id].dataType.simpleString()
    schema = f"id {kind}, n long, node long, counts binary, drops array<long>, sigs array<long>"
    sketches = materialize(body.mapInArrow(_sketches(options), schema), "sketches")
    prints = materialize(sketches.drop("sigs"), "prints")
    members = materialize(
        sketches.select(F.explode("sigs").alias("sig"), "node")
        .repartitionByRange("sig", "node")
        .sortWithinPartitions("sig", "node")
        .mapInArrow(_repeated, "sig long, node long"),
        "signature-members",
    )
    # The largest table goes before the next ones come.
    release(sketches)
    members = materialize(_telling(members, prints.select("node", "drops")), "telling-members")
    heads = members.groupBy("sig").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("k"))
    shared = materialize(members.join(heads.filter("k > 1"), "sig"), "shared-members")
    large = materialize(shared.filter("k > 2").select("sig", "head", "node"), "large-buckets")
    star = shared.filter(F.col("node") != F.col("head"))
    star = star.select(F.col("node").alias("a"), F.col("head").alias("b")).distinct()
    star = materialize(star, "star-pairs")
    nodes = star.select(F.col("a").alias("node")).union(star.select("b")).distinct()
    nodes = materialize(nodes, "nodes")
    maybe = _maybe(docs.sparkSession, nodes.select(F.col("node").alias("id")), options.filter_bits)
    some = prints.select("node", "n", "counts").filter("node is not null").filter(maybe(F.xxhash64("node")))
    vectors = some.join(nodes, "node", "left_semi")
    vectors = materialize(vectors.dropDuplicates(["node"]), "count-vectors")
    tokens = Tokens(body, prints.select("id", "node"), options)

    links = _links(star, vectors, tokens, options, "star-links")
    comps = materialize(components(nodes, links), "star-components")

    # Open buckets: of each set and component the pair of the highest bound first, then the rest.
    tried = star.select("a", "b").unionByName(star.select(F.col("b").alias("a"), F.col("a").alias("b")))
    again = None
    for _ in range(2):
        found = _tree_pairs(large, comps, vectors, tokens, options, again)
        again = materialize(found.filter("more").select(F.col("a").alias("node")).distinct(), "again")
        pairs = found.select("task", "a", "b").join(tried, ["a", "b"], "left_anti")
        pairs = materialize(pairs, "new-pairs")
        links = links.unionByName(_group_links(pairs, tokens, options, "tree-links"))
        comps = materialize(components(nodes, links), "tree-components")
        tried = tried.unionByName(pairs.select("a", "b"))

    marked = prints.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    names = marked.filter("comp is not null").groupBy("comp").agg(F.min("id").alias("name"))
    return marked.join(names, "comp", "left").select(
        F.col("id").alias(id),
        F.col("n").alias("n_shingles"),
        F.coalesce("name", "id").alias("component_id"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"))
