"""Merkle manifest of a dataset: digests travel up and proofs down by time-forward processing.

Every row is a leaf.  Leaves are numbered in order within their group; eight consecutive nodes
become one, until one is left.  Nodes carry labels that grow from children to parents, and work
runs in the order of labels: a priority queue keyed by label holds each digest until its parent's
turn comes.  Subtrees of a few levels are one task's work; the roots of a round's subtrees are
stored in the shared folder and are the leaves of the next round, so what the queue holds between
tasks lies outside memory.  The reversed sweep runs the rounds, and in a task the labels, backwards:
a node takes its proof from the queue and sends each child its siblings followed by that proof.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from genopile.llm.common import table
from genopile.storage import materialize

# Fixed values of the manifest: what a node joins, and the leaf's columns in order.
FAN = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


@dataclass(frozen=True)
class Merkle:
    # Levels of one task's subtree: 8**4 leaves.
    levels: int = 4


def digest(parts: str) -> str:
    return hashlib.sha256(parts.encode("ascii")).hexdigest()


def height(n: int) -> int:
    """Levels above ``n`` leaves: runs are joined while several nodes remain."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


Node = tuple[int, int]


def _label(level: int, place: int) -> Node:
    """Nodes by the end of what they cover, then by level: children come before parents."""
    return (place + 1) * FAN**level, level


def forward(leaves: list[str], levels: int) -> dict[Node, list[str]]:
    """Children's digests of every inner node (level, place), in the order of labels.

    The queue holds messages to nodes whose turn has not come: at most eight a level.
    """
    queue: list[tuple[Node, int, str]] = []
    inner: dict[Node, list[str]] = {}

    def send(level: int, place: int, value: str) -> None:
        if level < levels:
            heapq.heappush(queue, (_label(level + 1, place // FAN), place, value))

    def run_until(end: int | None) -> None:
        while queue and (end is None or queue[0][0][0] <= end):
            label = queue[0][0]
            children = []
            while queue and queue[0][0] == label:
                children.append(heapq.heappop(queue)[2])
            level = label[1]
            place = label[0] // FAN**level - 1
            inner[level, place] = children
            send(level, place, digest("".join(children)))

    for place, value in enumerate(leaves):
        send(0, place, value)
        run_until(place + 1)
    run_until(None)
    return inner


def backward(inner: dict[Node, list[str]], levels: int, proof: str) -> Iterator[tuple[int, str]]:
    """Place and proof of every leaf: labels in falling order, from the root's ``proof``.

    A proof lists levels from the leaf up, each as the siblings before and after (``a,b|c;``).
    """
    queue: list[tuple[Node, str]] = []

    def send(level: int, place: int, path: str) -> None:
        end, _ = _label(level, place)
        heapq.heappush(queue, ((-end, -level), path))

    send(levels, 0, proof)
    while queue:
        (end, level), path = heapq.heappop(queue)
        level = -level
        place = -end // FAN**level - 1
        if not level:
            yield place, path
            continue
        children = inner[level, place]
        for i in range(len(children)):
            step = f"{','.join(children[:i])}|{','.join(children[i + 1:])};"
            send(level - 1, place * FAN + i, step + path)


def folded(leaf: str, path: str) -> str:
    """The root that a leaf and a proof give."""
    for step in path.split(";")[:-1]:
        before, after = step.split("|")
        leaf = digest(before.replace(",", "") + leaf + after.replace(",", ""))
    return leaf


def siblings(path: str) -> str:
    """The digests of a proof, level by level, left to right."""
    return path.replace(",", "").replace("|", "").replace(";", "")


def numbered(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """Rows with ``place`` (from 0 within ``group``, by ``order``) and ``n`` (rows of the group).

    Ranges of (group, order) are sorted apart, so a hot group is spread over many tasks; the
    counts of a group in every range, at most one row a group and task, are summed one level up.
    Row numbers break ties, so rows that are all alike are spread as well.  Nulls come first.
    """
    keys = [F.col(c).asc_nulls_first() for c in (group, *order, "_id")]
    stored = materialize(
        rows.withColumn("_id", F.monotonically_increasing_id())
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
        .drop("_id"),
        name,
    )
    counts = stored.groupBy(F.col(group).alias("_group"), F.col("_part").alias("_range")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first")
    )
    whole = Window.partitionBy("_group")
    before = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialize(
        counts.select(
            "_group",
            "_range",
            (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
            F.sum("_n").over(whole).alias("n"),
        ),
        f"{name}-starts",
    )
    same = (F.col("_part") == F.col("_range")) & F.col(group).eqNullSafe(F.col("_group"))
    return (
        stored.join(starts, same)
        .withColumn("place", F.col("_at") + F.col("_shift"))
        .drop("_part", "_at", "_group", "_range", "_shift")
    )


def _block(levels: int) -> Column:
    return F.floor(F.col("place") / F.lit(FAN**levels)).cast("bigint")


def _up(levels: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        n, leaves = int(rows["n"].iloc[0]), rows["digest"].tolist()
        top = min(levels, height(n))
        inner = forward(leaves, top)
        root = digest("".join(inner[top, 0])) if top else leaves[0]
        return pd.DataFrame(
            {
                "group": rows["group"].iloc[:1],
                "place": [int(rows["place"].iloc[0]) // FAN**levels],
                "n": [-(-n // FAN**levels)],
                "digest": [root],
            }
        )

    return run


def climb(nodes: DataFrame, options: Merkle) -> tuple[list[DataFrame], DataFrame]:
    """The stored nodes of every round and the roots (``group``, ``digest``).

    ``nodes`` has ``group``, ``place``, ``n`` and ``digest``.  A round joins subtrees of
    ``levels`` levels; the number of rounds is that logarithm of the largest group.
    """
    kind = nodes.schema["group"].dataType.simpleString()
    schema = f"group {kind}, place long, n long, digest string"
    rounds = [nodes]
    while (rounds[-1].agg(F.max("n")).first()[0] or 0) > 1:
        below = rounds[-1].select("group", "place", "n", "digest")
        above = below.groupBy("group", _block(options.levels)).applyInPandas(_up(options.levels), schema)
        rounds.append(materialize(above, "tree-round"))
    return rounds, rounds[-1].select("group", "digest")


def _down(levels: int, finish):
    def run(nodes: pd.DataFrame, proofs: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("place")
        top = min(levels, height(int(nodes["n"].iloc[0])))
        inner = forward(nodes["digest"].tolist(), top)
        paths = [""] * len(nodes)
        for place, path in backward(inner, top, proofs["path"].iloc[0]):
            paths[place] = path
        return finish(nodes.reset_index(drop=True), paths, proofs["subroot"].iloc[0])

    return run


def descend(rounds: list[DataFrame], proofs: DataFrame, options: Merkle, finish, schema: str) -> DataFrame:
    """The reversed sweep from ``proofs`` (``group``, ``path``, ``subroot``) of the roots.

    ``finish`` makes the rows of the lowest round from its nodes, their paths and their subroot.
    """

    def pass_on(nodes: pd.DataFrame, paths: list[str], subroot: str) -> pd.DataFrame:
        return nodes[["group", "place"]].assign(path=paths, subroot=subroot)

    kind = rounds[0].schema["group"].dataType.simpleString()
    between = f"group {kind}, place long, path string, subroot string"
    messages = proofs.withColumn("place", F.lit(0).cast("bigint"))
    # With a round above, roots meet it as its only node; without one, they are the leaves.
    for nodes in reversed(rounds[1:-1] if len(rounds) > 1 else []):
        met = nodes.groupBy("group", _block(options.levels)).cogroup(messages.groupBy("group", "place"))
        messages = materialize(met.applyInPandas(_down(options.levels, pass_on), between), "tree-proofs")
    met = rounds[0].groupBy("group", _block(options.levels)).cogroup(messages.groupBy("group", "place"))
    return met.applyInPandas(_down(options.levels, finish), schema)


def leaf(values: list[Column]) -> Column:
    """Digest of a row: every value as its UTF-8 length, a colon and itself, or ``-`` for null."""
    parts = [
        F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-"))
        for v in (v.cast("string") for v in values)
    ]
    return F.sha2(F.concat(*parts), 256)


def manifest(
    docs: DataFrame,
    fields: tuple[str, ...] = FIELDS,
    key: str = "doc_id",
    group: str = "lang",
    shown: dict[str, Column] | None = None,
    options: Merkle = Merkle(),
) -> DataFrame:
    """One row per input row: ``key``, ``leaf``, ``subroot``, ``root``, ``path`` (the proof:
    siblings before and after, level by level), ``proof_sha256``, ``folded_root``, ``verified``.

    ``shown`` replaces columns by what a reader found there: ``folded_root`` is what the leaf of
    these values gives with the manifest's proof.  Nulls have their own mark, so null and empty
    differ; a null group is a group of its own and the first, a null key the first of its group.
    Equal keys are ordered by leaf; rows alike in all fields are leaves each on their own.  An
    empty table gives an empty result.  Columns other than the fields are not read.
    """
    names = [F.col(f"`{c}`") for c in fields]
    kind = docs.schema[key].dataType.simpleString()
    found = leaf([(shown or {}).get(c, F.col(f"`{c}`")) for c in fields])
    leaves = docs.select(
        F.col(f"`{key}`").alias("key"),
        F.col(f"`{group}`").cast("string").alias("group"),
        leaf(names).alias("digest"),
        found.alias("found"),
    )
    # Hashed once: the texts are read a single time, the sort below handles digests only.
    leaves = materialize(leaves, "leaf-digests")
    placed = materialize(numbered(leaves, "group", ["key", "digest"], "leaves"), "placed-leaves")
    rounds, subroots = climb(placed, options)
    # Subroots are the leaves of one more tree.
    tops = subroots.select(F.lit(0).alias("group"), F.col("group").alias("name"), "digest")
    tops = materialize(numbered(tops, "group", ["name"], "subroots"), "placed-subroots")
    top_rounds, roots = climb(tops, options)
    row = roots.first()
    root = row["digest"] if row else ""

    def of_group(nodes: pd.DataFrame, paths: list[str], subroot: str) -> pd.DataFrame:
        return pd.DataFrame({"group": nodes["name"], "path": paths, "subroot": nodes["digest"]})

    begin = roots.select("group", F.lit("").alias("path"), F.lit("").alias("subroot"))
    proofs = materialize(
        descend(top_rounds, begin, options, of_group, "group string, path string, subroot string"), "group-proofs"
    )

    def of_leaf(nodes: pd.DataFrame, paths: list[str], subroot: str) -> pd.DataFrame:
        ends = [folded(x, p) for x, p in zip(nodes["found"], paths)]
        return pd.DataFrame(
            {
                "key": nodes["key"],
                "leaf": nodes["digest"],
                "subroot": subroot,
                "path": paths,
                "proof_sha256": [digest(siblings(p)) for p in paths],
                "folded_root": ends,
            }
        )

    schema = f"key {kind}, leaf string, subroot string, path string, proof_sha256 string, folded_root string"
    return descend(rounds, proofs, options, of_leaf, schema).select(
        F.col("key").alias(key),
        "leaf",
        "subroot",
        F.lit(root).alias("root"),
        "path",
        "proof_sha256",
        "folded_root",
        (F.col("folded_root") == root).alias("verified"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents, read back with every third text in lower case."""
    docs = table(spark, sf_dir, "documents")
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    seen = F.when(third, lower).otherwise(F.col("text"))
    return manifest(docs, shown={"text": seen}).drop("path")
