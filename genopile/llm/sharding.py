"""Balanced label propagation: linked documents move to their neighbours' shards.

Documents start in shards of equal counts.  Every round, each document prefers the shard that
holds most of the documents it is linked with; a document leaves for it only in exchange for one
that goes the other way, be it linked there or free of links.  Quotas of every pair of shards
make the two flows equal, so counts stay at most one apart while cut links become fewer.

Documents of equal text are linked.  A group of more than half a shard is cut
into chunks by a hash; two chunks at a time gather in shards that follow each other.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genopile.llm.common import dense_index, table, whole
from genopile.storage import materialize


@dataclass(frozen=True)
class Shards:
    count: int = 16
    rounds: int = 4
    # Rows that one group numbers when rows are counted off.
    group_rows: int = 1 << 15


def _homes(rows: DataFrame, opened: list[int]) -> DataFrame:
    """``link``, ``home``: the open shard with most of a link's documents, ties by a hash.

    Copies are counted map-side, so a large link costs one row a shard and task.
    """
    per = rows.filter("link is not null and fixed is null").filter(F.col("shard").isin(opened))
    per = per.groupBy("link", "shard").agg(F.count(F.lit(1)).alias("n"))
    tie = F.xxhash64("link", "shard")
    best = F.max(F.struct("n", tie.alias("tie"), "shard"))
    return per.groupBy("link").agg(best["shard"].alias("home"))


def _flows(wants: list, free: dict[int, int], count: int) -> dict:
    """Documents that may go from shard to shard: linked ones, then free ones in return.

    ``wants`` has (from, to, documents).  What two shards owe each other is exchanged first;
    the rest is paid with free documents of the receiving shard.  ``count`` squared numbers.
    """
    want = {(i, j): n for i, j, n in wants}
    linked: dict[tuple[int, int], int] = {}
    back: dict[tuple[int, int], int] = {}
    left = dict(free)
    for i in range(count):
        for j in range(i + 1, count):
            there, here = want.get((i, j), 0), want.get((j, i), 0)
            both = min(there, here)
            linked[i, j] = linked[j, i] = both
    for (i, j), n in sorted(want.items(), key=lambda x: (-x[1], x[0])):
        more = min(n - linked[i, j], left.get(j, 0))
        linked[i, j] += more
        back[j, i] = back.get((j, i), 0) + more
        left[j] = left.get(j, 0) - more
    return {"linked": linked, "free": back}


def assign(
    docs: DataFrame, text: str = "text", keep: list[str] | None = None, options: Shards = Shards()
) -> DataFrame:
    """One row per input row: ``doc`` (a struct of the columns ``keep``, all by default) and
    ``place`` (``size``, ``text_crc32``, ``shard``, ``slot``).

    Counts of shards differ by at most one.  Size is the UTF-8 bytes of the text plus one; a
    null text counts as no bytes, has the checksum of the empty text and is linked with nothing.
    Repeated rows are rows like others, linked when their texts are equal.  An empty table gives
    an empty result; extra columns ride along inside ``doc``.

    Rows are stored with a number of their own, texts are replaced by a 256-bit digest, and each
    round's shards are stored.  Only flows between shards, ``count`` squared numbers, are planned
    on the driver.
    """
    kept_columns = docs.select(*(f"`{c}`" for c in keep)) if keep else docs
    t = F.col(f"`{text}`")
    raw = F.coalesce(t, F.lit("")).cast("binary")
    stored = materialize(
        docs.select(
            whole(kept_columns),
            (F.octet_length(raw) + 1).cast("bigint").alias("size"),
            F.crc32(raw).alias("text_crc32"),
            F.when(t.isNotNull(), F.unhex(F.sha2(raw, 256))).alias("digest"),
        ).withColumn("row", F.monotonically_increasing_id()),
        "shard-rows",
    )
    total = stored.count()
    groups = max(1, -(-total // options.group_rows))
    room = max(1, total // options.count // 2)

    # Links: groups of two or more; the chunks of a large one count as groups of their own.
    sizes = stored.filter("digest is not null").groupBy("digest").agg(F.count(F.lit(1)).alias("n"))
    linked = materialize(
        sizes.filter("n > 1").select("digest", F.ceil(F.col("n") / room).cast("int").alias("chunks")),
        "linked-texts",
    )
    chunk = F.pmod(F.xxhash64("row"), F.col("chunks"))
    first = F.xxhash64("digest", F.lit(options.count))
    large = F.pmod(first + F.shiftright(chunk, 1), F.lit(options.count)).cast("int")
    rows = stored.select("row", "digest").join(linked, "digest", "left").select(
        "row",
        F.when(F.col("chunks").isNotNull(), F.xxhash64("digest", chunk)).alias("link"),
        F.when(F.col("chunks") > 1, large).alias("fixed"),
    )
    numbered = dense_index(rows, [], F.xxhash64("row"), "at", groups)
    state = materialize(
        numbered.select(
            "row", "link", "fixed", F.pmod("at", F.lit(options.count)).cast("int").alias("shard")
        ),
        "shards-0",
    )
    # Shards that large groups nearly fill are closed to the others.
    fixed = {r["fixed"]: r["count"] for r in state.groupBy("fixed").count().collect()}
    full = 0.8 * total / options.count
    every = range(options.count)
    opened = [i for i in every if fixed.get(i, 0) < full] or list(every)
    shards = F.array(*(F.lit(i) for i in opened))
    some = F.get(shards, F.pmod(F.xxhash64("link"), F.lit(len(opened))).cast("int"))
    for number in range(options.rounds):
        # Rows without a link stay out of the join: their null keys would meet in one task.
        columns = ["row", "link", "fixed", "shard"]
        tied = state.filter("link is not null").join(_homes(state, opened), "link", "left")
        tied = tied.select(*columns, F.coalesce("fixed", "home", some).alias("home"), F.lit(False).alias("free"))
        loose = state.filter("link is null")
        loose = loose.select(*columns, F.col("shard").alias("home"), F.lit(True).alias("free"))
        aimed = materialize(tied.unionByName(loose), "shard-aims")
        counts = aimed.groupBy("shard", "home", "free").agg(F.count(F.lit(1)).alias("n")).collect()
        wants = [(r["shard"], r["home"], r["n"]) for r in counts if r["shard"] != r["home"]]
        if not wants:
            break
        spare = {r["shard"]: r["n"] for r in counts if r["free"]}
        flows = _flows(wants, spare, options.count)
        quotas = docs.sparkSession.createDataFrame(
            _cuts(flows), "shard int, home int, free boolean, low long, high long, to int"
        )
        # Movers of a pair of shards, and the free documents of a shard, are counted off.
        movers = aimed.filter("free or shard <> home")
        movers = dense_index(
            movers, ["shard", "home", "free"], F.xxhash64("row", F.lit(number)), "at", groups
        )
        key = ["shard", "home", "free"]
        moved = movers.join(F.broadcast(quotas), key).filter("at >= low and at < high")
        state = materialize(
            aimed.join(moved.select("row", "to"), "row", "left").select(
                "row", "link", "fixed", F.coalesce("to", "shard").alias("shard")
            ),
            f"shards-{number + 1}",
        )
    slots = dense_index(state.select("row", "shard"), ["shard"], F.xxhash64("row"), "slot", groups)
    return stored.join(slots, "row").select(
        "doc", F.struct("size", "text_crc32", "shard", "slot").alias("place")
    )


def _cuts(flows: dict) -> list[tuple[int, int, bool, int, int, int]]:
    """Ranges of counted-off documents and where they go: at most two per pair of shards."""
    plan = [(i, j, False, 0, n, j) for (i, j), n in sorted(flows["linked"].items()) if n]
    at: dict[int, int] = {}
    for (j, i), n in sorted(flows["free"].items()):
        if n:
            low = at.get(j, 0)
            plan.append((j, j, True, low, low + n, i))
            at[j] = low + n
    return plan


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = assign(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return placed.select(
        "doc.doc_id",
        "place.size",
        "place.text_crc32",
        F.lit("rows").alias("law"),
        "place.shard",
        "place.slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
