"""Conversation structure repair by generalised LR parsing over the role grammar.

A conversation is a sentence of role initials; legal ones are an optional system message and then
pairs of user and assistant.  The parser's stacks of LR states are kept side by side, one a state on
top: before every message a stack may insert the symbol it lacks, then it keeps, reroles or deletes
the message.  Stacks with equal tops merge into the one of least (cost, audit), as what may follow
depends on the top alone.  The audit lists the edits' initials; among edits of equal cost the
ASCII-least audit wins.

Messages are sorted by conversation and turn into ranges, each one task's work, so no conversation
has to fit a task.  Conversations inside a range are repaired there and then.  Those at a range's ends
may continue in the next one: their pieces are parsed from every stack that may come in, an
(entry, exit) table of costs a piece is joined over the conversation, and the chosen edits follow.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from genopile.llm.common import table
from genopile.storage import materialize

# The grammar and its SLR(1) automaton.
#   Talk -> (nothing) | Pairs | s Pairs      Pairs -> Pair | Pairs Pair      Pair -> u a
SHIFT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (5, "u"): 2, (7, "u"): 2}
REDUCE = {3: ("Pair", 2), 4: ("Pairs", 1), 6: ("Pairs", 2)}
GOTO = {(0, "Pair"): 4, (1, "Pair"): 4, (5, "Pair"): 6, (7, "Pair"): 6, (0, "Pairs"): 5, (1, "Pairs"): 7}
ACCEPTS = {0, 5, 7}
# Stacks that stand for every stack with the same choices left; 7 goes on as 5 does.
ENTRIES = ((0,), (0, 1), (0, 2), (0, 5))
EXIT = {0: 0, 1: 1, 2: 2, 5: 3, 7: 3}
NAMES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}

BLANKS = "\x20\t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Costs:
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5


Stack = tuple[int, ...]
# Stacks with their costs above the least one, in the order of their audits.
Tops = tuple[tuple[Stack, int], ...]


def shifted(stack: Stack, symbol: str) -> Stack | None:
    """The stack after a symbol and all reductions, or none."""
    state = SHIFT.get((stack[-1], symbol))
    if state is None:
        return None
    stack = (*stack, state)
    while stack[-1] in REDUCE:
        name, length = REDUCE[stack[-1]]
        stack = stack[:-length]
        stack = (*stack, GOTO[stack[-1], name])
    return stack


class Kind(NamedTuple):
    """What the parser needs to know of a message; ``end`` stands behind the last one."""

    initial: str
    gone: bool = False
    cut: bool = False
    end: bool = False


END = Kind("", end=True)


@lru_cache(maxsize=1 << 16)
def advance(tops: Tops, kind: Kind, costs: Costs) -> tuple[Tops, int, tuple[tuple[int, str], ...]]:
    """Stacks after one message, the least cost added, and each one's origin and edits.

    Edits of a message begin with the inserts before it, so no audit of the same messages begins
    another, and audits compare by their order so far and then by the new edits.  Stacks that cost
    more than any detour to the cheapest one's choices (a pair inserted, a message deleted) go.
    """
    best: dict[int, tuple[int, int, str, Stack]] = {}

    def offer(to: dict, item: tuple[int, int, str, Stack]) -> bool:
        old = to.get(item[3][-1])
        if old is None or item < old:
            to[item[3][-1]] = item
            return True
        return False

    for rank, (stack, cost) in enumerate(tops):
        offer(best, (cost, rank, "", stack))
    waiting = sorted(best.values())
    while waiting:
        cost, rank, edits, stack = waiting.pop(0)
        for symbol in NAMES:
            grown = shifted(stack, symbol)
            if grown and offer(best, item := (cost + costs.insert, rank, edits + "I", grown)):
                waiting.append(item)
    after: dict[int, tuple[int, int, str, Stack]] = {}
    for cost, rank, edits, stack in best.values():
        if kind.end:
            if stack[-1] in ACCEPTS:
                offer(after, (cost, rank, edits, stack))
            continue
        offer(after, (cost + costs.delete, rank, edits + "D", stack))
        if kind.gone:
            continue
        kept = cost + (costs.truncated if kind.cut else 0)
        if grown := shifted(stack, kind.initial):
            offer(after, (kept, rank, edits + "K", grown))
        for symbol in NAMES:
            if grown := shifted(stack, symbol):
                offer(after, (kept + costs.rerole, rank, edits + "R", grown))
    least = min(item[0] for item in after.values())
    far = 2 * costs.insert + costs.delete
    ordered = sorted((x for x in after.values() if x[0] <= least + far), key=lambda x: (x[1], x[2]))
    return (
        tuple((stack, cost - least) for cost, _, _, stack in ordered),
        least,
        tuple((rank, edits) for _, rank, edits, _ in ordered),
    )


class Parse:
    """Stacks over a stretch of messages from one stack that came in."""

    def __init__(self, kinds: list[Kind], entry: Stack, costs: Costs) -> None:
        self.tops: Tops = ((entry, 0),)
        self.base, self.steps = 0, []
        for kind in kinds:
            self.tops, least, origins = advance(self.tops, kind, costs)
            self.base += least
            self.steps.append(origins)

    def edits(self, rank: int) -> list[str]:
        """The edits of every message that lead to a top."""
        out = []
        for origins in reversed(self.steps):
            rank, edits = origins[rank]
            out.append(edits)
        return out[::-1]

    def exits(self) -> dict[int, tuple[int, int]]:
        """Least (cost, place among the tops) by exit."""
        found: dict[int, tuple[int, int]] = {}
        for rank, (stack, cost) in enumerate(self.tops):
            way = EXIT[stack[-1]]
            found[way] = min(found.get(way, (self.base + cost, rank)), (self.base + cost, rank))
        return found


def apply_edits(
    edits: list[str], roles: list[str], texts: list[str], entry: Stack
) -> Iterator[list[tuple[str, str]]]:
    """Messages that stand in the place of each one; ``edits`` may have a last entry for the end."""
    state = entry
    for i, tokens in enumerate(edits):
        out = []
        for edit in tokens:
            if edit == "D":
                continue
            if edit == "K":
                role, text, symbol = roles[i], texts[i], roles[i][:1]
            else:  # only one of the two can follow
                symbol = next(s for s in NAMES if shifted(state, s))
                role, text = NAMES[symbol], texts[i] if edit == "R" else ""
            state = shifted(state, symbol)
            out.append((role, text))
        yield out


def _lines(messages: list[tuple[str, str]]) -> str:
    return "\n".join(f"{role}:{text}" for role, text in messages)


def _kinds(initials, gone, cut) -> list[Kind]:
    return [Kind(i, bool(g), bool(c)) for i, g, c in zip(initials, gone, cut)]


# Counters that may be null; they pass pandas as text, which would make them floats.
TURNS = ("first_turn", "last_turn")


class Counts(NamedTuple):
    """What is summed over a piece; pieces of a conversation add up in order."""

    blank: int
    duplicate: int
    truncated: int
    illegal: int
    turns: int
    first_turn: int | None
    last_turn: int | None
    first: str
    last: str

    def __add__(self, more: Counts) -> Counts:
        turns = self.turns + more.turns
        if self.last_turn is not None and self.last_turn == more.first_turn:
            turns -= 1
        return Counts(
            self.blank + more.blank,
            self.duplicate + more.duplicate,
            self.truncated + more.truncated,
            self.illegal + more.illegal + (self.last + more.first not in LEGAL),
            turns,
            more.first_turn if self.first_turn is None else self.first_turn,
            self.last_turn if more.last_turn is None else more.last_turn,
            self.first,
            more.last,
        )

    @property
    def gaps(self) -> int:
        return 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns


def counted(turns, initials: list[str], blank, duplicate, cut) -> Counts:
    """Counts of messages in the order of their turns."""
    known = [t for t in turns if t is not None]
    return Counts(
        sum(map(bool, blank)),
        sum(map(bool, duplicate)),
        sum(map(bool, cut)),
        sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
        len(set(known)),
        known[0] if known else None,
        known[-1] if known else None,
        initials[0],
        initials[-1],
    )


MESSAGES = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]))
FOUND = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


def _whole(rows: list[tuple], costs: Costs, with_messages: bool) -> dict:
    """The result for a conversation that lies in one range."""
    turns, roles, texts, blank, ended = zip(*rows)
    seen: set[tuple[str, str]] = set()
    duplicate = []
    for message, b in zip(zip(roles, texts), blank):
        duplicate.append(message in seen and not b)
        seen.add(message)
    cut = [not (b or d or e) for b, d, e in zip(blank, duplicate, ended)]
    initials = [r[:1] for r in roles]
    kinds = _kinds(initials, (b or d for b, d in zip(blank, duplicate)), cut)
    parse = Parse([*kinds, END], (0,), costs)
    cost, rank = min(
        (cost, rank) for rank, (_, cost) in enumerate(parse.tops)
    )
    edits = parse.edits(rank)
    messages = [m for part in apply_edits(edits, roles, texts, (0,)) for m in part]
    counts = counted(turns, initials, blank, duplicate, cut)
    return {
        "gaps": counts.gaps,
        **{k: getattr(counts, k) for k in ("blank", "duplicate", "truncated", "illegal")},
        "cost": parse.base + cost,
        "audit": "".join(edits),
        "repaired_sha256": hashlib.sha256(_lines(messages).encode("utf-8", "surrogatepass")).hexdigest(),
        "messages": [{"role": r, "text": t} for r, t in messages] if with_messages else None,
    }


def _ranges(costs: Costs, with_messages: bool, schema: pa.Schema):
    """Results of conversations inside a range; the messages of its first and last one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        out: list[dict] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out.clear()

        def open_ended(key, rows: list[tuple]) -> None:
            names = ("turn", "role", "text", "blank", "ended")
            out.extend({"key": key, "piece": part, "message": {"place": i, **dict(zip(names, r))}} for i, r in enumerate(rows))

        key, rows, first = None, [], True
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for k, *row in zip(*columns):
                if rows and k != key:
                    if first:
                        open_ended(key, rows)
                    else:
                        out.append({"key": key, "found": _whole(rows, costs, with_messages)})
                    rows, first = [], False
                    if len(out) >= 1000:
                        yield from flush()
                key = k
                rows.append(tuple(row))
        if rows:
            open_ended(key, rows)
        yield from flush()

    return run


def _tables(costs: Costs):
    """Of one piece: its counts and, from every entry to every exit, cost and place among audits."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        initials = rows["initial"].tolist()
        turns = [int(t) if isinstance(t, str) else None for t in rows["turn"]]
        counts = counted(turns, initials, rows["blank"], rows["duplicate"], rows["cut"])
        kinds = _kinds(initials, rows["blank"] | rows["duplicate"], rows["cut"])
        ways, audits = {}, {}
        for e, entry in enumerate(ENTRIES):
            parse = Parse(kinds, entry, costs)
            for x, (cost, rank) in parse.exits().items():
                ways[e, x], audits[e, x] = cost, "".join(parse.edits(rank))
        order = {a: i for i, a in enumerate(sorted(set(audits.values())))}
        return pd.DataFrame(
            {
                "key": rows["key"].iloc[:1].astype(object),
                "piece": [int(rows["piece"].iloc[0])],
                **{k: [str(v) if k in TURNS and v is not None else v] for k, v in counts._asdict().items()},
                "enters": [[e for e, _ in ways]],
                "leaves": [[x for _, x in ways]],
                "costs": [list(ways.values())],
                "audits": [[order[a] for a in audits.values()]],
            }
        )

    return run


def _joined(costs: Costs):
    """The way through all pieces of a conversation, one row a piece; the last has the totals."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("piece")
        # Entry to (cost, places of the audits so far, exits so far).
        best: dict[int, tuple[int, tuple, tuple]] = {0: (0, (), ())}
        counts = None
        for row in rows.to_dict("records"):
            more = Counts(**{k: row[k] for k in Counts._fields if k not in TURNS}, **{k: int(row[k]) if isinstance(row[k], str) else None for k in TURNS})
            counts = more if counts is None else counts + more
            after: dict[int, tuple[int, tuple, tuple]] = {}
            for enter, leave, cost, audit in zip(*(row[k] for k in ("enters", "leaves", "costs", "audits"))):
                if enter in best:
                    before, audits, exits = best[enter]
                    item = (before + cost, (*audits, audit), (*exits, leave))
                    after[leave] = min(after.get(leave, item), item)
            best = after
        ends = []
        for cost, audits, exits in best.values():
            tops, base, origins = advance(((ENTRIES[exits[-1]], 0),), END, costs)
            ends += [(cost + base + c, audits, edits, exits) for (_, c), (_, edits) in zip(tops, origins)]
        cost, _, tail, exits = min(ends)
        n = len(rows)
        last = [False] * (n - 1) + [True]
        return pd.DataFrame(
            {
                "key": rows["key"].astype(object),
                "piece": rows["piece"],
                "enter": [0, *exits[:-1]],
                "leave": exits,
                "tail": [tail if x else None for x in last],
                "gaps": counts.gaps,
                "blank": counts.blank,
                "duplicate": counts.duplicate,
                "truncated": counts.truncated,
                "illegal": counts.illegal,
                "cost": cost,
                "last": last,
            }
        )

    return run


def _edited(costs: Costs):
    """Messages of a piece after the edits of the chosen way."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        entry = ENTRIES[int(rows["enter"].iloc[0])]
        roles, texts = rows["role"].tolist(), rows["text"].tolist()
        kinds = _kinds([r[:1] for r in roles], rows["blank"] | rows["duplicate"], rows["cut"])
        parse = Parse(kinds, entry, costs)
        edits = parse.edits(parse.exits()[int(rows["leave"].iloc[0])][1])
        places = rows["place"].tolist()
        if isinstance(rows["tail"].iloc[0], str):
            edits, places = [*edits, rows["tail"].iloc[0]], [*places, len(places)]
        messages = apply_edits(edits, roles, texts, entry)
        return pd.DataFrame(
            {
                "key": rows["key"].iloc[0],
                "piece": rows["piece"].iloc[0],
                "place": places,
                "edits": edits,
                "messages": [[{"role": r, "text": t} for r, t in m] for m in messages],
            }
        )

    return run


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audit and hash of conversations from their edited messages in order, one at a time."""
    key, found, sha, audit, begun = None, False, None, [], False

    def done() -> pa.RecordBatch:
        values = [[key], ["".join(audit)], [sha.hexdigest()]]
        return pa.RecordBatch.from_arrays(
            [pa.array(v, t) for v, t in zip(values, (kind, pa.string(), pa.string()))],
            names=["key", "audit", "repaired_sha256"],
        )

    for batch in batches:
        kind = batch.schema.field(0).type
        columns = [batch.column(i).to_pylist() for i in range(3)]
        for k, edits, messages in zip(*columns):
            if not found or k != key:
                if found:
                    yield done()
                key, found, sha, audit, begun = k, True, hashlib.sha256(), [], False
            audit.append(edits)
            for m in messages:
                line = f"{m['role']}:{m['text']}"
                sha.update((f"\n{line}" if begun else line).encode("utf-8", "surrogatepass"))
                begun = True
    if found:
        yield done()


class Repaired(NamedTuple):
    # ``key`` and the columns of FOUND, one row a conversation.
    conversations: DataFrame
    # ``key``, ``piece``, ``place``, ``at``, ``role``, ``text``: ordered by the three numbers.
    messages: DataFrame | None


def repair(
    rows: DataFrame,
    key: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    costs: Costs = Costs(),
    with_messages: bool = False,
) -> Repaired:
    """Cheapest repair of every conversation.

    A null role or text counts as one blank, so it is an illegal role or a blank message.  Messages
    without a turn come first; equal turns are ordered by role, then text.  Repeated messages are
    duplicates of the first.  A null key is a conversation of its own.  An empty table gives no rows.
    Columns other than the four are not read.
    """
    kind = rows.schema[key].dataType
    clean = rows.select(
        F.col(f"`{key}`").alias("key"),
        F.col(f"`{turn}`").cast("bigint").alias("turn"),
        *(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")).alias(n) for c, n in ((role, "role"), (text, "text"))),
    ).withColumns(
        {
            "blank": ~F.col("text").rlike(r"[^\x20\x09-\x0D]"),
            "ended": F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"),
        }
    )
    # The row number lets ranges part messages that are all alike; these may change places.
    order = [F.col(c).asc_nulls_first() for c in ("key", "turn", "role", "text", "_id")]
    ranged = (
        clean.withColumn("_id", F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop("_id")
    )
    found = T.StructType.fromDDL(FOUND).add("messages", MESSAGES)
    message = T.StructType.fromDDL("place bigint, turn bigint, role string, text string, blank boolean, ended boolean")
    schema = T.StructType([T.StructField("key", kind)]).add("piece", "integer").add("message", message).add("found", found)
    arrow = pa.schema([(f.name, _arrow(f.dataType)) for f in schema])
    first = materialize(ranged.mapInArrow(_ranges(costs, with_messages, arrow), schema), "repair-ranges")
    inside = first.filter("found is not null").select("key", "found.*")

    open_ended = first.filter("message is not null").select("key", "piece", "message.*")
    hashed = open_ended.withColumn("h", F.sha2(F.concat("role", F.lit(":"), "text"), 256))
    place = F.struct("piece", "place")
    # The first message of its kind; role lengths keep "a:" + "b" apart from "a" + ":b".
    seen = hashed.groupBy(F.col("key").alias("k"), F.length("role").alias("n"), F.col("h").alias("s")).agg(F.min(place).alias("earliest"))
    same = F.col("key").eqNullSafe(F.col("k")) & (F.col("h") == F.col("s")) & (F.length("role") == F.col("n"))
    judged = hashed.join(seen, same).withColumn("duplicate", ~F.col("blank") & (place > F.col("earliest")))
    judged = materialize(
        judged.withColumn("cut", ~(F.col("blank") | F.col("duplicate") | F.col("ended"))).drop("h", "k", "n", "s", "earliest", "ended"),
        "open-messages",
    )
    name = f"key {kind.simpleString()}, piece int"
    counts = "blank bigint, duplicate bigint, truncated bigint, illegal bigint, turns bigint, first_turn string, last_turn string, first string, last string"
    ways = "enters array<int>, leaves array<int>, costs array<bigint>, audits array<int>"
    tables = (
        judged.withColumns({"initial": F.substring("role", 1, 1), "turn": F.col("turn").cast("string")})
        .drop("role", "text")
        .groupBy("key", "piece")
        .applyInPandas(_tables(costs), f"{name}, {counts}, {ways}")
    )
    totals = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint"
    paths = materialize(
        tables.groupBy("key").applyInPandas(_joined(costs), f"{name}, enter int, leave int, tail string, {totals}, last boolean"),
        "repair-paths",
    )
    chosen = paths.select(F.col("key").alias("k"), F.col("piece").alias("p"), "enter", "leave", "tail")
    edited = (
        judged.join(chosen, F.col("key").eqNullSafe(F.col("k")) & (F.col("piece") == F.col("p")))
        .drop("k", "p")
        .groupBy("key", "piece")
        .applyInPandas(_edited(costs), T.StructType.fromDDL(f"{name}, place bigint, edits string").add("messages", MESSAGES))
    )
    edited = materialize(edited, "edited-messages")
    digests = (
        edited.repartition("key")
        .sortWithinPartitions("key", "piece", "place")
        .select("key", "edits", "messages")
        .mapInArrow(_digests, f"key {kind.simpleString()}, audit string, repaired_sha256 string")
        .withColumnRenamed("key", "k")
    )
    across = (
        paths.filter("last")
        .join(digests, F.col("key").eqNullSafe(F.col("k")))
        .select("key", *(f.name for f in T.StructType.fromDDL(FOUND)))
    )
    together = inside.drop("messages").unionByName(across)
    messages = None
    if with_messages:
        parts = inside.select("key", F.lit(0).alias("piece"), F.lit(0).cast("bigint").alias("place"), "messages").unionByName(edited.drop("edits"))
        messages = parts.select("key", "piece", "place", F.posexplode("messages").alias("at", "m")).select("key", "piece", "place", "at", "m.*")
    return Repaired(together, messages)


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def damaged(rows: DataFrame) -> DataFrame:
    """Damage by a hash of conversation and turn: dropped, emptied, cut, repeated, mistaken for a user."""
    names = ("conv_id", "turn", "role", "text")
    shown = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in names}
    hit = F.crc32(F.concat(shown["conv_id"], F.lit(":"), shown["turn"]).cast("binary")) % 20
    text = F.when(hit == 1, "").when(hit == 2, F.translate(shown["text"], ".!?", "")).otherwise(shown["text"])
    copies = F.array_repeat(F.lit(0), F.when(hit == 3, 2).otherwise(1))
    return rows.filter(hit != 0).select(
        "conv_id",
        "turn",
        F.when(hit == 4, "user").otherwise(shown["role"]).alias("role"),
        text.alias("text"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    found = repair(damaged(rows)).conversations.withColumnRenamed("key", "k")
    every = rows.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("k")), "left")

    def column(name: str) -> Column:
        if name == "audit":
            return F.coalesce(F.col(name), F.lit("")).alias(name)
        if name == "repaired_sha256":
            return F.coalesce(F.col(name), F.sha2(F.lit("").cast("binary"), 256)).alias(name)
        return F.coalesce(F.col(name), F.lit(0).cast("bigint")).alias(name)

    return every.select("conv_id", *(column(f.name) for f in T.StructType.fromDDL(FOUND)))
