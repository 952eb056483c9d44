"""Chat formatting: tool calls linked with their results, ordered, validated, as canonical JSON.

Assistant messages may be JSON objects with ``tool_calls`` (``id``, ``name``, ``arguments``,
``after``: ids of calls that must come first); tool messages are JSON objects with
``tool_call_id`` and ``content``.  Calls and results are joined by conversation and identifier.
Every event gets a level that exceeds those of the calls it depends on.  One row and one line of
JSON come out for every message, call and result: a conversation is never gathered in one row.
JVM functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from genopile.functions.once import with_once
from genopile.llm.common import table, whole, words
from genopile.storage import materialize

# Per tool its arguments: type (as a JSON type) and whether they are required.
Schemas = dict[str, dict[str, tuple[str, bool]]]

# Spark's names of variant types, by JSON type.
_TYPES = {
    "string": "STRING",
    "integer": "BIGINT",
    "number": "BIGINT|DOUBLE|FLOAT|DECIMAL.*",
    "boolean": "BOOLEAN",
    "array": "ARRAY<.*",
    "object": "OBJECT<.*",
}
_ORDER_STEP = 1 << 20


def errors_of(name: Column, arguments: Column, schemas: Schemas) -> Column:
    """What is wrong with a call's arguments (JSON text): an array of strings, empty if nothing."""
    value = F.try_parse_json(arguments)
    keys = F.coalesce(F.json_object_keys(arguments), F.array().cast("array<string>"))
    out = F.array(F.lit("unknown tool"))
    for tool, fields in schemas.items():
        found: list[Column] = []
        for field, (kind, required) in fields.items():
            seen = F.schema_of_variant(F.try_variant_get(value, f"$['{field}']", "variant"))
            present = F.array_contains(keys, field)
            wrong = present & ~F.coalesce(seen.rlike(f"^({_TYPES[kind]})$"), F.lit(False))
            found.append(F.when(wrong, F.lit(f"type:{field}")))
            if required:
                found.append(F.when(~present, F.lit(f"missing:{field}")))
        extra = F.transform(
            F.array_sort(F.array_except(keys, F.array(*(F.lit(f) for f in fields)))),
            lambda k: F.concat(F.lit("extra:"), k),
        )
        checked = F.concat(F.array_compact(F.array(*found)), extra)
        out = F.when(name == tool, checked).otherwise(out)
    is_object = F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))
    return F.when(is_object, out).otherwise(F.array(F.lit("bad arguments")))


def _events(messages: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """One row a message, call or result: ``ord`` orders them as written."""
    who, said = F.col(f"`{role}`"), F.col(f"`{text}`")
    value = F.when(who.isin("assistant", "tool"), F.try_parse_json(said))
    none = F.lit(None).cast("string")
    call = "array<struct<id:string,name:string,arguments:variant,after:array<string>>>"
    got = F.struct(
        F.try_variant_get(value, "$.tool_calls", call).alias("calls"),
        F.try_variant_get(value, "$.tool_call_id", "string").alias("answers"),
        F.to_json(F.try_variant_get(value, "$.content", "variant")).alias("content"),
    )
    empty = F.array().cast("array<string>")
    message = F.struct(
        F.lit("message").alias("kind"), none.alias("id"), none.alias("name"), none.alias("body"), empty.alias("after")
    )
    result = F.struct(
        F.lit("result").alias("kind"), F.col("got.answers").alias("id"), none.alias("name"),
        F.col("got.content").alias("body"), F.array("got.answers").alias("after"),
    )
    calls = F.transform(
        "got.calls",
        lambda c: F.struct(
            F.lit("call").alias("kind"), c["id"].alias("id"), c["name"].alias("name"),
            F.to_json(c["arguments"]).alias("body"), F.coalesce(c["after"], empty).alias("after"),
        ),
    )
    made = (
        F.when((F.col("role") == "assistant") & (F.size("got.calls") > 0), calls)
        .when((F.col("role") == "tool") & F.col("got.answers").isNotNull(), F.array(result))
        .otherwise(F.array(message))
    )
    base = messages.select(
        whole(messages, "row"),
        F.col(f"`{conv}`").alias("conv"),
        F.col(f"`{turn}`").cast("bigint").alias("turn"),
        who.alias("role"),
        said.alias("text"),
        got.alias("got"),
    )
    return base.select(
        "row", "conv", "turn", "role", "text", F.posexplode(made).alias("index", "event")
    ).select(
        "row",
        "conv",
        "turn",
        "role",
        F.when(F.col("event.kind") == "message", F.col("text")).alias("text"),
        "event.*",
        (F.coalesce("turn", F.lit(0)) * _ORDER_STEP + F.col("index")).alias("ord"),
    )


def _levels(events: DataFrame) -> DataFrame:
    """``event``, ``level``, ``cyclic`` of calls and results that must wait for a later call.

    An event's level starts as its place in the conversation, so only dependencies that point
    forward move it.  Each round raises levels above those of the calls an event waits for; the
    rounds end when none rises.  Levels never climb round a cycle: events whose last raises form
    one (looked for in rounds 2, 4, 8, ...), or that still rise after as many rounds as their
    conversation has edges, are put at a limit past every place and call.  So are the events that
    wait for these; all of them are cyclic and keep their own places.
    """
    heads = events.filter("kind = 'call' and first").select(
        "conv", F.col("id").alias("dep"), F.col("event").alias("head"), F.col("ord").alias("head_ord")
    )
    waits = events.select("conv", "event", "ord", F.explode(F.array_distinct("after")).alias("dep"))
    edges = waits.join(heads, ["conv", "dep"]).filter("head <> event")
    edges = materialize(edges.select("conv", "event", "ord", "head", "head_ord"), "call-edges")
    forward = edges.filter("head_ord >= ord").select("conv").distinct()
    edges = materialize(edges.join(forward, "conv", "left_semi"), "forward-edges")
    limits = edges.groupBy("conv").agg(
        (F.max(F.greatest("ord", "head_ord")) + F.count(F.lit(1)) + 1).alias("limit"),
        F.count(F.lit(1)).alias("edges"),
    )
    level = materialize(
        edges.select("conv", "event", F.col("ord").alias("level"))
        .union(edges.select("conv", "head", "head_ord"))
        .distinct()
        .join(limits, "conv")
        .withColumn("by", F.lit(None).cast("long")),
        "call-levels",
    )
    rounds = 0
    while level.limit(1).count():
        rounds += 1
        tops = (
            edges.join(level.select(F.col("event").alias("head"), F.col("level").alias("above")), "head")
            .groupBy("event")
            .agg(F.max(F.struct((F.col("above") + 1).alias("above"), "head")).alias("top"))
            .select("event", "top.*")
        )
        raised = F.least("limit", F.greatest("level", F.coalesce("above", "level")))
        rose = raised > F.col("level")
        level = materialize(
            level.join(tops, "event", "left").select(
                "conv",
                "event",
                F.when(rose & (F.col("edges") < rounds), F.col("limit")).otherwise(raised).alias("level"),
                "limit",
                "edges",
                F.when(rose, F.col("head")).otherwise(F.col("by")).alias("by"),
                rose.alias("rose"),
            ),
            "call-levels",
        )
        more = level.filter("rose").limit(1).count()
        level = level.drop("rose")
        if not more:
            break
        if rounds > 1 and rounds & (rounds - 1) == 0:
            loops = _endless(level.filter("level < limit and by is not null").select("event", "by"))
            top = F.when(F.col("loop"), F.col("limit")).otherwise(F.col("level"))
            level = materialize(
                level.join(loops.withColumn("loop", F.lit(True)), "event", "left")
                .withColumn("level", top)
                .drop("loop"),
                "call-levels",
            )
    return level.select("event", "level", (F.col("level") >= F.col("limit")).alias("cyclic"))


def _endless(steps: DataFrame) -> DataFrame:
    """``event`` of those rows (``event``, ``by``; one an event) whose steps never end.

    Steps double each round.  A chain that ends has events at every distance from its end, so
    once a doubling drops no row, those left lead into cycles.
    """
    far = materialize(steps, "call-steps")
    n = far.count()
    while n:
        ahead = far.select(F.col("event").alias("by"), F.col("by").alias("next"))
        far = materialize(far.join(ahead, "by").select("event", F.col("next").alias("by")), "call-steps")
        n, before = far.count(), n
        if n == before:
            break
    return far.select("event")


def link(
    messages: DataFrame,
    schemas: Schemas,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per message, call and result: ``row`` (the input row) and ``chat``.

    ``chat`` has ``kind``, ``call_id``, ``level``, ``ord``, ``status``, ``errors``, ``json``.
    Sorting a conversation by ``(level, ord)`` puts every call after the calls it waits for and
    every result after its call.  Status of calls: ``linked``, ``pending`` (no result),
    ``duplicate`` (an earlier call has the id), ``cyclic``; of results: ``linked``, ``orphan`` (no
    call), ``duplicate``; of messages: ``message``.  Text that is not such JSON is a message.

    Null texts are messages with null content; a null conversation links nothing; a null turn
    counts as 0; repeated rows give duplicates; an empty table gives an empty result; extra
    columns ride along inside ``row``.  Joins meet one call or one result an identifier, so equal
    identifiers, however many, never multiply.
    """
    events = _events(messages, conv, turn, role, text)
    events = materialize(events.withColumn("event", F.monotonically_increasing_id()), "chat-events")
    # The first call and the first result of every identifier.
    firsts = (
        events.filter("kind <> 'message' and id is not null and conv is not null")
        .groupBy("conv", "id")
        .agg(
            F.min(F.when(F.col("kind") == "call", F.struct("ord", "event")))["event"].alias("call"),
            F.min(F.when(F.col("kind") == "result", F.struct("ord", "event")))["event"].alias("result"),
        )
    )
    # Messages have no identifier; their null keys would meet in one task.
    slim = events.drop("row", "text")
    named = F.col("id").isNotNull() & F.col("conv").isNotNull()
    marked = slim.filter(named).join(firsts, ["conv", "id"], "left")
    marked = marked.unionByName(slim.filter(~named), allowMissingColumns=True)
    first = F.when(F.col("kind") == "call", F.col("event") == F.col("call")).otherwise(
        F.col("event") == F.col("result")
    )
    marked = materialize(marked.withColumn("first", F.coalesce(first, F.lit(False))), "linked-events")
    placed = marked.join(_levels(marked), "event", "left")
    both = F.col("call").isNotNull() & F.col("result").isNotNull()
    status = (
        F.when(F.col("kind") == "message", "message")
        .when((F.col("kind") == "result") & F.col("call").isNull(), "orphan")
        .when(~F.col("first"), "duplicate")
        .when(F.coalesce("cyclic", F.lit(False)), "cyclic")
        .when(both, "linked")
        .otherwise("pending")
    )
    errors = F.when(F.col("kind") == "call", errors_of(F.col("name"), F.col("body"), schemas)).otherwise(
        F.array().cast("array<string>")
    )
    level = F.when(F.coalesce("cyclic", F.lit(False)), F.col("ord")).otherwise(
        F.coalesce("level", "ord")
    )
    facts = with_once(placed, {"errors": errors}).select(
        "event", "errors", status.alias("status"), level.alias("level")
    )
    out = events.join(facts, "event")
    null = F.lit("null")
    field = lambda name, c: F.concat(F.lit(f'"{name}":'), F.coalesce(c, null))
    line = (
        F.when(
            F.col("kind") == "call",
            F.concat_ws(
                ",",
                field("arguments", F.col("body")),
                field("call", _json_string(F.col("id"))),
                field("name", _json_string(F.col("name"))),
                field("role", _json_string(F.col("role"))),
            ),
        )
        .when(
            F.col("kind") == "result",
            F.concat_ws(
                ",",
                field("content", F.col("body")),
                field("result", _json_string(F.col("id"))),
                field("role", _json_string(F.col("role"))),
            ),
        )
        .otherwise(
            F.concat_ws(
                ",",
                field("content", _json_string(F.col("text"))),
                field("role", _json_string(F.col("role"))),
            )
        )
    )
    return out.select(
        "row",
        F.struct(
            "kind",
            F.col("id").alias("call_id"),
            "level",
            "ord",
            "status",
            "errors",
            F.concat(F.lit("{"), line, F.lit("}")).alias("json"),
        ).alias("chat"),
    )


def _json_string(text: Column) -> Column:
    """A text as a JSON string; null for null."""
    wrapped = F.to_json(F.array(text))
    return F.when(text.isNotNull(), F.substring(wrapped, F.lit(2), F.length(wrapped) - 2))


# The tools that the query's derived calls name.
REPLY: Schemas = {
    "reply": {"text": ("string", True), "words": ("integer", True)},
    "note": {"text": ("string", True)},
}


def as_tool_messages(talks: DataFrame) -> DataFrame:
    """Conversations as tool use: an assistant's turn is a call, the next user turn its result.

    Calls wait for the assistant's call before; every third one is named ``note``, which takes no
    count of words, so its arguments are invalid.
    """
    said = F.coalesce("text", F.lit(""))
    call = F.struct(
        F.array(
            F.struct(
                F.concat(F.lit("t"), F.col("turn")).alias("id"),
                F.when(F.col("turn") % 3 == 0, "note").otherwise("reply").alias("name"),
                F.struct(F.size(words(said)).alias("words"), said.alias("text")).alias("arguments"),
                F.array(F.concat(F.lit("t"), F.col("turn") - 2)).alias("after"),
            )
        ).alias("tool_calls")
    )
    result = F.struct(
        F.concat(F.lit("t"), F.col("turn") - 1).alias("tool_call_id"), said.alias("content")
    )
    return talks.select(
        "conv_id",
        "turn",
        F.when(F.col("role") == "user", "tool").otherwise(F.col("role")).alias("role"),
        F.when(F.col("role") == "assistant", F.to_json(call))
        .when(F.col("role") == "user", F.to_json(result))
        .otherwise(F.col("text"))
        .alias("text"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = link(as_tool_messages(table(spark, sf_dir, "conversations")), REPLY)
    return linked.select(
        "row.conv_id",
        "row.turn",
        "chat.kind",
        "chat.call_id",
        "chat.level",
        "chat.ord",
        "chat.status",
        F.array_join("chat.errors", ",").alias("errors"),
        "chat.json",
    )
