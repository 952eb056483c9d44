"""Secret scans that link the parts of a credential.

Three kinds of strong spans are reported wherever they stand.  Weak candidates (short access
identifiers, account names, long key-like strings, endpoints) are reported only when parts that
complete each other stand in one scope: a stretch around an access identifier.  Scopes of a
document are disjoint intervals; candidates meet them by an interval join on position bins.
JVM functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from genopile.functions.once import with_once
from genopile.llm.common import table, whole
from genopile.storage import materialize

# Fixed patterns of the strong kinds, in the order in which equal starts are listed.
ASSIGN = (
    r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
# Runs are taken whole, so a least length in the pattern is the same as dropping short matches.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
SPANS = "array<struct<start:int,end:int,kind:int>>"
KINDS = ("assign", "access", "hex", "ident", "key", "endpoint")

# Weak parts: an identifier, a key-like string, an endpoint.
IDENT = r"(?:AKIA|ASIA)[A-Z0-9]{8,}|(?i:user(?:name)?|login|client_?id|account)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9_.@-]{3,}"
KEY = r"[A-Za-z0-9+/]{32,}={0,2}"
ENDPOINT = r"(?i:https?|ftp|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\s\"'<>]{4,}"


@dataclass(frozen=True)
class Scopes:
    # A scope reaches so many code points to either side of an access identifier.
    reach: int = 200


def _spans(text: Column, kind: int, pattern: str, holds) -> Column:
    """Leftmost non-overlapping matches that ``holds`` accepts, as (start, end, kind).

    Spark gives matches and the text between them, but no positions: these are the running
    lengths of both.
    """
    gaps = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.zip_with(
        F.transform(F.slice(gaps, 1, F.size(found)), lambda g: F.length(g)),
        found,
        lambda g, m: F.struct(g.alias("gap"), m.alias("m")),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("spans"))

    def step(a: Column, x: Column) -> Column:
        begin = a["at"] + x["gap"]
        end = begin + F.length(x["m"])
        one = F.array(F.struct(begin.alias("start"), end.alias("end"), F.lit(kind).alias("kind")))
        return F.struct(
            end.alias("at"),
            F.when(holds(x["m"]), F.concat(a["spans"], one)).otherwise(a["spans"]).alias("spans"),
        )

    return F.when(
        text.rlike(pattern), F.aggregate(pairs, start, step, lambda a: a["spans"])
    ).otherwise(F.array().cast(SPANS))


def _listed(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    ordered = F.array_sort(
        F.transform(spans, lambda s: F.struct(s["start"], s["kind"], s["end"]))
    )
    return F.array_join(
        F.transform(
            ordered,
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"]),
        ),
        ",",
    )


def _linked(weak: DataFrame, reach: int) -> DataFrame:
    """Weak spans that complete each other, per ``row``.

    ``weak`` has ``row``, ``start``, ``end``, ``kind`` and ``weak`` (false for strong spans, which
    only complete others).  An access span or a weak identifier opens a scope; scopes that touch
    are merged by their running maximum.  A part is in a scope that it touches, wherever it starts.
    A scope counts when it also holds a secret part.
    """
    anchor = F.col("kind").isin(KINDS.index("access"), KINDS.index("ident"))
    begin, end = F.greatest(F.lit(0), F.col("start") - reach), F.col("end") + reach
    order = Window.partitionBy("row").orderBy("low", "high")
    reached = F.max("high").over(order.rowsBetween(Window.unboundedPreceding, -1))
    islands = (
        weak.filter(anchor)
        .select("row", begin.alias("low"), end.alias("high"))
        .withColumn("new", F.coalesce((F.col("low") > reached).cast("int"), F.lit(1)))
        .withColumn("scope", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("row", "scope")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"))
    )
    width = 2 * reach
    binned = islands.withColumn(
        "bin",
        F.explode(
            F.sequence(
                F.floor(F.col("low") / width).cast("int"), F.floor(F.col("high") / width).cast("int")
            )
        ),
    )
    bin_of = lambda c: F.floor(F.col(c) / width).cast("int")
    parts = weak.withColumn("bin", F.explode(F.sequence(bin_of("start"), bin_of("end"))))
    # A part and a scope that share several bins meet in the first of them.
    inside = parts.join(binned, ["row", "bin"]).filter(
        (F.col("start") <= F.col("high"))
        & (F.col("end") >= F.col("low"))
        & (F.col("bin") == F.greatest(bin_of("start"), bin_of("low")))
    )
    secret = F.col("kind").isin(*(KINDS.index(k) for k in ("assign", "hex", "key")))
    good = inside.groupBy("row", "scope").agg(F.max(secret.cast("int")).alias("complete"))
    return (
        inside.filter("weak")
        .join(good.filter("complete = 1"), ["row", "scope"])
        .groupBy("row")
        .agg(F.collect_set(F.struct("start", "end", "kind")).alias("extra"))
    )


def scan(
    docs: DataFrame,
    text: str = "text",
    keep: list[str] | None = None,
    options: Scopes = Scopes(),
) -> DataFrame:
    """One row per input row: ``doc`` (a struct of the columns ``keep``, all by default) and
    ``secrets``: the counts, ``base`` and ``spans`` (arrays of start, end, kind; code points).

    Null and empty texts have no spans.  Repeated rows are scanned each on its own; an empty
    table gives an empty result; extra columns ride along inside ``doc``.  A span set of one
    document is collected, which its text bounds.

    Only rows with a weak part and an identifier take part in the joins.  Rows are stored once
    in the shared folder with an id of their own, as ids of documents may repeat.
    """
    kept_columns = docs.select(*(f"`{c}`" for c in keep)) if keep else docs
    body = docs.select(whole(kept_columns), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    t = F.col("_text")
    value = lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 6
    always = lambda m: F.lit(True)
    found = with_once(
        body,
        {
            "base": F.concat(
                _spans(t, 0, ASSIGN, value),
                _spans(t, 1, ACCESS, always),
                _spans(t, 2, HEX, always),
            ),
            "weak": F.when(
                t.rlike(f"{ACCESS}|{IDENT}"),
                F.concat(
                    _spans(t, 3, IDENT, always),
                    _spans(t, 4, KEY, always),
                    _spans(t, 5, ENDPOINT, always),
                ),
            ).otherwise(F.array().cast(SPANS)),
        },
    ).drop("_text")
    rows = materialize(found.withColumn("row", F.monotonically_increasing_id()), "secret-spans")
    # Weak spans that a strong one contains say nothing new; wider ones do.
    fresh = F.filter(
        F.col("weak"),
        lambda w: ~F.exists(F.col("base"), lambda b: (b["start"] <= w["start"]) & (w["end"] <= b["end"])),
    )
    scoped = rows.filter(F.size("weak") > 0).select(
        "row",
        F.explode(
            F.concat(
                F.transform("base", lambda s: F.struct(s["start"], s["end"], s["kind"], F.lit(False).alias("weak"))),
                F.transform(fresh, lambda s: F.struct(s["start"], s["end"], s["kind"], F.lit(True).alias("weak"))),
            )
        ).alias("s"),
    )
    extra = materialize(_linked(scoped.select("row", "s.*"), options.reach), "linked-secrets")
    joined = rows.join(extra, "row", "left")
    none = F.array().cast(SPANS)
    n = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint")
    return joined.select(
        "doc",
        F.struct(
            n(0).alias("n_assign"),
            n(1).alias("n_access"),
            n(2).alias("n_hex"),
            F.col("base"),
            F.concat("base", F.coalesce("extra", none)).alias("spans"),
        ).alias("secrets"),
    )


def masked(text: Column, spans: Column) -> Column:
    """The text with every span replaced by ``<kind>``; overlapping spans count as one."""
    names = F.array(*(F.lit(f"<{k}>") for k in KINDS))
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["end"], s["kind"])))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(a: Column, s: Column) -> Column:
        cut = F.substring(text, a["at"] + 1, s["start"] - a["at"])
        piece = F.array(cut, F.get(names, s["kind"]))
        return F.struct(
            F.greatest(a["at"], s["end"]).alias("at"),
            F.when(s["start"] >= a["at"], F.concat(a["out"], piece)).otherwise(a["out"]).alias("out"),
        )

    rest = lambda a: F.concat(
        F.array_join(a["out"], ""), F.substring(text, a["at"] + 1, F.length(text))
    )
    return F.when(F.size(spans) > 0, F.aggregate(ordered, zero, step, rest)).otherwise(text)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = scan(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return scanned.select(
        "doc.doc_id",
        "secrets.n_assign",
        "secrets.n_access",
        "secrets.n_hex",
        F.sha2(_listed(F.col("secrets.base")), 256).alias("base_sha256"),
        _listed(F.col("secrets.spans")).alias("spans"),
    )
