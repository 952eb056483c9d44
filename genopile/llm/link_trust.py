"""URL filters by trust and distrust that flow along links between hosts.

Rules decide the urls they fit.  For the others, hosts are judged by the link graph: trust flows
from hosts with allowed pages along links, distrust flows from hosts with blocked pages against
the links (a host that points to blocked hosts earns it).  Both are personalised PageRanks.  A
host is blocked when its distrust exceeds its trust and its own share of the pages by a factor.
JVM functions only.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from genopile.functions.once import with_once
from genopile.llm.common import table, whole
from genopile.storage import materialize

# Fixed rules: verdict, and host and path as one text.
RULES = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Links with a host, with or without a scheme.
LINK = r"(?i)\b(?:href|src|action)\s*=\s*[\"']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^\s\"'<>]*)"


@dataclass(frozen=True)
class Flow:
    damping: float = 0.85
    # Mass that may still move when the ranks are taken, of the seeds' 1: 86 rounds at most.
    tolerance: float = 1e-6
    # Blocked where distrust > factor * (trust + share of the pages).
    factor: float = 2.0


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A to Z lower-cased."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as ``struct(verdict, rule)``; null where none does."""
    best = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        one = F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))
        best = F.when(fits, one).otherwise(best)
    return best


def targets_of(html: Column) -> Column:
    """Distinct hosts that a page's links name, of pages, images, scripts and forms."""
    found = F.regexp_extract_all(html, F.lit(LINK), F.lit(1))
    return F.array_distinct(F.transform(found, lambda x: host_of(F.concat(F.lit(":"), x))))


def _ranked(edges: DataFrame, seeds: DataFrame, options: Flow, name: str) -> DataFrame:
    """``host``, ``rank``: PageRank that restarts at the seeds (``host``, ``mass``; sum 1).

    ``edges`` has ``from``, ``to``, ``share`` (summing to 1 over ``from``).  Mass of hosts without
    edges goes back to the seeds, so ranks are in proportion to the sum of what the seeds' mass
    brings a host after one link, two links and so on.  A round moves what arrived last by one more
    link; the rounds end where no edge leads on, or where less than ``tolerance`` of the seeds'
    mass still moves.
    """
    moving = seeds.select("host", F.col("mass").alias("rank"))
    parts = [moving]
    while True:
        sent = edges.join(moving.select(F.col("host").alias("from"), "rank"), "from")
        sent = sent.groupBy(F.col("to").alias("host")).agg((options.damping * F.sum(F.col("rank") * F.col("share"))).alias("rank"))
        moving = materialize(sent, f"{name}-sent")
        left = moving.agg(F.sum("rank")).first()[0] or 0.0
        parts.append(moving)
        if left <= options.tolerance:
            break
        if len(parts) == 16:
            parts = [materialize(_summed(parts), f"{name}-rank")]
    rank = materialize(_summed(parts), f"{name}-rank")
    total = rank.agg(F.sum("rank")).first()[0] or 1.0
    return rank.select("host", (F.col("rank") / F.lit(total)).alias("rank"))


def _summed(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts).groupBy("host").agg(F.sum("rank").alias("rank"))


def judge(
    pages: DataFrame,
    url: str = "url",
    html: str = "html",
    keep: list[str] | None = None,
    rules=RULES,
    options: Flow = Flow(),
) -> DataFrame:
    """One row per page: ``page`` (a struct of the columns ``keep``, all by default) and ``filter``
    (``host``, ``path``, ``rule``, ``verdict``, ``trust``, ``distrust``).

    A null url, or one without ``://``, has an empty host and path; no rule fits it and it is
    allowed.  Null html has no links.  Links count once per page and target host; links inside
    a host and relative ones say nothing about other hosts.  Repeated rows count as pages each;
    an empty table gives an empty result; extra columns ride along inside ``page``.

    Pages are stored without their html.  Links are summed per pair of hosts before any join, so
    a hot host costs one row per neighbour.  Ranks are stored every round.
    """
    kept_columns = pages.select(*(f"`{c}`" for c in keep)) if keep else pages
    u, h = F.col(f"`{url}`"), F.coalesce(F.col(f"`{html}`"), F.lit(""))
    parsed = with_once(
        pages.select(whole(kept_columns, "page"), u.alias("_url"), h.alias("_html")),
        {"host": host_of(F.col("_url")), "path": path_of(F.col("_url"))},
    )
    stored = materialize(
        parsed.select(
            "page",
            "host",
            "path",
            rule_of(F.col("host"), F.col("path"), rules).alias("rule"),
            targets_of(F.col("_html")).alias("targets"),
        ),
        "page-hosts",
    )
    known = stored.filter("host <> ''")
    counts = materialize(
        known.groupBy("host").agg(
            F.count(F.lit(1)).alias("pages"),
            F.count_if(F.col("rule.verdict") == "allow").alias("allowed"),
            F.count_if(F.col("rule.verdict") == "block").alias("blocked"),
        ),
        "host-pages",
    )
    links = (
        known.filter(F.size("targets") > 0)
        .select(F.col("host").alias("from"), F.explode("targets").alias("to"))
        .filter("to <> '' and to <> `from`")
        .groupBy("from", "to")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    links = materialize(links, "host-links")
    sums = counts.agg(F.sum("pages"), F.sum("allowed"), F.sum("blocked")).first()
    total, allowed, blocked = (float(x or 0) for x in sums)

    def flow(one: str, other: str, column: str, mass: float, name: str) -> DataFrame:
        out = links.groupBy(F.col(one).alias("from")).agg(F.sum("n").alias("all"))
        edges = links.select(F.col(one).alias("from"), F.col(other).alias("to"), "n").join(out, "from")
        edges = materialize(
            edges.select("from", "to", (F.col("n") / F.col("all")).alias("share")), f"{name}-edges"
        )
        seeds = counts.filter(F.col(column) > 0).select(
            "host", (F.col(column) / F.lit(max(mass, 1.0))).alias("mass")
        )
        return _ranked(edges, seeds, options, name)

    trust = flow("from", "to", "allowed", allowed, "trust")
    distrust = flow("to", "from", "blocked", blocked, "distrust")
    zero = F.lit(0.0)
    hosts = (
        counts.join(trust.select("host", F.col("rank").alias("trust")), "host", "left")
        .join(distrust.select("host", F.col("rank").alias("distrust")), "host", "left")
        .select(
            "host",
            F.coalesce("trust", zero).alias("trust"),
            F.coalesce("distrust", zero).alias("distrust"),
            (F.col("pages") / F.lit(max(total, 1.0))).alias("share"),
        )
    )
    bad = F.col("distrust") > options.factor * (F.col("trust") + F.col("share"))
    hosts = materialize(hosts.withColumn("bad", bad), "host-verdicts")
    by_host = F.when(F.coalesce("bad", F.lit(False)), "block").otherwise("allow")
    return stored.join(hosts, "host", "left").select(
        "page",
        F.struct(
            "host",
            "path",
            F.col("rule.rule").alias("rule"),
            F.coalesce("rule.verdict", by_host).alias("verdict"),
            "trust",
            "distrust",
        ).alias("filter"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(table(spark, sf_dir, "pages"), keep=["page_id"])
    return judged.select(
        "page.page_id", "filter.host", "filter.path", "filter.rule", "filter.verdict"
    )
