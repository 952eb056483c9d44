"""Quality rules with host verdicts: rule failures summed by host, shrunk, joined back.

A document fails when it has too few words or repeats itself too much.  Failures are summed by
host, a beta prior is fitted to all hosts by moments, and every host whose shrunken failure rate
reaches a threshold is rejected with all its documents.  JVM functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from genopile.functions.once import with_once
from genopile.llm.common import BLANK, table, whole, words
from genopile.storage import materialize

# Fixed values of the rules.
SYMBOLS = "#*$%&|<>"
WINDOW = 8


@dataclass(frozen=True)
class HostRules:
    min_words: int = 20
    max_repeat_percent: int = 30
    # Hosts whose shrunken failure rate reaches this are rejected.
    reject_rate: float = 0.5
    # Bounds of the prior's weight in documents, for hosts that are all alike or all different.
    min_weight: float = 1.0
    max_weight: float = 1e6


def _repeated_words(hashes: Column) -> Column:
    """Positions covered by windows whose hash occurs twice or more (hashes by position)."""
    placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    step = F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("sum"))

    def covered(at: Column) -> Column:
        return F.aggregate(
            at,
            step,
            lambda a, p: F.struct(
                (p + WINDOW).alias("end"),
                (a["sum"] + WINDOW - F.greatest(F.lit(0), a["end"] - p)).alias("sum"),
            ),
            lambda a: a["sum"],
        )

    def twice(s: Column) -> Column:
        same = F.filter(
            s,
            lambda x, k: ((k > 0) & (F.get(s, k - 1)["h"] == x["h"]))
            | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False)),
        )
        return F.array_sort(F.transform(same, lambda x: x["i"]))

    # An array of one value binds the sorted array once for the inner lambdas.
    bound = F.transform(F.array(placed), lambda s: covered(twice(s)))
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), bound[0]).otherwise(
        F.lit(0).cast("bigint")
    )


def features(docs: DataFrame, text: Column, carried: dict[str, Column]) -> DataFrame:
    """``carried`` columns and a struct ``rule`` with the counts of every row."""
    text = F.coalesce(text, F.lit(""))
    split = with_once(docs.select(*(c.alias(n) for n, c in carried.items()), text.alias("_text")), {"_words": words(F.col("_text"))})
    hashes = F.when(
        F.size("_words") >= WINDOW,
        F.transform(
            F.sequence(F.lit(1), F.size("_words") - (WINDOW - 1)),
            lambda i: F.xxhash64(F.slice(F.col("_words"), i, WINDOW)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    hashed = with_once(split, {"_hashes": hashes})
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rule = F.struct(
        F.size("_words").cast("bigint").alias("n_words"),
        F.length(F.regexp_replace("_text", BLANK, "")).cast("bigint").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", SYMBOLS, "")))
        .cast("bigint")
        .alias("n_symbols"),
        F.transform(F.array(lines), lambda x: F.size(x) - F.size(F.array_distinct(x)))[0]
        .cast("bigint")
        .alias("n_dup_lines"),
        _repeated_words(F.col("_hashes")).alias("n_repeat_words"),
    )
    return with_once(hashed, {"rule": rule}).select(*carried, "rule")


def beta_prior(hosts: DataFrame, options: HostRules) -> tuple[float, float]:
    """Prior counts of failures and passes from ``n`` and ``failures`` of all hosts.

    The mean is the overall rate.  The weight follows from the spread of host rates beyond what
    their sizes explain.  Two numbers from one aggregate; nothing else comes to the driver.
    """
    rate = F.col("failures") / F.col("n")
    row = hosts.agg(
        F.sum("failures").alias("f"),
        F.sum("n").alias("n"),
        F.count(F.lit(1)).alias("k"),
        F.sum(F.col("n") * rate * rate).alias("sq"),
        F.sum(F.col("n") * F.col("n")).alias("nn"),
    ).first()
    if not row["k"]:
        return 0.5, 0.5
    total = float(row["n"])
    mean = row["f"] / total
    noise = mean * (1 - mean)
    inside = noise * (row["k"] - 1)
    seen = float(row["sq"]) - total * mean * mean
    spread = (seen - inside) / max(1e-9, total - row["nn"] / total)
    weight = noise / spread - 1 if spread > 0 else options.max_weight
    weight = min(max(weight, options.min_weight), options.max_weight)
    return max(mean * weight, 1e-6), max((1 - mean) * weight, 1e-6)


def judge(
    docs: DataFrame,
    text: str = "text",
    host: str = "source",
    keep: list[str] | None = None,
    options: HostRules = HostRules(),
) -> DataFrame:
    """One row per input row: ``doc`` (a struct of the columns ``keep``, all by default) and
    ``quality`` (the counts, ``base_failed``, ``host_rate``, ``kept``).

    Null text counts as empty and fails.  Rows with a null host are judged by the rules alone.
    Repeated rows are judged, and counted for their host, each on its own; an empty table gives
    an empty result; extra columns ride along inside ``doc`` whatever their names.
    Window repeats are found by a 64-bit hash of the eight words.

    Counts are stored once in the shared folder, so the text is read once.  Rejected hosts are
    stored too: their measured size lets the planner choose a broadcast, and where they are many
    it shuffles and splits hot hosts.
    """
    kept_columns = docs.select(*(f"`{c}`" for c in keep)) if keep else docs
    carried = {"doc": whole(kept_columns), "host": F.col(f"`{host}`").cast("string")}
    counts = features(docs, F.col(f"`{text}`"), carried)
    failed = (F.col("rule.n_words") < options.min_words) | (
        100 * F.col("rule.n_repeat_words") > options.max_repeat_percent * F.col("rule.n_words")
    )
    rows = materialize(counts.withColumn("failed", failed), "rule-counts")
    hosts = materialize(
        rows.filter("host is not null")
        .groupBy("host")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if("failed").alias("failures")),
        "host-failures",
    )
    a, b = beta_prior(hosts, options)
    rate = (F.col("failures") + a) / (F.col("n") + (a + b))
    rejected = materialize(
        hosts.select("host", rate.alias("host_rate")).filter(
            F.col("host_rate") >= options.reject_rate
        ),
        "rejected-hosts",
    )
    quality = F.struct(
        "rule.*",
        F.col("failed").alias("base_failed"),
        F.col("host_rate"),
        (~F.col("failed") & F.col("host_rate").isNull()).alias("kept"),
    )
    return rows.join(rejected, "host", "left").select("doc", quality.alias("quality"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return judged.select(
        "doc.doc_id",
        *(
            f"quality.{c}"
            for c in (
                "n_words",
                "word_chars",
                "n_symbols",
                "n_dup_lines",
                "n_repeat_words",
                "base_failed",
                "kept",
            )
        ),
    )
