"""From documents to packed token sequences, one operator a stage.

Every stage works on all rows that the one before kept; its result is written as Parquet and
read again.  All stages but the last return the columns of the documents they got.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genopile.llm import credentials, host_rules, mixing, packing, shingle_join
from genopile.llm.common import table
from genopile.llm.count_vectors import Jaccard
from genopile.storage import Tables, materialize, release

# Near copies of the corpus: five-word shingles, similarity from 0.8; op1's query has its own rule.
NEAR = shingle_join.Joining(words=5, rule=Jaccard(80, 100))

# SQL cannot express the join's components and the packing; tests hold both against plain code.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail no rule and whose host is not rejected."""
    return host_rules.judge(docs).filter("quality.kept").select("doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of linked ones: that of the smallest id.

    A row is known by its id and two hashes of its text, so that texts are not stored again to be
    numbered.  Rows alike in both are linked and one of them stays, whatever their other columns;
    texts without words are linked with nothing and all stay, null and empty ones among them.
    """
    name = "_row"
    while name in docs.columns:
        name += "_"
    row = F.struct("doc_id", F.xxhash64("text").alias("a"), F.xxhash64(F.lit(1), "text").alias("b"))
    named = docs.withColumn(name, row)
    groups = shingle_join.join(named, id=name, options=NEAR).groupBy(name).agg(
        F.max(F.col("component_id") != F.col(name)).alias("gone"),
        (F.count_if(F.col("n_shingles") > 0) > 1).alias("many"),
    )
    marks = materialize(groups.filter("gone or many"), "near-duplicates")
    left = shingle_join.without(named, marks, name, NEAR).select(*(f"`{c}`" for c in docs.columns))
    alike = materialize(marks.filter("many and not gone"), "rows-alike")
    if not alike.limit(1).count():
        return left
    once = named.join(alike, named[name].eqNullSafe(alike[name]), "left_semi").dropDuplicates([name])
    return left.unionByName(once.select(*(f"`{c}`" for c in docs.columns)))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every reported span replaced by its kind; ``n_chars`` follows."""
    scanned = credentials.scan(docs)
    clean = credentials.masked(F.col("doc.text"), F.col("secrets.spans"))
    hit = F.size("secrets.spans") > 0
    changed = {"text": clean}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(hit, F.length(clean).cast(kind)).otherwise(F.col("doc.n_chars"))
    return scanned.select(*(changed.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, those of rare sources repeated, in the order of the mixed blocks."""
    mixed = mixing.mix(docs)
    ordered = mixed.repartitionByRange("mix.block", "mix.place").sortWithinPartitions(
        "mix.block", "mix.place"
    )
    return ordered.select("doc.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document stands in which sequence."""
    return packing.pack(docs, packing.tokenizer_path())


def _stage(function):
    """A stage that first deletes what the session's last stage stored on its way.

    The result of a stage is written before the next one is called, so nothing reads it any more.
    """

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if _made:
            _made.pop().release()
        with Tables(spark) as made:
            _made.append(made)
            return function(spark, docs, sf_dir)

    return run_stage


_made: list[Tables] = []

STAGES = [
    ("quality rules", _stage(quality_rules)),
    ("near duplicates", _stage(near_duplicates)),
    ("secret scans", _stage(secret_scans)),
    ("source mixing", _stage(mix_sources)),
    ("packing", _stage(pack_sequences)),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, stored; tables between the stages are deleted."""
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if last is not None:
            release(last)
        last = docs
    _made.pop().release()
    return docs
