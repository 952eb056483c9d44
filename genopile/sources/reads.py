"""Read pairs from stored tables and FASTQ."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genopile.schemas import READ_PAIR
from genopile.sources.lines import as_patterns, found_files, numbered_lines, plain_path, read_lines, sample_name


def read_pairs(spark: SparkSession, paths: str | list[str], fmt: str = "avro") -> DataFrame:
    """Read pairs of many samples in one scan; the sample is the file's base name.

    ``paths`` is a list or a comma-separated text and may hold wildcards.  Missing fields
    read as the empty text.
    """
    listed = paths.split(",") if isinstance(paths, str) else paths
    table = spark.read.schema(READ_PAIR).format(fmt).load(listed)
    fields = (F.coalesce(F.col(f.name), F.lit("")).alias(f.name) for f in READ_PAIR.fields)
    return table.select(sample_name(F.col("_metadata.file_path")).alias("sample"), *fields)


def fastq_to_pairs(
    spark: SparkSession, read1: dict[str, str], read2: dict[str, str] | None = None
) -> DataFrame:
    """Read pairs from FASTQ ``{sample: path}``, plain or gzipped, one or two mates.

    Mates meet by record number; both files of a sample go into one grouping, so there is
    one shuffle.  A record is four lines; a pair whose names differ (after a ``/1``, ``/2``
    or ``_1``, ``_2`` suffix) fails the job.  All files are read together, twice, as their lines are
    counted first and not stored; sample and mate follow from the path.
    """
    named = []
    for mate, files in ((1, read1), (2, read2 or {})):
        for sample, path in files.items():
            found = found_files(spark, path)
            if not found:
                raise FileNotFoundError(path)
            named += [(sample, mate, file) for file in found]
    names = spark.createDataFrame(named, "sample string, mate int, file string")
    names = names.select("sample", "mate", plain_path(F.col("file")).alias("path"))
    lines = read_lines(spark, as_patterns([file for _, _, file in named]))
    numbered = numbered_lines(lines, names, ["sample", "mate"])
    record, role = F.floor(F.col("line") / 4), F.col("line") % 4

    def part(mate: int, r: int):
        return F.max(F.when((F.col("mate") == mate) & (F.col("role") == r), F.col("value")))

    pairs = numbered.select("sample", "mate", record.alias("record"), role.alias("role"), "value")
    whole = pairs.filter(F.col("role") != 2).groupBy("sample", "record").agg(
        part(1, 0).alias("h1"),
        part(1, 1).alias("seq1"),
        part(1, 3).alias("qual1"),
        part(2, 0).alias("h2"),
        part(2, 1).alias("seq2"),
        part(2, 3).alias("qual2"),
    )

    def name(col: str):
        return F.regexp_replace(F.regexp_extract(col, r"^@?(\S+)", 1), r"[/_][12]$", "")

    same = F.col("h2").isNull() | (name("h1") == name("h2"))
    checked = F.when(same, name("h1")).otherwise(
        F.raise_error(F.concat(F.lit("FASTQ mates differ: "), F.coalesce("h1", F.lit("")), F.lit(" / "), F.coalesce("h2", F.lit(""))))
    )
    empty = F.lit("")
    return whole.select(
        "sample",
        checked.alias("header"),
        *(F.coalesce(F.col(c), empty).alias(c) for c in ("seq1", "qual1", "seq2", "qual2")),
    )
