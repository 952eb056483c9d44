"""Genotype matrix and VCF text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genopile.schemas import VCF_FIELDS


def write_matrix(matrix: DataFrame, path: str) -> None:
    """Tab-separated lines; the header is a file of its own that sorts before the records."""
    head = matrix.sparkSession.createDataFrame([("\t".join(matrix.columns),)], "value string")
    head.coalesce(1).write.text(f"{path}/header")
    matrix.write.csv(f"{path}/records", sep="\t")


def write_vcf(rows: DataFrame, path: str) -> None:
    """VCF lines; the header is a file of its own that sorts before the records."""
    samples = [c for c in rows.columns if c not in VCF_FIELDS]
    head = [
        "##fileformat=VCFv4.2",
        '##INFO=<ID=DP,Number=1,Type=Integer,Description="Depth over all samples">',
        '##INFO=<ID=AF,Number=A,Type=Float,Description="Frequency of each alternate over all samples">',
        '##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">',
        '##FORMAT=<ID=PL,Number=G,Type=Integer,Description="Phred-scaled genotype likelihoods">',
        '##FORMAT=<ID=DP,Number=1,Type=Integer,Description="Depth">',
        "#" + "\t".join([*VCF_FIELDS, *samples]),
    ]
    spark = rows.sparkSession
    spark.createDataFrame([("\n".join(head),)], "value string").coalesce(1).write.text(f"{path}/header")
    text = F.concat_ws("\t", *(F.col(f"`{c}`").cast("string") for c in rows.columns))
    rows.select(text.alias("value")).write.text(f"{path}/records")
