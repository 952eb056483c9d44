"""Command line for a run from read pairs to a result table.

    spark-submit … -m genopile --reads 's3a://…/*.avro' --reference ref.fa --output out
"""

from __future__ import annotations

import argparse
import re

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from genopile.config import Cutoffs, PileupOptions
from genopile.operators.align import MAX_INSERT, MAX_MISMATCH
from genopile.plans.modes import Run, run, run_in_segments
from genopile.session import session
from genopile.sources import tables
from genopile.sources.reads import fastq_to_pairs
from genopile.storage import materialize


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="genopile", description=__doc__.splitlines()[0])
    p.add_argument("--reads", default="", help="read pair tables, comma-separated, wildcards allowed")
    p.add_argument("--alignments", help="alignments instead of reads, comma-separated, wildcards allowed")
    p.add_argument("--alignment-format", default="sam", choices=["sam", "parquet"])
    p.add_argument("--manifest", help="samples and SAM files instead of reads")
    p.add_argument("--fastq", action="append", metavar="SAMPLE=FILE1[,FILE2]", help="only write read pair tables")
    p.add_argument("--read-format", default="avro", choices=["avro", "parquet", "json"], help="avro needs the spark-avro package and is not covered by the tests")
    p.add_argument("--reference", help="FASTA file")
    p.add_argument("--output", required=True)
    p.add_argument("--name", default="variants")
    p.add_argument("--partitions", type=int)
    p.add_argument("--save-alignments", action="store_true")
    p.add_argument("--index", action="store_true", help="also write the bin index of the alignments")
    p.add_argument("--align-only", action="store_true")
    p.add_argument("--segments", type=int, help="call in so many segments; a repeated run goes on where one stopped")
    p.add_argument("--hets", action="store_true")
    p.add_argument("--indels", action="store_true")
    p.add_argument("--vcf", action="store_true")
    p.add_argument("--positions", help="position list; genotypes these positions only")
    p.add_argument("--region", help="CHROM, CHROM:FROM- or CHROM:FROM-TO")
    p.add_argument("--seed-length", type=int, default=20)
    p.add_argument("--seed-stride", type=int, default=10)
    p.add_argument("--max-insert", type=int, default=MAX_INSERT, help="largest span of a proper pair")
    p.add_argument("--max-mismatch", type=float, default=MAX_MISMATCH, help="largest share of unlike bases")
    for owner in (Cutoffs(), PileupOptions()):
        for key, value in vars(owner).items():
            flag = "--" + key.replace("_", "-")
            if isinstance(value, bool):
                p.add_argument(flag, action="store_true")
            else:
                p.add_argument(flag, type=float if isinstance(value, float) else int, default=value)
    return p


def parse_region(text: str) -> tuple[str, int, int]:
    """``CHROM``, ``CHROM:FROM-`` or ``CHROM:FROM-TO``; open ends reach to the contig's ends."""
    match = re.fullmatch(r"(.+?)(?::([\d,]*)-([\d,]*))?", text)
    chrom, lo, hi = match.groups()
    number = lambda x, default: int(x.replace(",", "")) if x else default
    return chrom, number(lo, 1), number(hi, 2**31 - 1)


def convert(spark: SparkSession, items: list[str], output: str) -> None:
    """FASTQ files to one table of read pairs per sample, named for it."""
    files = {name: paths.split(",") for name, _, paths in (item.partition("=") for item in items)}
    second = {name: paths[1] for name, paths in files.items() if len(paths) > 1}
    pairs = fastq_to_pairs(spark, {name: paths[0] for name, paths in files.items()}, second)
    pairs = materialize(pairs, "pairs")
    for name in files:
        pairs.filter(F.col("sample") == name).drop("sample").write.parquet(f"{output}/{name}.parquet")


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = session(args.name)
    if args.fastq:
        convert(spark, args.fastq, args.output)
        return
    if not args.reference or not (args.reads or args.alignments or args.manifest):
        raise SystemExit("--reference and one of --reads, --alignments, --manifest are needed")
    job = Run(
        alignments=args.alignments,
        alignment_format=args.alignment_format,
        manifest=args.manifest,
        paths=args.reads,
        reference=args.reference,
        output=args.output,
        name=args.name,
        read_format=args.read_format,
        partitions=args.partitions,
        save_alignments=args.save_alignments,
        index=args.index,
        stop_after_alignment=args.align_only,
        hets=args.hets,
        indels=args.indels,
        vcf=args.vcf,
        positions=tables.positions(spark, args.positions) if args.positions else None,
        region=parse_region(args.region) if args.region else None,
        cutoffs=Cutoffs(**{k: getattr(args, k) for k in vars(Cutoffs())}),
        options=PileupOptions(**{k: getattr(args, k) for k in vars(PileupOptions())}),
        seed_length=args.seed_length,
        seed_stride=args.seed_stride,
        max_insert=args.max_insert,
        max_mismatch=args.max_mismatch,
    )
    if args.segments:
        run_in_segments(spark, job, args.segments)
    else:
        run(spark, job)


if __name__ == "__main__":
    main()
