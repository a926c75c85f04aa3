"""Command line: ``python -m tarnflow.pipeline.cli harvest|process|combine ...``."""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from tarnflow.functions.sequence import mate_of_path, sample_of_path
from tarnflow.pipeline.process import process_study
from tarnflow.pipeline.runner import Phases, combine, harvest
from tarnflow.session import build_session
from tarnflow.sources import formats, sinks, texts


def share(value: str) -> float:
    x = float(value)
    if not 0 <= x <= 1:
        raise argparse.ArgumentTypeError(f"{value} isn't between 0 and 1")
    return x


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tarnflow")
    sub = top.add_subparsers(dest="command", required=True)
    one = sub.add_parser("harvest", help="metadata of projects")
    for name in ("ids", "runs", "samples", "out"):
        one.add_argument(f"--{name}", required=True)
    two = sub.add_parser("process", help="reads to feature tables")
    two.add_argument("--reads", required=True)
    two.add_argument("--runs", required=True, help="CSV with the columns dataset_id, sample_id and platform")
    two.add_argument("--out", required=True)
    three = sub.add_parser("combine", help="merge data sets and classify")
    for name in ("tables", "references", "out"):
        three.add_argument(f"--{name}", required=True)
    three.add_argument("--confidence", type=share, default=0.7)
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session()
    phases = Phases(spark, f"{args.out}/stages")
    if args.command == "harvest":
        samples = texts.biosample_blocks(spark.read.text(args.samples, wholetext=True)).select(F.col("biosample").alias("BioSample"), "title", "organism")
        table, states = harvest(phases, texts.id_lists(spark, args.ids), texts.run_info(spark, args.runs), samples)
        sinks.merged_csv(table, f"{args.out}/all_metadata_merged")
        sinks.status_tsv(states, f"{args.out}/status")
    elif args.command == "process":
        runs = texts.metadata_csv(spark, args.runs).select("dataset_id", "sample_id", "platform")
        reads = formats.read_fastq(spark, args.reads).withColumns({"sample_id": sample_of_path(F.col("file")), "mate": mate_of_path(F.col("file"))})
        named = reads.join(runs.select("dataset_id", "sample_id").distinct(), "sample_id")
        out = process_study(phases, named, runs.groupBy("dataset_id").agg(F.min("platform").alias("platform")))
        out["table"].write.mode("overwrite").partitionBy("dataset_id").parquet(f"{args.out}/tables")
        sinks.status_tsv(out["outcomes"], f"{args.out}/outcomes")
        summary = out["summary"].select(F.col("dataset_id").alias("bioproject"), F.col("sample_id").alias("run"), F.col("sample_id").alias("sample"), "raw_reads", "final_reads")
        sinks.append_summary(summary, f"{args.out}/summary")
    else:
        references = spark.read.parquet(args.references)
        for name, table in combine(phases, spark.read.parquet(args.tables), references, confidence=args.confidence).items():
            table.write.mode("overwrite").parquet(f"{args.out}/{name}")


if __name__ == "__main__":
    main()
