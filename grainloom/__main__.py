"""Command line of the stages: ``python -m grainloom STAGE ...``."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from grainloom.plans import stages
from grainloom.sources import jsonl


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="grainloom", description="Stages of the data pipeline; the session comes from spark-submit or the defaults.")
    add = top.add_subparsers(dest="stage", required=True).add_parser
    p = add("organize", help="a folder of record files to pools, pairs and reports")
    p.add_argument("folder"), p.add_argument("output"), p.add_argument("--raw-files", nargs="*", default=[])
    p = add("repair", help="repair, deduplicate and audit a file of records")
    p.add_argument("source"), p.add_argument("output"), p.add_argument("--audit", type=int, choices=(1, 2), default=1), p.add_argument("--flagged"), p.add_argument("--flag-filter", nargs="*")
    p = add("exclude", help="leave out records whose problem is in another file")
    p.add_argument("--large", required=True), p.add_argument("--small", required=True), p.add_argument("--output", required=True)
    p = add("format", help="records as texts of the training template")
    p.add_argument("source"), p.add_argument("output")
    p = add("scrape-pairs", help="scraped pages to training pairs")
    p.add_argument("source"), p.add_argument("output"), p.add_argument("--glob"), p.add_argument("--distinct", action="store_true"), p.add_argument("--least", type=int)
    p = add("tex-pairs", help="TeX files to training pairs")
    p.add_argument("folder"), p.add_argument("output"), p.add_argument("--with-source", action="store_true")
    return top


def run(spark: SparkSession, args: argparse.Namespace) -> dict[str, int]:
    if args.stage == "organize":
        return stages.organize(spark, args.folder, args.output, raw_files=args.raw_files)
    if args.stage == "repair":
        return stages.repair(spark, args.source, args.output, version=args.audit, flagged_to=args.flagged, flag_filter=args.flag_filter)
    if args.stage == "exclude":
        return stages.exclude(spark, args.large, args.small, args.output)
    if args.stage == "format":
        return stages.format_records(spark, args.source, args.output)
    if args.stage == "scrape-pairs":
        pages = jsonl.read_pages(spark, args.source, args.glob)
        made = stages.scrape_training_distinct(pages, order="ord", least=args.least or 150) if args.distinct else stages.scrape_training(pages, least=args.least or 200)
        rows, n = stages.counted(made.select("messages"))
    else:
        rows, n = stages.counted(stages.tex_training(jsonl.read_tex(spark, args.folder), with_source=args.with_source).drop("block"))
    jsonl.write_jsonl(rows, args.output)
    return {"written": n.get["n"]}


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    print(json.dumps(run(SparkSession.builder.appName("grainloom").getOrCreate(), args)))


if __name__ == "__main__":
    main()
