"""Command line: ``python -m threadtone run|report|clean`` (or through spark-submit)."""

from __future__ import annotations

import argparse
from dataclasses import replace

from threadtone.constants import (
    FOLDS,
    MIN_DOCUMENT_FREQUENCY,
    NEGATIVE_THRESHOLD,
    POSITIVE_THRESHOLD,
    REGULARISATION_GRID,
    SAMPLE_FRACTION,
    STATES,
    VOCABULARY_SIZE,
)
from threadtone.operators.classifier import TARGETS
from threadtone.plans.cleaning import clean_bodies
from threadtone.plans.reporting import report_tables, write_reports
from threadtone.plans.whole_job import run
from threadtone.session import build_session
from threadtone.sources.writers import write_table


def main() -> None:
    parser = argparse.ArgumentParser(prog="threadtone")
    commands = parser.add_subparsers(dest="command", required=True)
    job = commands.add_parser("run", help="train, score and publish")
    for name in ("--labeled", "--comments", "--submissions"):
        job.add_argument(name, required=True, nargs="+", help="paths or patterns")
    job.add_argument("--output", required=True)
    job.add_argument("--fraction", type=float, default=SAMPLE_FRACTION, help="of unseen comments")
    job.add_argument("--states", nargs="+", default=STATES, help="valid states")
    job.add_argument("--positive-threshold", type=float, default=POSITIVE_THRESHOLD)
    job.add_argument("--negative-threshold", type=float, default=NEGATIVE_THRESHOLD)
    job.add_argument("--vocabulary-size", type=int, default=VOCABULARY_SIZE)
    job.add_argument("--min-df", type=int, default=MIN_DOCUMENT_FREQUENCY)
    job.add_argument("--grid", type=float, nargs="+", default=REGULARISATION_GRID)
    job.add_argument("--folds", type=int, default=FOLDS)
    job.add_argument("--models", help="folder of stored models; skips training")
    job.add_argument("--seed", type=int, default=0)
    reports = commands.add_parser("report", help="report tables of published files")
    reports.add_argument("folder", help="the output folder of run")
    reports.add_argument("--output", required=True)
    reports.add_argument("--prefix", default="", help="of the target's files, as dem_")
    reports.add_argument("--missing", choices=("error", "null"), default="error")
    clean = commands.add_parser("clean", help="clean the bodies of a JSON-lines file")
    clean.add_argument("file")
    clean.add_argument("--output", required=True)
    args = parser.parse_args()

    spark = build_session()
    if args.command == "run":
        limits = {
            "positive_threshold": args.positive_threshold,
            "negative_threshold": args.negative_threshold,
        }
        run(
            spark,
            args.labeled,
            args.comments,
            args.submissions,
            args.output,
            targets=[replace(t, **limits) for t in TARGETS],
            states=args.states,
            fraction=args.fraction,
            seed=args.seed,
            model_folder=args.models,
            min_df=args.min_df,
            vocabulary_size=args.vocabulary_size,
            grid=args.grid,
            folds=args.folds,
        )
    elif args.command == "report":
        tables = report_tables(spark, args.folder, args.prefix, missing=args.missing)
        write_reports(tables, args.output, args.prefix)
    else:
        write_table(clean_bodies(spark, args.file, f"{args.output}.rejected"), args.output)
    spark.stop()


if __name__ == "__main__":
    main()
