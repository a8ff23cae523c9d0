"""Command line: analyse, score and export reviews."""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from .operators.models import fit_hashing, fit_vocab, load_model, save_model, score_or_reject
from .plans import analyse, export_reviews
from .sinks import write_metrics
from .sources import ingest_reviews_csv, read_reviews, scratch_path


LEARNERS = {"hashing": fit_hashing, "vocabulary": fit_vocab}


def _reviews(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.format == "csv":
        table = args.table or scratch_path(spark, "ingested")
        return ingest_reviews_csv(spark, args.reviews, table, multi_line=not args.single_line, split=args.split_files)
    return read_reviews(spark, args.reviews, args.format)


def _review_arguments(command: argparse.ArgumentParser) -> None:
    command.add_argument("--format", default="csv")
    command.add_argument("--single-line", action="store_true", help="no line breaks in quotes: large CSV files are split")
    command.add_argument("--split-files", action="store_true", help="read large files with line breaks in quotes in ranges")
    command.add_argument("--table", help="where to keep the table that CSV is converted to")


def _analyse(spark: SparkSession, args: argparse.Namespace) -> None:
    lexicon = spark.read.parquet(args.lexicon) if args.lexicon else None
    result = analyse(
        _reviews(spark, args), lexicon=lexicon, fit=LEARNERS[args.learner], stratified=args.split == "stratified"
    )
    run_id = datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S")
    result.publish(args.out, run_id)
    write_metrics(result.metrics, f"{args.out}/metrics_log", run_id)
    save_model(result.model, args.model or f"{args.out}/model")
    for table in (result.metrics, result.report, result.confusion_matrix):
        table.show(truncate=False)
    result.close()


def _score(spark: SparkSession, args: argparse.Namespace) -> None:
    requests = spark.read.format(args.format).load(args.requests)
    scored = score_or_reject(load_model(args.model), requests)
    scored.write.mode("overwrite").partitionBy("status").parquet(args.out)


def _export(spark: SparkSession, args: argparse.Namespace) -> None:
    options = dict(option.split("=", 1) for option in args.option)
    export_reviews(_reviews(spark, args), args.sink, options)


def main() -> None:
    parser = argparse.ArgumentParser(prog="sentiflow", description=__doc__)
    commands = parser.add_subparsers(required=True)

    command = commands.add_parser("analyse", help="train on reviews and publish the reports")
    command.add_argument("reviews")
    command.add_argument("out")
    _review_arguments(command)
    command.add_argument("--learner", choices=LEARNERS, default="hashing")
    command.add_argument("--split", choices=("hash", "stratified"), default="hash")
    command.add_argument("--lexicon", help="parquet table (form, lemma, pos)")
    command.add_argument("--model", help="where to save the model")
    command.set_defaults(run=_analyse)

    command = commands.add_parser("score", help="score a table with a text column")
    command.add_argument("requests")
    command.add_argument("model")
    command.add_argument("out")
    command.add_argument("--format", default="parquet")
    command.set_defaults(run=_score)

    command = commands.add_parser("export", help="write cleaned reviews to a document sink")
    command.add_argument("reviews")
    _review_arguments(command)
    command.add_argument("--sink", default="json")
    command.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")
    command.set_defaults(run=_export)

    args = parser.parse_args()
    args.run(SparkSession.builder.appName("sentiflow").getOrCreate(), args)


if __name__ == "__main__":
    main()
