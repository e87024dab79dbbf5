"""Command line: send a CSV feed, parse a topic, find alerts, show the latest.

    python -m alertflow send    --csv feed.csv --servers host:9092 --topic tweets
    python -m alertflow parse   --servers host:9092 --topic tweets --out parsed --checkpoint ckpt/parse
    python -m alertflow alerts  --servers host:9092 --topic tweets --model model_dir --places places.txt \\
                                --types types.txt --out alerts --store store --checkpoint ckpt/alerts
    python -m alertflow latest  --store store --rows 10

``--files FOLDER`` in place of ``--servers``/``--topic`` reads and writes envelope files, and
``--once`` handles what is there and ends.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertflow.operators.extraction import DictionaryExtractor
from alertflow.operators.messages import encode_messages, parse_messages_explicit
from alertflow.operators.reports import latest_predictions
from alertflow.operators.scoring import LexiconScorer, model_scorer, transformer_model
from alertflow.plans.alerts import alert_rows, dead_letters, routed
from alertflow.session import open_session
from alertflow.sinks.topics import write_envelopes, write_kafka
from alertflow.sources import csv_feed, topics
from alertflow.sources.store import read_files
from alertflow.streaming import jobs

ENVELOPE = T.StructType([T.StructField("value", T.BinaryType()), T.StructField("timestamp", T.TimestampType())])


def words(path: str) -> tuple[str, ...]:
    """A word list file, one word per line; its size is checked where it is used."""
    with open(path, encoding="utf-8") as lines:
        return tuple(w.strip().lower() for w in lines if w.strip())


def parser() -> argparse.ArgumentParser:
    topic = argparse.ArgumentParser(add_help=False)
    topic.add_argument("--servers", help="comma-separated Kafka servers")
    topic.add_argument("--topic")
    topic.add_argument("--files", help="folder of envelope files in place of a topic")

    stream = argparse.ArgumentParser(add_help=False)
    stream.add_argument("--out", required=True, help="folder of JSON output")
    stream.add_argument("--checkpoint", required=True, help="folder for the progress of the queries")
    stream.add_argument("--starting-offsets")
    stream.add_argument("--max-per-trigger", type=int, help="messages, or files, per micro-batch")
    stream.add_argument("--console", action="store_true")
    stream.add_argument("--once", action="store_true")

    main = argparse.ArgumentParser(prog="alertflow")
    commands = main.add_subparsers(dest="command", required=True)
    send = commands.add_parser("send", parents=[topic])
    send.add_argument("--csv", required=True)
    commands.add_parser("parse", parents=[topic, stream])
    find = commands.add_parser("alerts", parents=[topic, stream])
    find.add_argument("--model", help="folder of a fine-tuned classifier")
    find.add_argument("--lexicon", help="word list, if there is no model")
    find.add_argument("--places", required=True, help="word list")
    find.add_argument("--types", required=True, help="word list")
    find.add_argument("--store", help="folder of stored predictions")
    find.add_argument("--dead-letters", help="folder of messages that could not be decoded or scored; default: OUT-dead-letters")
    find.add_argument("--quarantine", help="folder of rows that do not fit the store; default: STORE-quarantine")
    latest = commands.add_parser("latest")
    latest.add_argument("--store", required=True)
    latest.add_argument("--rows", type=int, default=10)
    return main


def source(spark: SparkSession, args: argparse.Namespace, starting_offsets: str) -> DataFrame:
    if args.files:
        return topics.stream_files(spark, args.files, ENVELOPE, "parquet", args.max_per_trigger)
    return topics.stream_kafka(
        spark,
        servers=args.servers,
        topic=args.topic,
        starting_offsets=args.starting_offsets or starting_offsets,
        max_offsets_per_trigger=args.max_per_trigger,
    )


def send(spark: SparkSession, args: argparse.Namespace) -> None:
    rows = csv_feed.read_csv(spark, args.csv)
    envelopes = encode_messages(rows, F.current_timestamp())
    if args.files:
        write_envelopes(envelopes, args.files)
    else:
        write_kafka(envelopes, args.servers, args.topic)


def parse(spark: SparkSession, args: argparse.Namespace) -> None:
    parsed = parse_messages_explicit(source(spark, args, "earliest"))
    every = None if args.once else jobs.FILE_TRIGGER
    queries = [jobs.start_files(parsed, args.out, args.checkpoint, every)]
    if args.console:
        queries.append(jobs.start_console(parsed, f"{args.checkpoint.rstrip('/')}-console", every))
    finish(queries, args.once)


def find(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.model:
        scorer = model_scorer(transformer_model(args.model))
    elif args.lexicon:
        scorer = LexiconScorer(words(args.lexicon))
    else:
        raise SystemExit("alerts needs --model or --lexicon")
    extractor = DictionaryExtractor(words(args.places), words(args.types))
    rows = routed(source(spark, args, "latest"), scorer, extractor)
    every = None if args.once else jobs.FILE_TRIGGER
    below = args.checkpoint.rstrip("/")
    dead = args.dead_letters or f"{args.out.rstrip('/')}-dead-letters"
    sinks = [
        lambda rows: jobs.start_files(alert_rows(rows), args.out, f"{below}/json", every),
        lambda rows: jobs.start_files(dead_letters(rows), dead, f"{below}/dead-letters", every),
    ]
    if args.console:
        sinks.append(lambda rows: jobs.start_console(alert_rows(rows), f"{below}/console", every))
    if args.store:
        bad = args.quarantine or f"{args.store.rstrip('/')}-quarantine"
        sinks.append(lambda rows: jobs.start_store(alert_rows(rows), args.store, f"{below}/store", every))
        sinks.append(lambda rows: jobs.start_quarantine(alert_rows(rows), bad, f"{below}/quarantine", every))
    shared = f"{below}/scored"

    def report() -> None:
        counts = jobs.running_totals(spark, shared).first().asDict()
        print("  ".join(f"{name.removeprefix('n_')} {n}" for name, n in counts.items()), flush=True)

    finish(jobs.start_routed(rows, shared, f"{below}/alerts", sinks, every), args.once, report)


def finish(queries: list, once: bool, report: Callable[[], None] | None = None) -> None:
    if once:
        for query in queries:
            jobs.wait(query)
        if report is not None:
            report()
    else:
        jobs.run_all(queries, report=report)


def latest(spark: SparkSession, args: argparse.Namespace) -> None:
    latest_predictions(read_files(spark, args.store), args.rows).show(args.rows, truncate=False)


COMMANDS = {"send": send, "parse": parse, "alerts": find, "latest": latest}


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    if args.command != "latest" and not (args.files or (args.servers and args.topic)):
        raise SystemExit("give --servers and --topic, or --files")
    spark = open_session("alertflow")
    COMMANDS[args.command](spark, args)


if __name__ == "__main__":
    main()
