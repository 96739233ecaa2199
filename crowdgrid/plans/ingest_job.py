"""Submit script of the streams.

    spark-submit --packages <kafka connector of the cluster's Spark> \
        crowdgrid/plans/ingest_job.py --bootstrap host:9092 --topic visits \
        --table /shared/visits --checkpoint /shared/checkpoints/visits --max-messages 5000000

``--mode cluster`` (default) clusters every micro-batch anew, ``fit`` fits a model on the
stored visits and saves it, ``score`` labels the stream with that model, and ``counts``
appends live hourly cell counts to the table. ``--max-messages`` bounds a micro-batch, the
first one over a backlog included; nothing is lost by it. A ``--connector`` gets each visit
once, by a commit log beside the checkpoint or in ``--commit-log``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from crowdgrid.operators.clean import visits_from_messages
from crowdgrid.operators.clusters import MAX_K, METHODS, SEED
from crowdgrid.session import builder
from crowdgrid.sources.kept import KEPT
from crowdgrid.sources.messages import kafka_options, read_messages
from crowdgrid.sources.tables import read_visits
from crowdgrid.streaming.ingest import (
    TRIGGER,
    ClusterBatch,
    StoreBatch,
    run_batches,
    save_model,
    score_stream,
)
from crowdgrid.streaming.live import live_counts, store_counts

MODES = ["cluster", "fit", "score", "counts"]


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--mode", choices=MODES, default=MODES[0])
    p.add_argument("--source", default="kafka", help="kafka, or text for line-delimited files")
    p.add_argument("--bootstrap")
    p.add_argument("--topic")
    p.add_argument("--path", help="folder of a file source")
    p.add_argument("--table", help="folder of the visit table")
    p.add_argument("--connector", help="append through this format instead of to files")
    p.add_argument("--option", action="append", default=[], help="key=value for the connector")
    p.add_argument("--commit-log", help="folder that keeps replays from storing visits twice")
    p.add_argument("--append-only", action="store_true", help="the connector cannot read back")
    p.add_argument(
        "--keep", nargs="*", choices=list(KEPT), default=list(KEPT), help="tables kept beside --table"
    )
    p.add_argument("--source-option", action="append", default=[], help="key=value for the source")
    p.add_argument("--model", help="folder of the saved model")
    p.add_argument("--max-messages", type=int, help="Kafka messages in one micro-batch at most")
    p.add_argument("--lateness", default="1 hour", help="how late a visit may be for live counts")
    p.add_argument("--checkpoint")
    p.add_argument("--interval", default=TRIGGER)
    p.add_argument("--max-k", type=int, default=MAX_K)
    p.add_argument("--method", choices=METHODS, default=METHODS[0])
    p.add_argument("--seed", type=int, default=SEED)
    p.add_argument("--substitute", nargs=2, metavar=("FROM", "TO"), help="alphabet before hashing")
    p.add_argument("--once", action="store_true", help="work through what is there and stop")
    args = p.parse_args(argv)
    streams = args.mode != "fit"
    if streams and args.source == "kafka" and not (args.bootstrap and args.topic):
        p.error("a kafka source needs --bootstrap and --topic")
    if streams and not args.checkpoint:
        p.error("a stream needs --checkpoint")
    if not args.table and (args.mode == "counts" or not args.connector):
        p.error("name a --table or, for visits, a --connector")
    if args.mode in ("fit", "score") and not args.model:
        p.error("name the --model")
    return args


def _pairs(items: list[str]) -> dict[str, str]:
    return dict(item.split("=", 1) for item in items)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = builder(f"visit-{args.mode}").getOrCreate()
    options = _pairs(args.option)
    choice = {"max_k": args.max_k, "method": args.method, "seed": args.seed}
    if args.mode == "fit":
        through = args.connector or "parquet"
        history = read_visits(spark, None if args.connector else args.table, None, through, options)
        save_model(history, args.model, **choice)
        return
    visits, keep = _visits(spark, args), tuple(args.keep)
    if args.mode == "counts":
        counts = live_counts(visits, lateness=args.lateness)
        query = store_counts(counts, args.table, args.checkpoint, args.once, args.interval)
    elif args.mode == "score":
        callback = StoreBatch(args.table, args.connector, options, _commit_log(args), keep)
        scored = score_stream(visits, args.model)
        query = run_batches(scored, callback, args.checkpoint, args.once, args.interval)
    else:
        callback = ClusterBatch(
            args.table, args.connector, options, _commit_log(args), keep, choice
        )
        query = run_batches(visits, callback, args.checkpoint, args.once, args.interval)
    query.awaitTermination()


def _commit_log(args: argparse.Namespace) -> str | None:
    if args.append_only:
        return None
    return args.commit_log or f"{args.checkpoint.rstrip('/')}-commits"


def _visits(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    options = _pairs(args.source_option)
    if args.source == "kafka":
        if args.max_messages:
            options["maxOffsetsPerTrigger"] = str(args.max_messages)
        options = kafka_options(args.bootstrap, args.topic, **options)
    messages = read_messages(spark, args.source, options, args.path)
    return visits_from_messages(messages, tuple(args.substitute) if args.substitute else None)


if __name__ == "__main__":
    main()
