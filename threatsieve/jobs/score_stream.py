"""Streaming scorer: log lines from Kafka or a directory to dated result lines."""

from __future__ import annotations

import argparse
from datetime import datetime
from functools import partial

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from threatsieve.operators.scoring import load_models
from threatsieve.session import build_session
from threatsieve.sinks.text import ensure_folder, path_exists
from threatsieve.sources.lines import kafka_lines, kafka_options, read_url_list, stream_lines
from threatsieve.sources.paced import paced_lines
from threatsieve.streaming.daily import daily_query, stream_metrics
from threatsieve.streaming.lifecycle import run_until
from threatsieve.streaming.scorer import Scorer, build_query
from threatsieve.streaming.unique import stream_results, unique_query


def start_followers(spark: SparkSession, args: argparse.Namespace, seconds: int | None) -> list[StreamingQuery]:
    """The stateful queries over what the scorer writes."""
    found = []
    if args.daily:
        ensure_folder(spark, args.metrics)
        found.append(daily_query(stream_metrics(spark, args.metrics), args.daily, f"{args.checkpoint}-daily", seconds))
    if args.unique:
        ensure_folder(spark, args.output)
        found.append(unique_query(stream_results(spark, args.output), args.unique, f"{args.checkpoint}-unique", seconds))
    return found


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--master")
    parser.add_argument("--seconds", type=int, default=5, help="batch interval")
    parser.add_argument("--servers", help="Kafka servers")
    parser.add_argument("--topic")
    parser.add_argument("--group")
    parser.add_argument("--start", choices=("latest", "earliest"), default="latest")
    parser.add_argument(
        "--rate", type=int, default=100_000,
        help="most records per Kafka partition and second (0: no ceiling)",
    )
    parser.add_argument(
        "--start-time", type=datetime.fromisoformat,
        help="with Kafka: begin a new checkpoint at this moment, with its zone (2024-05-01T00:00:00+08:00)",
    )
    parser.add_argument("--files", type=int, help="most files per batch of --lines")
    parser.add_argument("--bytes", type=int, help="most bytes per batch of --lines; larger files are split over batches")
    parser.add_argument("--timezone", default="UTC", help="the zone that days are counted in")
    parser.add_argument("--partitions", type=int, default=1, help="partitions of the topic")
    parser.add_argument("--lines", help="directory of text files instead of Kafka")
    parser.add_argument("--url-index", type=int, required=True)
    parser.add_argument("--gbdt-model", required=True)
    parser.add_argument("--bayes-model", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--metrics", required=True)
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--whitelist", help="text file, one URL per line, read again every batch")
    parser.add_argument("--large-whitelist", action="store_true", help="the whitelist is far larger than a batch")
    parser.add_argument("--bad-lines", help="directory for lines without a URL")
    parser.add_argument("--normalized", action="store_true", help="keep URLs without a scheme")
    parser.add_argument("--repeat", action="store_true", help="one line per joined row")
    parser.add_argument("--commits", help="directory for a manifest of every whole batch, written last")
    parser.add_argument("--daily", help="directory for the totals per day, kept while the stream runs")
    parser.add_argument("--unique", help="directory for the result lines that are new on their day")
    parser.add_argument("--stop-file", help="stop after the running batch once this file exists")
    parser.add_argument("--once", action="store_true", help="work off what is there and stop")
    args = parser.parse_args()
    if args.bytes and (args.files or args.once):
        parser.error("--bytes paces a running stream; it does not go with --files or --once")
    if bool(args.lines) == bool(args.servers and args.topic):
        parser.error("give either --lines or --servers and --topic")
    spark = build_session("score_stream", args.master, args.timezone)
    if args.lines and args.bytes:
        lines = paced_lines(spark, args.lines, args.bytes)
    elif args.lines:
        lines = stream_lines(spark, args.lines, args.files)
    else:
        options = kafka_options(
            args.servers, args.topic, args.group, args.start, args.rate, args.seconds, args.partitions, args.start_time
        )
        lines = kafka_lines(spark, options)
    whitelist = None
    if args.whitelist:
        whitelist = partial(read_url_list, path=args.whitelist)
    scorer = Scorer(
        models=load_models(args.gbdt_model, args.bayes_model),
        url_index=args.url_index,
        output=args.output,
        metrics=args.metrics,
        whitelist=whitelist,
        normalized=args.normalized,
        repeat=args.repeat,
        bad_lines=args.bad_lines,
        commits=args.commits,
        large_whitelist=args.large_whitelist,
    )
    seconds = None if args.once else args.seconds
    query = build_query(lines, scorer, args.checkpoint, seconds)
    if args.once:
        query.awaitTermination()
    followers = start_followers(spark, args, seconds)
    if args.once:
        for follower in followers:
            follower.awaitTermination()
        return
    run_until(spark, query, lambda: bool(args.stop_file) and path_exists(spark, args.stop_file))
    for follower in followers:
        follower.processAllAvailable()
        follower.stop()


if __name__ == "__main__":
    main()
