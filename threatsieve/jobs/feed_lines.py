"""Feed text lines to Kafka, at once or file by file, or look at what a topic carries."""

from __future__ import annotations

import argparse

from threatsieve.session import build_session
from threatsieve.sources.lines import kafka_lines, kafka_options, read_lines, stream_lines
from threatsieve.streaming.scorer import probe_query, publish_lines, publish_options, replay_query


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("action", choices=("publish", "replay", "probe"))
    parser.add_argument("--master")
    parser.add_argument("--servers", required=True)
    parser.add_argument("--topic", required=True)
    parser.add_argument("--lines", help="file or directory to publish or replay")
    parser.add_argument("--checkpoint", help="checkpoint of a replay")
    parser.add_argument("--files", type=int, default=1, help="files per batch of a replay")
    parser.add_argument("--seconds", type=int, default=5, help="batch interval")
    parser.add_argument("--group")
    parser.add_argument("--start", choices=("latest", "earliest"), default="latest")
    parser.add_argument("--url-index", type=int, default=0)
    args = parser.parse_args()
    spark = build_session("feed_lines", args.master)
    target = publish_options(args.servers, args.topic)
    if args.action == "publish":
        publish_lines(read_lines(spark, args.lines), target)
    elif args.action == "replay":
        lines = stream_lines(spark, args.lines, args.files)
        replay_query(lines, target, args.checkpoint, args.seconds).awaitTermination()
    else:
        options = kafka_options(args.servers, args.topic, args.group, args.start)
        probe_query(kafka_lines(spark, options), args.url_index, 10, args.seconds).awaitTermination()


if __name__ == "__main__":
    main()
