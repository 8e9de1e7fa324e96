"""Daily report: result lines of a day to one JSON file and a row of funnel counts."""

from __future__ import annotations

import argparse
import logging
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import SparkSession

from threatsieve.operators import report
from threatsieve.operators.lists import list_union
from threatsieve.session import build_session, session_now
from threatsieve.sinks.commits import committed_lines
from threatsieve.sinks.text import merge_small_files, write_report
from threatsieve.sources.lines import read_lines, read_url_list

log = logging.getLogger(__name__)


def run_report(
    spark: SparkSession,
    source: str,
    output: str,
    white: str,
    black: str,
    limit: int,
    now: datetime | None = None,
    name: str = "malicious_urls",
    merge_to: str | None = None,
    commits: str | None = None,
    day: str | None = None,
) -> tuple[str, dict[str, int]]:
    """Write the report and give its path and the funnel counts.

    The lines are read and joined to the lists once; counts and report share that result.
    ``merge_to`` first copies the day's small files into few there and reads those. With ``commits``, the manifests of a ``day``'s batches,
    ``source`` holds days and the lines of whole batches are read.
    """
    if commits and merge_to:
        raise ValueError("merged files are named by no manifest")
    now = now or session_now(spark)
    if merge_to:
        source_of_lines = f"{merge_to.rstrip('/')}/merge-{now:%Y%m%d%H%M%S}"
        merge_small_files(spark, source, source_of_lines)
    else:
        source_of_lines = source
    lines = committed_lines(spark, source, commits, day) if commits else read_lines(spark, source_of_lines)
    listed = list_union(read_url_list(spark, white), read_url_list(spark, black))
    flagged = report.flagged_urls(lines, listed)
    flagged = flagged.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        counts = report.funnel_counts(flagged).first().asDict()
        document = report.report_json(report.result_urls(flagged), limit, now)
        path = write_report(document, output, f"{now:%Y%m%d}", name)
    finally:
        flagged.unpersist()
    log.info("report %s: %s", path, counts)
    return path, counts


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--master")
    parser.add_argument("--input", required=True, help="day directory of result lines")
    parser.add_argument("--output", required=True)
    parser.add_argument("--white", required=True, help="text file, one URL per line")
    parser.add_argument("--black", required=True, help="text file, one URL per line")
    parser.add_argument("--limit", type=int, required=True, help="most URLs in the report")
    parser.add_argument("--timezone", default="UTC", help="the zone that days are counted in")
    parser.add_argument("--name", default="malicious_urls", help="file name after the day")
    parser.add_argument("--merge-to", help="directory for a merged copy of the input")
    parser.add_argument("--commits", help="manifests of the scorer: read whole batches only; --input is its output")
    parser.add_argument("--day", help="with --commits: the day to read, yyyyMMdd (all, if not given)")
    args = parser.parse_args()
    logging.basicConfig(level=logging.INFO)
    spark = build_session("daily_report", args.master, args.timezone)
    run_report(
        spark, args.input, args.output, args.white, args.black, args.limit,
        name=args.name, merge_to=args.merge_to, commits=args.commits, day=args.day,
    )
    spark.stop()


if __name__ == "__main__":
    main()
