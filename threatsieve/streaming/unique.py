"""Unique result lines of a day across its batches.

Within a batch every URL is written once; the same URL comes back in other batches of the day. This query reads the result lines as a stream
and passes on the first line of each URL and day. It keeps the day's URLs as keyed state, which
is dropped when a day later by ``late`` has been seen. Lines of a half batch and those of its second run are the same, so one passes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from threatsieve.sources.lines import LINE_SCHEMA
from threatsieve.streaming.state import day_start, folder_part, keep_state_on_disk

# A day is closed when the second day after it is seen.
LATE = "36 hours"


def stream_results(spark: SparkSession, directory: str, max_files: int | None = None) -> DataFrame:
    """Result lines of all batches below ``directory/yyyyMMdd/batch=...`` as a stream, with their ``day``."""
    reader = spark.readStream.schema(LINE_SCHEMA).option("recursiveFileLookup", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(directory).select("value", folder_part("/([0-9]{8})/batch=").alias("day"))


def unique_lines(lines: DataFrame, late: str = LATE) -> DataFrame:
    """The first line of every URL (first field) and ``day`` of a stream of ``value, day``."""
    rows = lines.withColumn("url", F.substring_index("value", "|", 1))
    rows = rows.withColumn("day_start", day_start(F.col("day"))).withWatermark("day_start", late)
    return rows.dropDuplicatesWithinWatermark(["day", "url"]).select("value", "day")


def unique_query(
    lines: DataFrame, target: str, checkpoint: str, seconds: int | None = None, late: str = LATE
) -> StreamingQuery:
    """Write the unique lines below ``target/day=...``; ``seconds=None`` works off what is there and stops."""
    keep_state_on_disk(lines.sparkSession)
    writer = unique_lines(lines, late).writeStream.format("text").partitionBy("day")
    writer = writer.option("path", target).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if seconds is None else {"processingTime": f"{seconds} seconds"}
    return writer.trigger(**trigger).start()


def read_unique(spark: SparkSession, target: str, day: str | None = None) -> DataFrame:
    """The unique lines (``value, day``) of whole batches; through the folder itself, whose log names their files."""
    lines = spark.read.schema(f"{LINE_SCHEMA}, day STRING").text(target)
    return lines.where(F.col("day") == day) if day else lines
