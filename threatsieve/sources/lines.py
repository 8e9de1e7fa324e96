"""Line sources: text files, Kafka, exclusion lists and labelled URLs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LINE_SCHEMA = "value STRING"
DELIMITER = r"\|"


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text files as lines (column ``value``); sub-directories are read too."""
    return spark.read.option("recursiveFileLookup", True).text(path)


def spread(df: DataFrame) -> DataFrame:
    """Redistribute a scan that has fewer splits than the session has task slots.

    That is the case for few small files and for compressed text, which cannot be split. A scan
    with enough splits is left alone.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= slots else df.repartition(slots)


def stream_lines(
    spark: SparkSession, path: str, max_files: int | None = None, max_bytes: str | None = None
) -> DataFrame:
    """A directory of text files as a stream of lines; a ceiling per batch paces a replay.

    ``max_files`` counts files, ``max_bytes`` (such as ``512m``) their sizes; Spark takes one of them. Files are not
    split over batches, so a batch may be one larger file; ``paced_lines`` splits them.
    """
    if max_files and max_bytes:
        raise ValueError("give max_files or max_bytes")
    reader = spark.readStream.schema(LINE_SCHEMA).option("recursiveFileLookup", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.text(path)


def kafka_options(
    servers: str,
    topic: str,
    group: str | None = None,
    start: str = "latest",
    rate_per_partition: int | None = None,
    seconds: int = 5,
    partitions: int = 1,
    start_time: datetime | None = None,
) -> dict[str, str]:
    """Options of the Kafka source.

    ``start`` counts only for a new checkpoint; afterwards the checkpoint's offsets do. So does ``start_time``, a moment with
    a zone: each partition begins with its first record from then on, or at its end if there is none. The rate
    limit is stated per partition and second and becomes one ceiling per batch.
    """
    if start not in ("latest", "earliest"):
        raise ValueError(f"start must be latest or earliest, not {start!r}")
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    if start_time is None:
        options["startingOffsets"] = start
    elif start_time.tzinfo is None:
        raise ValueError("start_time needs a zone")
    else:
        options["startingTimestamp"] = str(round(start_time.timestamp() * 1000))
        options["startingOffsetsByTimestampStrategy"] = "latest"
    if group:
        options["kafka.group.id"] = group
    if rate_per_partition:
        options["maxOffsetsPerTrigger"] = str(rate_per_partition * seconds * partitions)
    return options


def kafka_lines(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Kafka records as lines; needs the Kafka connector on the class path."""
    stream = spark.readStream.format("kafka").options(**options).load()
    return stream.select(F.col("value").cast("string").alias("value"))


def read_url_list(spark: SparkSession, path: str) -> DataFrame:
    """An exclusion list: one URL per line."""
    return spark.read.text(path).select(F.col("value").alias("url"))


def read_labelled(spark: SparkSession, path: str, label: int) -> DataFrame:
    """The ``url`` column of a Parquet set with one label for all its rows."""
    return spark.read.parquet(path).select("url", F.lit(label).alias("label"))


def field(value: Column, index: int) -> Column:
    """Field ``index`` of a ``|`` line, NULL when the line is too short.

    Only the first ``index + 1`` fields are cut off, so long lines are not split to the end.
    """
    return F.get(F.split(value, DELIMITER, index + 2), index)


def extract_field(df: DataFrame, index: int, name: str = "url") -> DataFrame:
    """Append the field as ``name``; short lines and empty fields are left out."""
    return df.withColumn(name, field(F.col("value"), index)).where(F.col(name) != "")


def bad_records(df: DataFrame, index: int) -> DataFrame:
    """The lines ``extract_field`` leaves out."""
    found = field(F.col("value"), index)
    return df.where(found.isNull() | (found == ""))


def first_field(df: DataFrame) -> DataFrame:
    """The first field of every result line as ``url``."""
    return df.select(F.substring_index("value", "|", 1).alias("url"))


def labelled_union(white: DataFrame, black: DataFrame) -> DataFrame:
    """Both labelled sets in one frame."""
    return white.unionByName(black)
