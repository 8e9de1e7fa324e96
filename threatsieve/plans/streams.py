"""The stateful streaming queries over the shared tables: written as files in the order of their days, read as streams."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threatsieve.functions.stamps import DAY, stamp
from threatsieve.operators import daily as batch
from threatsieve.operators import filters
from threatsieve.plans import fixtures as fx
from threatsieve.session import shared_folder
from threatsieve.streaming import daily, unique

PARTS = 3


def _put_in_order(rows: DataFrame, folder: str) -> int:
    """Write rows with a ``day`` in ``PARTS`` steps, whole days each and later days later; gives the most files of a step."""
    first, last = rows.select(F.to_date(F.min("day"), DAY), F.to_date(F.max("day"), DAY)).first()
    days = (last - first).days + 1 if first else 0
    files = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    number = F.date_diff(F.to_date("day", DAY), F.lit(first))
    for part in range(PARTS):
        some = rows.where((number >= days * part // PARTS) & (number < days * (part + 1) // PARTS))
        some.repartition(files).write.mode("append").json(folder)
    return files


def stream_daily_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage counts per hour, the batches of the fixture, as a stream; the totals per day that its stateful query keeps."""
    folder = f"{shared_folder(spark)}/daily-{uuid.uuid4().hex}"
    verdicts = fx.verdicts(fx.hits(spark, sf_dir)).withColumn("kept", filters.is_download(F.col("bayes_url")))
    batches = batch.batch_stats(verdicts).persist()
    try:
        files = _put_in_order(batches, f"{folder}/in")
        stream = spark.readStream.schema(batches.schema).option("maxFilesPerTrigger", files).json(f"{folder}/in")
    finally:
        batches.unpersist()
    query = daily.daily_query(stream, f"{folder}/daily", f"{folder}/checkpoint")
    query.awaitTermination()
    totals = daily.read_daily(spark, f"{folder}/daily")
    return totals.withColumn("output_count", F.col("output_count").cast("string"))


def stream_unique_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result lines as a stream; the URLs of each day that its stateful query passes on."""
    folder = f"{shared_folder(spark)}/unique-{uuid.uuid4().hex}"
    hits = fx.hits(spark, sf_dir)
    lines = hits.select(F.concat("url", F.lit("|0.58|0.9")).alias("value"), stamp(F.col("ts"), DAY).alias("day"))
    lines = lines.persist()
    try:
        files = _put_in_order(lines, f"{folder}/in")
        stream = spark.readStream.schema(lines.schema).option("maxFilesPerTrigger", files).json(f"{folder}/in")
    finally:
        lines.unpersist()
    query = unique.unique_query(stream, f"{folder}/unique", f"{folder}/checkpoint")
    query.awaitTermination()
    found = unique.read_unique(spark, f"{folder}/unique")
    return found.select("day", F.substring_index("value", "|", 1).alias("url"))
