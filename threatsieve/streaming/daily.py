"""Statistics by day while the stream runs.

The scorer's stage counts, one row per batch, are read as a stream and summed per day in a stateful query. A batch counts once, also if
it was run again and its counts were written twice. A day's state is dropped once no more of its rows are expected:
when a day later than it by ``late`` has been seen. Changed days are written over their old totals, so
a repeated update changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from threatsieve.operators.daily import STAGES
from threatsieve.streaming.scorer import METRICS_SCHEMA
from threatsieve.streaming.state import day_start, folder_part, keep_state_on_disk

# A day is closed when the second day after it is seen.
LATE = "36 hours"
DAILY_SCHEMA = (
    "input_count BIGINT, suffix_count BIGINT, gbdt_count BIGINT, bayes_count BIGINT, "
    "output_count DECIMAL(38,0), day STRING"
)


def stream_metrics(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The scorer's stage counts as a stream, with the name of their ``batch``."""
    reader = spark.readStream.schema(METRICS_SCHEMA).option("recursiveFileLookup", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path).select("*", folder_part("/batch=([^/]+)/").alias("batch"))


def daily_totals(metrics: DataFrame, late: str = LATE) -> DataFrame:
    """The stage counts per ``day`` of a stream of batches; the same sums as ``operators.daily.daily_stats``."""
    rows = metrics.withColumn("day_start", day_start(F.col("day"))).withWatermark("day_start", late)
    once = rows.dropDuplicatesWithinWatermark(["day", "batch"])
    totals = [F.sum(stage).alias(stage) for stage in STAGES[:-1]]
    output = F.sum(STAGES[-1]).cast("decimal(38,0)").alias(STAGES[-1])
    return once.groupBy("day_start", "day").agg(*totals, output)


def daily_query(
    metrics: DataFrame, table: str, checkpoint: str, seconds: int | None = None, late: str = LATE
) -> StreamingQuery:
    """Keep the totals per day in ``table``; ``seconds=None`` works off what is there and stops."""
    keep_state_on_disk(metrics.sparkSession)

    def put(days: DataFrame, _: int) -> None:
        shown = days.select(*STAGES, "day").coalesce(1)  # the days that changed: few
        shown.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(table)

    writer = daily_totals(metrics, late).writeStream.outputMode("update").foreachBatch(put)
    writer = writer.option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if seconds is None else {"processingTime": f"{seconds} seconds"}
    return writer.trigger(**trigger).start()


def read_daily(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.schema(DAILY_SCHEMA).parquet(table)
