"""The streaming scorer: log lines in, dated result lines and stage counts out."""

from __future__ import annotations

import threading
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from threatsieve.functions.stamps import DAY
from threatsieve.functions.url import with_default_scheme
from threatsieve.operators.fusion import fuse_scored, fused_copies, meeting_counts
from threatsieve.operators.lists import flag_listed
from threatsieve.operators.scoring import Models, score_both
from threatsieve.operators.weights import COPIES, unweigh
from threatsieve.sinks.commits import commit, is_committed, manifests, only_committed
from threatsieve.sinks.text import drop_batch_text, write_batch_text
from threatsieve.sources.lines import field


METRICS_SCHEMA = (
    "day STRING, input_count BIGINT, bad_count BIGINT, suffix_count BIGINT, "
    "listed_count BIGINT, gbdt_count BIGINT, bayes_count BIGINT, output_count DECIMAL(38,0), "
    "verdict_count BIGINT"
)


@dataclass(frozen=True)
class Scorer:
    """What one streaming query does with its batches.

    Results go to ``output/yyyyMMdd/batch=<name>`` and stage counts to ``metrics/day=yyyyMMdd/batch=<name>``,
    both overwritten when a batch is run again. ``repeat`` writes a line as often as the join of
    both verdict sides has it; otherwise a batch has every URL once. ``bad_lines`` is where lines
    without a URL go; without it they are only counted. ``commits`` is where a manifest of every whole batch goes, written
    last; a batch that has one is not run again. ``large_whitelist`` tests a list that outgrows the batches against a
    bitmap of the batch's URLs before it is shuffled.
    """

    models: Models
    url_index: int
    output: str
    metrics: str
    whitelist: Callable[[SparkSession], DataFrame] | None = None
    normalized: bool = False
    repeat: bool = False
    bad_lines: str | None = None
    commits: str | None = None
    large_whitelist: bool = False

    def prepare(self, lines: DataFrame) -> DataFrame:
        """The stateless part: the URL and the batch's recorded time, which a replay repeats."""
        url = field(F.col("value"), self.url_index)
        value = ["value"] if self.bad_lines else []
        return lines.select(*value, url.alias("url"), F.current_timestamp().alias("batch_ts"))

    def distinct_urls(self, batch: DataFrame) -> DataFrame:
        """One row per downloadable URL and one, without URL, for all other lines."""
        bad = F.count_if(F.col("url").isNull() | (F.col("url") == "")).alias("bad")
        return meeting_counts(batch, bad, F.max("batch_ts").alias("batch_ts"))

    def stage_counts(self) -> list[Column]:
        """The number of lines (not of distinct URLs) after every stage, as aggregates over the scored rows."""

        def total(condition: Column | None = None) -> Column:
            copies = F.col(COPIES) if condition is None else F.when(condition, F.col(COPIES))
            return F.coalesce(F.sum(copies), F.lit(0))

        fused = F.when(~F.col("listed"), fused_copies(self.normalized))
        return [
            total().alias("input_count"),
            F.coalesce(F.sum("bad"), F.lit(0)).alias("bad_count"),
            total(F.col("download")).alias("suffix_count"),
            total(F.col("listed")).alias("listed_count"),
            total(F.col("gbdt_flag") & ~F.col("listed")).alias("gbdt_count"),
            total(F.col("bayes_flag") & ~F.col("listed")).alias("bayes_count"),
            F.coalesce(F.sum(fused), F.lit(0)).cast("decimal(38,0)").alias("output_count"),
            F.count(fused).alias("verdict_count"),
        ]

    def score(self, batch: DataFrame) -> DataFrame:
        """Every distinct URL of a batch, and one row for its other lines, with both verdicts."""
        urls = self.distinct_urls(batch)
        if self.whitelist is None:
            urls = urls.withColumn("listed", F.lit(False))
        else:
            listed = self.whitelist(batch.sparkSession).select(with_default_scheme(F.col("url")).alias("url"))
            urls = flag_listed(urls, listed, prefilter=self.large_whitelist)
        return score_both(urls, self.models)

    def write_results(self, scored: DataFrame, day: str, name: str) -> dict:
        """Write the fused lines; the counts come from the same pass over the scored rows.

        They are observed in the tasks that write, so a task that runs again is counted once. ``repeat`` deals the lines out
        anew after that, which may repeat tasks unseen; there the counts are a job of their own over the kept rows.
        """
        if self.repeat:
            scored = scored.persist(StorageLevel.MEMORY_AND_DISK)
            try:
                counts = scored.agg(*self.stage_counts()).first().asDict()
                fused = fuse_scored(scored.where(~F.col("listed")), self.normalized)
                write_batch_text(unweigh(fused), self.output, day, name)
            finally:
                scored.unpersist()
        else:
            seen = Observation()
            observed = scored.observe(seen, *self.stage_counts())
            fused = fuse_scored(observed.where(~F.col("listed")), self.normalized)
            write_batch_text(fused.drop(COPIES), self.output, day, name)
            counts = seen.get
        if not counts["output_count"]:
            drop_batch_text(scored.sparkSession, self.output, day, name)
        return counts

    def run_batch(self, batch: DataFrame, name: str) -> None:
        """Score one batch: shuffle once, score every distinct URL once, write what both flag, then commit."""
        spark = batch.sparkSession
        first = batch.select(F.date_format("batch_ts", DAY).alias("day")).first()  # the same in all rows
        if first is None or self.commits and is_committed(spark, self.commits, first.day, name):
            return
        day = first.day
        if self.bad_lines:  # they are written from the same read of the source
            batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            counts = self.write_results(self.score(batch), day, name)
            if self.bad_lines and counts["bad_count"] > 0:
                bad = batch.where("url IS NULL OR url = ''").select("value")
                write_batch_text(bad, self.bad_lines, day, name)
            elif self.bad_lines:
                drop_batch_text(spark, self.bad_lines, day, name)
        finally:
            if self.bad_lines:
                batch.unpersist()
        row = spark.createDataFrame([{"day": day, **counts}], METRICS_SCHEMA)
        metrics = f"{self.metrics}/day={day}/batch={name}"
        row.coalesce(1).write.mode("overwrite").json(metrics)
        if self.commits:
            commit(
                spark, self.commits, day, name, metrics=metrics,
                results=f"{self.output}/{day}/batch={name}" if counts["output_count"] else None,
                bad_lines=f"{self.bad_lines}/{day}/batch={name}" if self.bad_lines and counts["bad_count"] else None,
            )


def build_query(
    lines: DataFrame,
    scorer: Scorer,
    checkpoint: str,
    seconds: int | None = 5,
) -> StreamingQuery:
    """Start the scorer; ``seconds=None`` works off what is there and stops.

    Batches are named after the query's id, which stays with the checkpoint: a restart writes a
    batch over itself, and a query with a new checkpoint never over another one's.
    """
    started = threading.Event()
    ids: list[str] = []

    def run(batch: DataFrame, batch_id: int) -> None:
        started.wait()
        scorer.run_batch(batch, f"{ids[0]}-{batch_id}")

    writer = (
        scorer.prepare(lines)
        .writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
    )
    if seconds is None:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{seconds} seconds")
    query = writer.start()
    ids.append(str(query.id))
    started.set()
    return query


def read_metrics(spark: SparkSession, path: str, day: str | None = None, commits: str | None = None) -> DataFrame:
    """The stage counts of all batches, or of those of one day; with ``commits`` those of whole batches only."""
    folder = f"{path}/day={day}" if day else path
    found = spark.read.schema(METRICS_SCHEMA).option("recursiveFileLookup", True).json(folder)
    return only_committed(found, manifests(spark, commits, day), "metrics") if commits else found


def probe_query(lines: DataFrame, index: int, rows: int = 10, seconds: int = 5) -> StreamingQuery:
    """Print the URL field of the first rows of every batch to the console."""
    url = lines.select(field(F.col("value"), index).alias("url"))
    return (
        url.writeStream.format("console")
        .option("numRows", rows)
        .option("truncate", False)
        .trigger(processingTime=f"{seconds} seconds")
        .start()
    )


def publish_options(servers: str, topic: str) -> dict[str, str]:
    """Options of the Kafka line feeder: leader acknowledgement, one retry."""
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": "1",
        "kafka.retries": "1",
    }


def publish_lines(lines: DataFrame, options: dict[str, str]) -> None:
    """Send text lines to Kafka without keys; needs the Kafka connector on the class path."""
    lines.selectExpr("CAST(value AS STRING) AS value").write.format("kafka").options(**options).save()


def replay_query(
    lines: DataFrame, options: dict[str, str], checkpoint: str, seconds: int = 5
) -> StreamingQuery:
    """Send a stream of lines on to Kafka, paced by its source's files per batch."""
    return (
        lines.selectExpr("CAST(value AS STRING) AS value")
        .writeStream.format("kafka")
        .options(**options)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=f"{seconds} seconds")
        .start()
    )
