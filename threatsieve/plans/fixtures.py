"""Frames the registered queries start from, derived from the shared ``events`` and ``pages``."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threatsieve.functions.url import lexical_columns
from threatsieve.operators.weights import COPIES
from threatsieve.sources.lines import spread

URL_INDEX = 2
# Below the number of result URLs at every scale, so that the limit is part of every check.
REPORT_LIMIT = 100
# Pages are broadcast up to these sizes and joined by shuffling beyond.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 << 20
_MEASURED: dict[tuple[str, str], tuple[int, bool]] = {}
REPORT_TIME = datetime(2024, 2, 1, 6, 30, 0)


def _measure(pages: DataFrame, sf_dir: str) -> tuple[int, bool]:
    """Number of pages and whether they are small enough to broadcast; once per application."""
    key = (pages.sparkSession.sparkContext.applicationId, sf_dir)
    if key not in _MEASURED:
        count = pages.count()
        small = count <= BROADCAST_ROWS
        if small:
            url_bytes = pages.agg(F.sum(F.octet_length("url"))).first()[0] or 0
            small = url_bytes <= BROADCAST_BYTES
        _MEASURED[key] = (count, small)
    return _MEASURED[key]


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One URL hit per event; eight kinds of URL, one of them a heavy duplicate."""
    events = spread(spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts"))
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    page_count, small = _measure(pages, sf_dir)
    keyed = events.select("event_id", "ts", (F.col("event_id") % page_count).alias("page_id"))
    if small:
        pages = F.broadcast(pages)
    bare = "regexp_replace(url, '[?#].*$', '')"
    number = "CAST(event_id AS STRING)"
    url = f"""CASE event_id % 8
        WHEN 0 THEN concat({bare}, '/app_', {number}, '.apk')
        WHEN 1 THEN concat(regexp_replace({bare}, '^https?://', ''), '/setup-1.2.3.4.exe')
        WHEN 2 THEN url
        WHEN 3 THEN concat({bare}, '/free~movie', CAST(event_id % 50 AS STRING), 'x7.zip')
        WHEN 4 THEN concat('http://dl.example.cn:8080/下载', CAST(event_id % 97 AS STRING), '.apk')
        WHEN 5 THEN concat('http://10.0.0.', CAST(event_id % 256 AS STRING), '/a.sisx')
        WHEN 6 THEN 'http://bad:port/x.apk'
        ELSE 'https://dup.example.com/same.jar' END"""
    return keyed.join(pages, "page_id").select("event_id", "ts", F.expr(url).alias("url"))


def hit_lines(hits: DataFrame) -> DataFrame:
    """Raw log lines with the URL at index 2; every 101st line is short."""
    number = F.col("event_id").cast("string")
    short = F.concat(number, F.lit("|LTE"))
    full = F.concat(number, F.lit("|LTE|"), F.col("url"), F.lit("|200"))
    value = F.when(F.col("event_id") % 101 == 0, short).otherwise(full)
    return hits.select("event_id", value.alias("value"))


def result_lines(hits: DataFrame) -> DataFrame:
    """Result lines as the scorer writes them, one per hit."""
    return hits.select(F.concat("url", F.lit("|0.58|0.9")).alias("value"))


def white(hits: DataFrame) -> DataFrame:
    return hits.where("event_id % 40 = 0").select("url").distinct()


def black(hits: DataFrame) -> DataFrame:
    return hits.where("event_id % 36 = 4").select("url").distinct()


def labelled(hits: DataFrame) -> DataFrame:
    """Training rows, 0 = suspicious; 1 in 29 flipped as noise."""
    label = F.expr("CASE WHEN (event_id % 8 IN (0,4,5)) <> (event_id % 29 = 0) THEN 0 ELSE 1 END")
    return hits.select("event_id", "url", label.alias("label"))


def ruled(hits: DataFrame) -> DataFrame:
    """Training rows without noise: the label is a rule over lexical features, so verdicts can be stated.

    Weighted hits give weighted rows, each labelled once.
    """
    rule = "valid AND is_Prefix_sensitive AND (isIP OR port <> 80)"
    kept = [c for c in ("url", COPIES) if c in hits.columns]
    return lexical_columns(hits.select(kept)).select(*kept, F.expr(f"CASE WHEN {rule} THEN 0 ELSE 1 END").alias("label"))


def verdicts(hits: DataFrame) -> DataFrame:
    """Stand-in model outputs; the hour plays the micro-batch."""
    return hits.selectExpr(
        "ts",
        "date_format(ts, 'yyyyMMddHH') AS batch",
        "url AS bayes_url",
        "CASE WHEN instr(url, '://') > 0 THEN url ELSE concat('http://', url) END AS gbdt_url",
        "CASE WHEN event_id % 3 <> 0 AND event_id % 8 <> 6 THEN 0 ELSE 1 END AS gbdt_pred",
        "CASE WHEN event_id % 4 <> 1 OR event_id % 5 = 0 THEN 0 ELSE 1 END AS bayes_pred",
        "CAST(50 + event_id % 50 AS DOUBLE) / 100 AS bayes_prob",
    )
