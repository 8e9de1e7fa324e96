"""Session settings the jobs are written for."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    name: str, master: str | None = None, timezone: str = "UTC", **settings: str
) -> SparkSession:
    """A session with the settings above; cluster-side settings stay with the submitter.

    ``timezone`` is the one clock of a job: days of results and of reports are days in it.
    """
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, "spark.sql.session.timeZone": timezone, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def session_now(spark: SparkSession) -> datetime:
    """The current time on the session's clock, without a zone."""
    shown = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")
    return datetime.fromisoformat(spark.range(1).select(shown).first()[0])


def shared_folder(spark: SparkSession) -> str:
    """Where all machines can read what a job keeps for itself: ``spark.checkpoint.dir``; on one machine also the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        folder = spark.conf.get("spark.sql.warehouse.dir")
    return f"{folder.rstrip('/')}/{spark.sparkContext.applicationId}"
