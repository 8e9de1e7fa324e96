"""What the stateful queries share: their state store and the day of a row."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def keep_state_on_disk(spark: SparkSession) -> None:
    """State of queries started from now on is held by RocksDB: on disk, changes go to the checkpoint."""
    spark.conf.set(PROVIDER, ROCKSDB)


def day_start(day: Column) -> Column:
    """A day ``yyyyMMdd`` as the event time of its rows."""
    return F.to_timestamp(day, "yyyyMMdd")


def folder_part(pattern: str) -> Column:
    """A piece of the path of the file that a row was read from."""
    return F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)
