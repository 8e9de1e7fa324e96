"""One commit per batch: a manifest, written last, names all files of the batch.

A batch writes results, bad lines and counts one after another. What died in between leaves some of them behind, and a later run of the
batch writes other files. Readers that go by the manifests see the files of whole batches only. A manifest is one file,
moved into place when it is complete.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threatsieve.sinks.text import path_exists
from threatsieve.sources.lines import LINE_SCHEMA, read_lines

KINDS = ("results", "bad_lines", "metrics")
MANIFEST_SCHEMA = "day STRING, batch STRING, results ARRAY<STRING>, bad_lines ARRAY<STRING>, metrics ARRAY<STRING>"


def file_names(spark: SparkSession, folder: str | None) -> list[str]:
    """The data files of one written folder: about one per task of its write."""
    return sorted(os.path.basename(path) for path in spark.read.text(folder).inputFiles()) if folder else []


def commit(spark: SparkSession, commits: str, day: str, batch: str, **folders: str | None) -> None:
    """Name the files of a batch, by kind; a kind without a folder has none."""
    row = (day, batch, *(file_names(spark, folders.get(kind)) for kind in KINDS))
    frame = spark.createDataFrame([row], MANIFEST_SCHEMA)
    frame.coalesce(1).write.mode("overwrite").json(f"{commits}/{day}/batch={batch}")


def manifests(spark: SparkSession, commits: str, day: str | None = None, batch: str | None = None) -> DataFrame:
    """The manifests of whole batches: all, those of a day, or one; none where nothing was committed yet."""
    folder = "/".join([commits, *([day] if day else []), *([f"batch={batch}"] if batch else [])])
    if not path_exists(spark, folder):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).option("recursiveFileLookup", True).json(folder)


def is_committed(spark: SparkSession, commits: str, day: str, batch: str) -> bool:
    return not manifests(spark, commits, day, batch).isEmpty()


def only_committed(files: DataFrame, commits: DataFrame, kind: str) -> DataFrame:
    """Rows of a file scan that stand in files which a manifest names; file names hold their writer's id and are unique.

    The names of a day are few; Spark broadcasts them by their size.
    """
    names = commits.select(F.explode(kind).alias("_name"))
    tagged = files.select("*", F.col("_metadata.file_name").alias("_file"))
    return tagged.join(names, F.col("_file") == F.col("_name"), "left_semi").drop("_file")


def committed_lines(
    spark: SparkSession, directory: str, commits: str, day: str | None = None, kind: str = "results"
) -> DataFrame:
    """The lines of whole batches below ``directory`` (``directory/day`` with a day)."""
    folder = f"{directory}/{day}" if day else directory
    if not path_exists(spark, folder):  # batches without results leave no folder
        return spark.createDataFrame([], LINE_SCHEMA)
    return only_committed(read_lines(spark, folder), manifests(spark, commits, day), kind)
