"""Text sinks: delimited lines in day directories, small-file merge and the report file."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threatsieve.operators.weights import COPIES
from threatsieve.sources.lines import LINE_SCHEMA, read_lines


def delimited(columns: Sequence[str], separator: str = "|", keep_positions: bool = False) -> Column:
    """All columns as one line; NULLs are skipped unless positions must hold."""
    parts = [F.col(f"`{c}`") for c in columns]
    if keep_positions:
        parts = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.concat_ws(separator, *parts)


def verdict_lines(df: DataFrame, separator: str = "|") -> DataFrame:
    """Verdict rows as lines ``url|prob_GBDT|prob_Bayes``."""
    line = delimited(["url", "prob_GBDT", "prob_Bayes"], separator).alias("line")
    return df.select(*[c for c in ("batch", COPIES) if c in df.columns], line)


def write_day_text(
    df: DataFrame, directory: str, day: str, separator: str = "|", mode: str = "append"
) -> None:
    """All columns as uncompressed lines under ``directory/yyyyMMdd``."""
    lines = df.select(delimited(df.columns, separator).alias("line"))
    lines.write.mode(mode).option("compression", "none").text(f"{directory}/{day}")


def write_batch_text(df: DataFrame, directory: str, day: str, batch: str, separator: str = "|") -> None:
    """One batch's lines in a directory of its own, so that writing it again adds nothing."""
    write_day_text(df, f"{directory}/{day}", f"batch={batch}", separator, "overwrite")


def path_exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def ensure_folder(spark: SparkSession, path: str) -> None:
    """Make a folder that a stream is to read before anything was written there; it is not taken for empty and dropped later."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_followed")
    place.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(place)


def drop_batch_text(spark: SparkSession, directory: str, day: str, batch: str) -> None:
    """Remove what was written for a batch, if anything, and the folders above that are empty then."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{directory}/{day}/batch={batch}")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(path, True)
    for above in (path.getParent(), path.getParent().getParent()):
        if files.exists(above) and not len(files.listStatus(above)):
            files.delete(above, False)


def merge_small_files(
    spark: SparkSession, source: str, target: str, files: int | None = None
) -> None:
    """Copy a directory's lines (sub-directories included) into few files elsewhere.

    Hidden files and those starting with ``_`` are not read, and sources stay where they are.
    Reading packs small files into partitions already; ``files`` lowers their number further.
    """
    lines = read_lines(spark, source)
    if files:
        lines = lines.coalesce(files)
    lines.write.mode("overwrite").option("compression", "none").text(target)


def new_files(spark: SparkSession, source: str, target: str) -> DataFrame:
    """``path, length`` of the files below ``source`` that no finished merge into ``target`` has taken; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source).select("path", "length")
    return files.join(_merged(spark, target), "path", "left_anti") if path_exists(spark, f"{target}/_merged") else files


def _merged(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.schema("path STRING, run STRING").parquet(f"{target}/_merged")


def merge_by_size(spark: SparkSession, source: str, target: str, file_bytes: int = 128 << 20) -> int:
    """Copy the lines of new files below ``source`` into files of half to all of ``file_bytes``; gives how many were new.

    Spark packs the files, and pieces of larger ones, into read tasks of up to that size, and each task writes one file: all
    tasks read at once and nothing is shuffled. Only the last file may be smaller. The files taken are listed last, per run;
    a run that died before that is neither read nor in the way, and another run takes its files again. The driver holds
    a path per new file, as for any scan.
    """
    new = new_files(spark, source, target).where("length > 0").persist()
    try:
        paths = [row.path for row in new.select("path").collect()]
        if not paths:
            return 0
        run = uuid.uuid4().hex
        packed = spark.newSession()
        for key, value in (("maxPartitionBytes", file_bytes), ("openCostInBytes", 0), ("minPartitionNum", 1)):
            packed.conf.set(f"spark.sql.files.{key}", str(value))
        packed.read.text(paths).write.option("compression", "none").text(f"{target}/run={run}")
        new.select("path").coalesce(1).write.parquet(f"{target}/_merged/run={run}")
    finally:
        new.unpersist()
    return len(paths)


def read_merged(spark: SparkSession, target: str) -> DataFrame:
    """The lines of all finished merges; a row per run passes the driver."""
    if not path_exists(spark, f"{target}/_merged"):
        return spark.createDataFrame([], LINE_SCHEMA)
    runs = [row.run for row in _merged(spark, target).select("run").distinct().collect()]
    return read_lines(spark, [f"{target}/run={run}" for run in runs])


def write_report(report: DataFrame, directory: str, day: str, name: str = "malicious_urls") -> str:
    """The one-row report as a single text file in ``directory/yyyyMMdd_name``; gives the path."""
    path = f"{directory.rstrip('/')}/{day}_{name}"
    report.coalesce(1).write.mode("overwrite").option("compression", "none").text(path)
    return path
