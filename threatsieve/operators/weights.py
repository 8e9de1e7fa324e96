"""Weighted frames: one row per distinct URL with the number of rows it stands for.

Equal rows give equal features and equal scores, so they are counted before anything is
shuffled. A URL that makes up a third of the input is one row per task by then.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COPIES = "copies"


def pair_count(left: Column, right: Column) -> Column:
    """Product of two row counts; as a decimal, since a hot URL's square leaves the long range."""
    return left.cast("decimal(19,0)") * right.cast("decimal(19,0)")


def weigh(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct values of the columns with their row count as ``copies``; weighted rows count as often as they say."""
    count = F.sum(COPIES) if COPIES in df.columns else F.count("*")
    return df.groupBy(*columns).agg(count.alias(COPIES))


def weigh_where(df: DataFrame, condition: Column, column: str = "url") -> DataFrame:
    """``weigh`` of the rows that meet a condition, which may mention a computed column often.

    The condition is part of the counting, not a filter before it: pushed down, it would work out
    the column anew at every mention. The other rows shrink to one per task before the shuffle.
    """
    counted = df.groupBy(F.when(condition, F.col(column)).alias(column)).agg(
        F.count("*").alias(COPIES), F.bool_or(condition).alias("_met")
    )
    return counted.where("_met").drop("_met")


def once_per_row(df: DataFrame, column: str = "url") -> DataFrame:
    """Keep what is worked out from the column above the counting.

    A filter on the column alone, say on a model's verdict, would be pushed below the aggregate and
    run for every input row. Tied to ``copies`` it can only run on the counted rows.
    """
    return df.withColumn(column, F.when(F.col(COPIES) > 0, F.col(column)))


def repeated(df: DataFrame, times: str) -> DataFrame:
    """Every row as often as ``times`` says, in its place, without that column; for rows that were counted from so many."""
    rest = [F.col(f"`{c}`") for c in df.columns if c != times]
    thousand, zero = F.lit(1000).cast("bigint"), F.lit(0).cast("bigint")
    blocks = df.where(F.col(times) > 0).withColumn("_block", F.explode(F.sequence(zero, F.floor((F.col(times) - 1) / thousand))))
    size = F.least(thousand, F.col(times) - F.col("_block") * thousand)
    return blocks.select(*rest, F.explode(F.sequence(F.lit(1).cast("bigint"), size)).alias("_copy")).select(*rest)


def unweigh(df: DataFrame) -> DataFrame:
    """Every row as often as ``copies`` says, without that column.

    A row is first cut into about sqrt(copies) blocks of as many copies; these are redistributed
    before they are written out, so that no task repeats one row alone.
    """
    rest = [c for c in df.columns if c != COPIES]
    slots = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    copies, side, block = F.col(COPIES), F.col("_side"), F.col("_block")
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    blocks = df.where(copies > 0).withColumn(COPIES, copies.cast("bigint"))
    blocks = blocks.withColumn("_side", F.ceil(F.sqrt(copies)).cast("bigint"))
    blocks = blocks.withColumn("_block", F.explode(F.sequence(zero, F.floor((copies - 1) / side))))
    size = F.least(side, copies - block * side)
    return (
        blocks.select(*rest, size.alias("_size"))
        .repartition(slots)
        .select(*rest, F.explode(F.sequence(one, F.col("_size"))).alias("_copy"))
        .select(*rest)
    )
