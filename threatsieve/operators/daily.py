"""Per-day statistics of the scoring funnel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threatsieve.functions.stamps import DAY, stamp
from threatsieve.operators.weights import pair_count

STAGES = ("input_count", "suffix_count", "gbdt_count", "bayes_count", "output_count")


def url_stats(verdicts: DataFrame) -> DataFrame:
    """Rows per day, batch and URL after every stage, from rows with both predictions.

    Needs ``ts, batch, kept, gbdt_url, bayes_url, gbdt_pred, bayes_pred``. The fused count of a
    batch and URL is (tree rows) x (Bayes rows), so it is counted first and summed per day after;
    a Bayes row whose URL has no scheme meets no tree row.
    """
    gbdt = F.col("kept") & (F.col("gbdt_pred") == 0)
    bayes = F.col("kept") & (F.col("bayes_pred") == 0)
    return verdicts.groupBy(stamp(F.col("ts"), DAY).alias("day"), "batch", "gbdt_url").agg(
        F.count("*").alias("input_count"),
        F.count_if("kept").alias("suffix_count"),
        F.count_if(gbdt).alias("gbdt_count"),
        F.count_if(bayes).alias("bayes_count"),
        pair_count(
            F.count_if(gbdt), F.count_if(bayes & (F.col("gbdt_url") == F.col("bayes_url")))
        ).alias("output_count"),
    )


def verdict_stats(verdicts: DataFrame) -> DataFrame:
    """Rows per day after every stage; takes what ``url_stats`` does."""
    return daily_stats(url_stats(verdicts))


def batch_stats(verdicts: DataFrame) -> DataFrame:
    """Rows per day and batch after every stage; takes what ``url_stats`` does."""
    return url_stats(verdicts).groupBy("day", "batch").agg(*[F.sum(stage).alias(stage) for stage in STAGES])


def daily_stats(metrics: DataFrame) -> DataFrame:
    """Sum of the stage counts per ``day``, for example of the stream's metrics rows."""
    return metrics.groupBy("day").agg(*[F.sum(stage).alias(stage) for stage in STAGES])
