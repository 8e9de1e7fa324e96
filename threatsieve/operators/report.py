"""The daily report: distinct URLs, funnel counts, capped rows and the JSON document."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threatsieve.functions import constants as C
from threatsieve.functions.stamps import READABLE, province, run_time, stamp
from threatsieve.functions.url import url_parts
from threatsieve.operators.filters import is_package
from threatsieve.operators.lists import flag_listed
from threatsieve.operators.weights import COPIES, once_per_row, weigh
from threatsieve.sources.lines import first_field


def dedup_urls(lines: DataFrame) -> DataFrame:
    """Distinct first fields of the result lines."""
    return first_field(lines).distinct()


def flagged_urls(lines: DataFrame, listed: DataFrame) -> DataFrame:
    """Distinct URLs with their line count and whether they are listed: the whole funnel's input."""
    return flag_listed(weigh(first_field(lines), "url"), listed)


def _in_result() -> Column:
    return ~F.col("listed") & is_package(F.col("url"))


def result_urls(flagged: DataFrame) -> DataFrame:
    """Distinct package URLs on no list, out of ``flagged_urls``."""
    return once_per_row(flagged).where(_in_result()).select("url")


def funnel_counts(flagged: DataFrame) -> DataFrame:
    """One row of counts over the whole funnel, in one pass over ``flagged_urls``.

    ``filtered_count`` is what the lists *and* the package filter take away together.
    """
    counts = flagged.agg(
        F.coalesce(F.sum(COPIES), F.lit(0)).alias("input_count"),
        F.count("*").alias("dedup_count"),
        F.count_if(_in_result()).alias("result_count"),
    )
    return counts.select(
        "input_count",
        (F.col("input_count") - F.col("dedup_count")).alias("duplicate_count"),
        "dedup_count",
        (F.col("dedup_count") - F.col("result_count")).alias("filtered_count"),
        "result_count",
    )


def report_rows(urls: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` parseable URLs in URL order; others do not use up the limit."""
    if limit < 1:
        raise ValueError("limit must be at least 1")
    return (
        url_parts(urls.select("url"), "url")
        .where("parses")
        .orderBy("url")
        .limit(limit)
        .select(
            province(F.col("url")).alias("area"),
            F.lit(C.REPORT_DEGREE).alias("degree"),
            F.col("host").alias("domain"),
            "url",
        )
    )


def report_json(urls: DataFrame, limit: int, now: datetime | None = None) -> DataFrame:
    """The report as one JSON object in column ``report``.

    ``size`` counts all result URLs up to the limit, so it may exceed the length of ``list`` when
    some do not parse. The list is bounded by ``limit``, which is the feature.
    """
    # Counting the column, not rows, keeps the shuffled side as the list needs it: it is reused.
    size = urls.agg(F.least(F.count("url"), F.lit(limit)).cast("int")).scalar()
    rows = report_rows(urls, limit).agg(
        F.array_sort(F.collect_list(F.struct("url", "area", "degree", "domain"))).alias("rows")
    )
    items = F.transform(
        "rows",
        lambda r: F.struct(
            r["area"].alias("area"), r["degree"].alias("degree"),
            r["domain"].alias("domain"), r["url"].alias("url"),
        ),
    )
    document = F.struct(
        stamp(run_time(now), READABLE).alias("date"), size.alias("size"), items.alias("list")
    )
    return rows.select(F.to_json(document).alias("report"))
