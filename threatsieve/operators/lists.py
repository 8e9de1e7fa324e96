"""White and black lists.

No broadcast is forced: a list may grow with the data. Spark broadcasts it when its measured size
is below ``spark.sql.autoBroadcastJoinThreshold`` and joins shuffled partitions otherwise. Both
sides are distinct by then, so no key is hot.

A list far larger than the URLs at hand would be shuffled whole for few hits. With ``prefilter`` its rows are first tested against a bitmap of the
URLs' hashes, of a fixed size, and only those that may be hits are shuffled and joined exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# A megabyte as bits; held as 64-bit words, a row each, by every task.
BITMAP_BITS = 1 << 23


def _place(column: str, bits: int) -> tuple[Column, Column]:
    """The word and the bit in it that stand for a URL."""
    place = F.pmod(F.xxhash64(column), F.lit(bits))
    return F.shiftright(place, 6).alias("_word"), place.bitwiseAND(63).cast("int").alias("_bit")


def url_bitmap(urls: DataFrame, column: str = "url", bits: int = BITMAP_BITS) -> DataFrame:
    """``_word, _bits``: the bitmap of the URLs' hashes, at most ``bits / 64`` rows."""
    placed = urls.where(F.col(column).isNotNull()).select(*_place(column, bits))
    return placed.groupBy("_word").agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_bits"))


def may_meet(listed: DataFrame, bitmap: DataFrame, column: str = "url", bits: int = BITMAP_BITS) -> DataFrame:
    """The rows of ``listed`` whose hash the bitmap has; of URLs that are not there, the share of set bits passes too."""
    placed = listed.select("*", *_place(column, bits))
    met = placed.join(F.broadcast(bitmap), "_word").where(F.getbit("_bits", F.col("_bit")) == 1)
    return met.select(*listed.columns)


def list_union(white: DataFrame, black: DataFrame) -> DataFrame:
    """Both lists in one."""
    return white.unionByName(black)


def exclude_listed(urls: DataFrame, listed: DataFrame, column: str = "url", prefilter: bool = False) -> DataFrame:
    """Rows whose URL is on no list, compared exactly; give it distinct (or weighted) URLs."""
    keys = listed.select(F.col("url").alias(column))
    if prefilter:
        keys = may_meet(keys, url_bitmap(urls, column), column)
    keys = keys.distinct()
    return urls.join(keys, column, "left_anti")


def flag_listed(urls: DataFrame, listed: DataFrame, column: str = "url", prefilter: bool = False) -> DataFrame:
    """Append ``listed``: whether the URL is on a list; no row is dropped."""
    keys = listed.select(F.col("url").alias(column))
    if prefilter:
        keys = may_meet(keys, url_bitmap(urls, column), column)
    keys = keys.distinct().withColumn("_on_list", F.lit(True))
    joined = urls.join(keys, column, "left_outer")
    return joined.select(
        *urls.columns, F.coalesce(F.col("_on_list"), F.lit(False)).alias("listed")
    )
