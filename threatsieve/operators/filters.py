"""Suffix filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threatsieve.functions import constants as C
from threatsieve.functions.url import ends_with_any


_DOWNLOAD = rf"(?:{'|'.join(C.DOWNLOAD_SUFFIXES)})\z"
_LONGEST = max(map(len, C.DOWNLOAD_SUFFIXES))


def is_download(url: Column) -> Column:
    """Download-like URL: case-sensitive, no dot asked for, on the raw URL.

    One pattern, so that a URL which is itself worked out is worked out once; only the end is looked at, as a
    pattern would be tried at every place of the URL.
    """
    return F.substring(url, -_LONGEST, _LONGEST).rlike(_DOWNLOAD)


def download_suffix(df: DataFrame, column: str = "url", stored: bool = False) -> DataFrame:
    """Rows with a download-like URL; ``stored`` says that the column is read as it is.

    Only then is the test written as 13 comparisons, which file sources can take over.
    """
    url = F.col(column)
    return df.where(ends_with_any(url, C.DOWNLOAD_SUFFIXES) if stored else is_download(url))


def is_package(url: Column) -> Column:
    return url.endswith(".apk")


def package_suffix(df: DataFrame, column: str = "url") -> DataFrame:
    return df.where(is_package(F.col(column)))
