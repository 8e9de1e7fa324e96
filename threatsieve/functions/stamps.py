"""Date stamps and the stable province code."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from threatsieve.functions import constants as C

DAY = "yyyyMMdd"
SECOND = "yyyyMMddHHmmss"
READABLE = "yyyy-MM-dd HH:mm:ss"


def run_time(now: datetime | None = None) -> Column:
    """The run's time as one constant column: given, or the session's current time."""
    if now is None:
        return F.current_timestamp()
    return F.lit(now.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def stamp(time: Column, pattern: str) -> Column:
    return F.date_format(time, pattern)


def province(url: Column) -> Column:
    """One of the 31 codes, picked by a hash of the URL: the same on every retry."""
    codes = F.array(*[F.lit(code) for code in C.PROVINCE_CODES])
    bucket = F.conv(F.substring(F.md5(url), 1, 8), 16, 10).cast("bigint") % len(C.PROVINCE_CODES)
    return F.element_at(codes, (bucket + 1).cast("int"))
