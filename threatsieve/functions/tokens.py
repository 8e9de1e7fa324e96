"""Token text of a URL: the input of the naive Bayes model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATORS = ".=&?-@:("
DIGITS = "0123456789"


def token_word(raw: Column) -> Column:
    """Drop the web schemes, turn separators into slashes and delete digits; slashes may repeat."""
    bare = F.replace(F.replace(raw, F.lit("http://"), F.lit("")), F.lit("https://"), F.lit(""))
    return F.translate(bare, SEPARATORS + DIGITS, "/" * len(SEPARATORS))  # what has no counterpart is deleted


def token_text(df: DataFrame, column: str = "url", keep: Sequence[str] = ()) -> DataFrame:
    """The token rows ``Url``, ``Word``; ``Url`` stays raw and no row is dropped."""
    return df.select(*keep, F.col(column).alias("Url"), token_word(F.col(column)).alias("Word"))
