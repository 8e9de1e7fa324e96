"""Model fusion: URLs that both models flag.

The inner join of the two verdict sides repeats a URL (its GBDT rows) x (its naive Bayes rows)
times. Both sides are counted first and the repetition is kept as the number ``copies``, so the
result is whole and a heavily repeated URL costs one row. ``weights.unweigh`` writes it out.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threatsieve.functions import constants as C
from threatsieve.functions.url import with_default_scheme
from threatsieve.operators.filters import is_download
from threatsieve.operators.weights import COPIES, pair_count

CLASS_SUSPICIOUS = 0
OWN_COPIES = "own_copies"


def gbdt_probability() -> Column:
    """The fixed probability published for the tree model."""
    return F.lit(C.GBDT_PROBABILITY).cast("decimal(2,2)")


def flagged(df: DataFrame, prediction: str) -> DataFrame:
    """Rows put into the suspicious class."""
    return df.where(F.col(prediction) == CLASS_SUSPICIOUS)


def _whole(keys: Sequence[str]) -> Column:
    """Whether a row has all keys; the others meet nothing."""
    return reduce(lambda a, b: a & b, [F.col(key).isNotNull() for key in keys])


def _sides(gbdt: DataFrame, bayes: DataFrame, within: Sequence[str], url: Callable[[Column], Column]) -> DataFrame:
    """Both sides as one frame: ``url, _tree, prob_Bayes`` and the rows that each row stands for."""

    def rows(df: DataFrame) -> Column:
        return (F.col(COPIES) if COPIES in df.columns else F.lit(1)).cast("decimal(38,0)").alias("_n")

    tree, none = F.lit(True).alias("_tree"), F.lit(None).cast(bayes.schema["prob_Bayes"].dataType).alias("prob_Bayes")
    left = gbdt.select(*within, url(F.col("url_GBDT")).alias("url"), tree, none, rows(gbdt))
    right = bayes.select(*within, url(F.col("url_Bayes")).alias("url"), F.lit(False).alias("_tree"), "prob_Bayes", rows(bayes))
    return left.unionByName(right)


def fusion_join(gbdt: DataFrame, bayes: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """Join flagged ``url_GBDT`` rows with flagged ``url_Bayes, prob_Bayes`` rows.

    ``within`` names columns both sides share (a batch) and inside which they are joined. The tree
    side carries the URL with its default scheme and the Bayes side the raw one, so URLs written
    without a scheme do not meet themselves; ``fusion_normalized`` keeps them.

    Both sides are counted in one aggregate and meet in a window over the URL: two shuffles.
    """
    keys = [*within, "url"]
    counted = _sides(gbdt, bayes, within, lambda url: url).groupBy(*keys, "_tree", "prob_Bayes").agg(F.sum("_n").alias("_n"))
    trees = F.max(F.when(F.col("_tree"), F.col("_n"))).over(Window.partitionBy(*keys))
    met = counted.where(_whole(keys)).withColumn("_g", trees).where(~F.col("_tree") & F.col("_g").isNotNull())
    return met.select(
        *within, "url", gbdt_probability().alias("prob_GBDT"), "prob_Bayes",
        pair_count(F.col("_g"), F.col("_n")).alias(COPIES),
    )


def fusion_normalized(gbdt: DataFrame, bayes: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """The same join on the URL with its default scheme, every URL once; one shuffle."""
    keys = [*within, "url"]
    met = _sides(gbdt, bayes, within, with_default_scheme).where(_whole(keys)).groupBy(*keys).agg(
        F.bool_or("_tree").alias("_gbdt"), F.bool_and("_tree").alias("_only"), F.max("prob_Bayes").alias("prob_Bayes")
    )
    return met.where(F.col("_gbdt") & ~F.col("_only")).select(
        *within, "url", gbdt_probability().alias("prob_GBDT"), "prob_Bayes"
    )


def meeting_counts(df: DataFrame, *extra: Column, column: str = "url") -> DataFrame:
    """Distinct downloadable URLs with their default scheme, ready to be scored once each.

    ``copies`` counts the rows of a URL (its tree-side rows) and ``own_copies`` those written
    exactly so (its Bayes-side rows): all that the join of both sides needs. All other rows are
    counted in one row with a NULL URL and ``download`` false, which costs one row per task; a
    filter before the shuffle would work out a computed URL once for every suffix instead.
    ``extra`` are more aggregates per URL.
    """
    raw = F.col(column)
    kept = is_download(raw)
    return df.groupBy(F.when(kept, with_default_scheme(raw)).alias("url")).agg(
        F.count("*").alias(COPIES),
        F.count_if(F.contains(raw, F.lit("://"))).alias(OWN_COPIES),
        F.coalesce(F.bool_or(kept), F.lit(False)).alias("download"),
        *extra,
    )


def fused_copies(normalized: bool = False) -> Column:
    """How often the fusion has the URL of a ``score_both`` row; NULL for rows that are not fused."""
    both = F.col("gbdt_flag") & F.col("bayes_flag")
    if normalized:
        return F.when(both, F.lit(1).cast("decimal(38,0)"))
    return F.when(both & (F.col(OWN_COPIES) > 0), pair_count(F.col(COPIES), F.col(OWN_COPIES)))


def fuse_scored(scored: DataFrame, normalized: bool = False) -> DataFrame:
    """Fusion of ``meeting_counts`` rows that carry both verdicts: a filter instead of a join.

    Both models see the same features for a URL with and without its default scheme, so one row
    stands for both sides. ``normalized`` keeps URLs only written without a scheme, every URL once.
    """
    copies = fused_copies(normalized)
    return scored.where(copies.isNotNull()).select(
        "url", gbdt_probability().alias("prob_GBDT"), "prob_Bayes", copies.alias(COPIES)
    )
