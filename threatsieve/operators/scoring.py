"""Scoring with the two model pipelines."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threatsieve.functions.tokens import token_text, token_word
from threatsieve.functions.url import LEXICAL_FEATURES, lexical_columns, lexical_features
from threatsieve.operators import token_bayes
from threatsieve.operators.fusion import (
    CLASS_SUSPICIOUS,
    flagged,
    fuse_scored,
    gbdt_probability,
    meeting_counts,
)
from threatsieve.operators.token_bayes import TokenBayes
from threatsieve.operators.training import load_bayes, load_model
from threatsieve.operators.weights import COPIES, once_per_row, repeated
from threatsieve.sources.lines import field


@dataclass(frozen=True)
class Models:
    """The two fitted models: the trees as a pipeline, naive Bayes as tables or as a pipeline."""

    gbdt: PipelineModel
    bayes: PipelineModel | TokenBayes


def load_models(gbdt_path: str, bayes_path: str) -> Models:
    return Models(load_model(gbdt_path), load_bayes(bayes_path))


def first_probability(vector: Column) -> Column:
    """Probability of class 0 out of an ML vector."""
    return F.get(vector_to_array(vector), 0)


def bayes_transform(rows: DataFrame, model: PipelineModel | TokenBayes) -> DataFrame:
    """``predictions`` and ``prob_Bayes`` instead of the token text in ``Word``, of distinct rows."""
    kept = [c for c in rows.columns if c != "Word"]
    if isinstance(model, TokenBayes):
        scored = token_bayes.with_verdicts(rows, model, F.col("Word"), kept)
        probability = F.get("myProbability", 0)
    else:
        scored = model.transform(rows.withColumn("Word", F.coalesce("Word", F.lit(""))))
        probability = first_probability(F.col("myProbability"))
    return scored.select(*kept, "predictions", probability.alias("prob_Bayes"))


def gbdt_verdicts(urls: DataFrame, model: PipelineModel) -> DataFrame:
    """``url_GBDT, prob_GBDT, copies`` of the weighted URLs the tree model flags."""
    rows = lexical_features(once_per_row(urls), keep=[COPIES])
    return flagged(model.transform(rows), "predictions").select(
        F.col("Url").alias("url_GBDT"), gbdt_probability().alias("prob_GBDT"), COPIES
    )


def bayes_verdicts(urls: DataFrame, model: PipelineModel) -> DataFrame:
    """``url_Bayes, prob_Bayes, copies`` of the weighted URLs the naive Bayes model flags."""
    rows = token_text(once_per_row(urls).where("url IS NOT NULL"), keep=[COPIES])
    if isinstance(model, TokenBayes):  # scores distinct rows; those that were repeated are so again
        rows = rows.groupBy(*rows.columns).agg(F.count("*").alias("_times"))
    found = flagged(bayes_transform(rows, model), "predictions")
    found = repeated(found, "_times") if "_times" in found.columns else found
    return found.select(F.col("Url").alias("url_Bayes"), "prob_Bayes", COPIES)


def score_both(urls: DataFrame, models: Models) -> DataFrame:
    """Append both flags and ``prob_Bayes`` to ``meeting_counts`` rows: one pass, every row is kept.

    URLs that cannot be parsed get zero features so that the tree model can run; their tree flag is
    false whatever it says. The row without a URL has both flags false.
    ``_key`` is the URL as it was counted: rows stay dealt by it.
    """
    rows = lexical_columns(once_per_row(urls.withColumn("_key", F.col("url"))))
    filled = [
        F.when(F.col("valid"), F.col(f).cast("int")).otherwise(0).alias(f) for f in LEXICAL_FEATURES
    ]
    trees = models.gbdt.transform(rows.select(*urls.columns, "_key", "valid", *filled))
    gbdt_flag = F.coalesce("valid", F.lit(False)) & (F.col("predictions") == CLASS_SUSPICIOUS)
    words = trees.select(
        *urls.columns, "_key", gbdt_flag.alias("gbdt_flag"), token_word(F.col("url")).alias("Word")
    )
    return bayes_transform(words, models.bayes).select(
        *urls.columns,
        "gbdt_flag",
        (F.col("url").isNotNull() & (F.col("predictions") == CLASS_SUSPICIOUS)).alias("bayes_flag"),
        "prob_Bayes",
    )


def score_lines(lines: DataFrame, index: int, models: Models, normalized: bool = False) -> DataFrame:
    """Log lines to fused verdicts in one batch."""
    urls = meeting_counts(lines.select(field(F.col("value"), index).alias("url")))
    return fuse_scored(score_both(urls.where("download"), models), normalized)
