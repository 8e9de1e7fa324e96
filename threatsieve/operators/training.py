"""Training sets and model fitting.

The pre-trained models of the original service are not public, so ours are fitted on labelled
URLs. Both are plain ML pipelines that can be saved, loaded and swapped for others with the same
output columns (``predictions`` and, for naive Bayes, ``myProbability``).
"""

from __future__ import annotations

import logging
import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, NaiveBayes
from pyspark.ml.feature import CountVectorizer, RegexTokenizer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threatsieve.functions.tokens import token_text
from threatsieve.functions.url import LEXICAL_FEATURES, lexical_features
from threatsieve.operators import token_bayes
from threatsieve.operators.token_bayes import TokenBayes
from threatsieve.operators.weights import COPIES, once_per_row, weigh
from threatsieve.sinks.text import path_exists

# Most distinct labelled URLs the naive Bayes pipeline uses; what the driver holds of the vocabulary follows from it.
MAX_LABELLED = 1_000_000
# Spark looks for the thresholds of trees in a sample of this many rows, or of the square of the bins if that is more.
SAMPLED_ROWS, USUAL_BINS, MOST_BINS = 10_000, 32, 46_340
ANY_VOCABULARY = 2**31 - 1
URLS_PER_TASK = 20_000
log = logging.getLogger(__name__)


def lexical_training(labelled: DataFrame) -> DataFrame:
    """Lexical feature rows with their label; URLs that cannot be parsed are left out."""
    rows = lexical_features(labelled, keep=["label"])
    return rows.select("Url", *LEXICAL_FEATURES, F.col("label").cast("int").alias("label"))


def token_training(labelled: DataFrame) -> DataFrame:
    """Token rows with their label."""
    rows = token_text(labelled, keep=["label"])
    return rows.select("Url", "Word", F.col("label").cast("int").alias("label"))


def bounded(counted: DataFrame, total: int, most: int) -> DataFrame:
    """About ``most`` of ``total`` distinct URLs, never above it in practice: those with the smallest hashes.

    A URL is in or out as a whole, and the same in every run. Below the bound nothing is left out.
    """
    if total <= most:
        return counted
    share = (most - 8 * most**0.5) / total
    limit = F.lit(int(max(share, 0.0) * 2**62))
    return counted.where(F.shiftrightunsigned(F.xxhash64("url"), 2) < limit)


@contextmanager
def _counted(labelled: DataFrame, max_labelled: int) -> Iterator[DataFrame]:
    """Equal labelled rows as one weighted row, at most about ``max_labelled`` URLs; kept during the fit."""
    rows = weigh(labelled, "url", "label").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        total = rows.select(F.xxhash64("url")).distinct().count()  # the hash that a bound goes by
        log.info("fitting on %d of %d distinct labelled URLs", min(total, max_labelled), total)
        # The many small stages of a fit are as wide as its rows ask for, not as the session is.
        tasks = 1 + min(total, max_labelled) // URLS_PER_TASK
        yield once_per_row(bounded(rows, total, max_labelled)).coalesce(tasks)
    finally:
        rows.unpersist()


@contextmanager
def _kept(rows: DataFrame) -> Iterator[DataFrame]:
    """Keep the training rows while a fit goes over them several times."""
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield rows
    finally:
        rows.unpersist()


def whole_bins(rows: int) -> int:
    """So many bins that Spark looks for thresholds in all rows; only those of values that occur take space."""
    bins = USUAL_BINS if rows <= SAMPLED_ROWS else math.isqrt(rows - 1) + 1
    if bins > MOST_BINS:  # Spark squares them as an int
        raise ValueError(f"thresholds of {rows} feature rows would come from a sample")
    return bins


def fit_gbdt(labelled: DataFrame, rounds: int = 20, depth: int = 5, seed: int = 7) -> PipelineModel:
    """Boosted trees on the lexical features of all labelled URLs, with thresholds from all of them.

    URLs with equal features and label are fitted as one weighted row. Rows that were not counted are first, so that
    features are worked out once per URL.
    """
    assembler = VectorAssembler(inputCols=list(LEXICAL_FEATURES), outputCol="features")
    counted = once_per_row(labelled if COPIES in labelled.columns else weigh(labelled, "url", "label"))
    featured = weigh(lexical_features(counted, keep=["label", COPIES]), *LEXICAL_FEATURES, "label")
    with _kept(featured) as rows:
        total = rows.count()
        tasks = 1 + total // URLS_PER_TASK
        trees = GBTClassifier(
            featuresCol="features", labelCol="label", predictionCol="predictions",
            weightCol=COPIES, maxIter=rounds, maxDepth=depth, maxBins=whole_bins(total), seed=seed,
        )
        return Pipeline(stages=[assembler, trees]).fit(rows.coalesce(tasks))


def fit_bayes(labelled: DataFrame, max_labelled: int = MAX_LABELLED) -> PipelineModel:
    """Multinomial naive Bayes on token counts as a pipeline; equal rows are fitted as one weighted row.

    The vocabulary is every token of the rows used. It passes through the driver, and its sums through
    one group per label; ``max_labelled`` bounds both. ``token_bayes.fit`` has neither bound.
    """
    tokenizer = RegexTokenizer(
        inputCol="Word", outputCol="tokens", pattern="/+", gaps=True, toLowercase=False
    )
    counts = CountVectorizer(inputCol="tokens", outputCol="counts", vocabSize=ANY_VOCABULARY)
    bayes = NaiveBayes(
        featuresCol="counts", labelCol="label", predictionCol="predictions",
        probabilityCol="myProbability", weightCol=COPIES, smoothing=1.0,
    )
    with _counted(labelled, max_labelled) as counted:
        with _kept(token_text(counted, keep=["label", COPIES])) as rows:
            return Pipeline(stages=[tokenizer, counts, bayes]).fit(rows)


def save_model(model: PipelineModel | TokenBayes, path: str) -> None:
    if isinstance(model, TokenBayes):
        token_bayes.save(model, path)
    else:
        model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_bayes(path: str) -> PipelineModel | TokenBayes:
    """A naive Bayes model in either form."""
    spark = SparkSession.active()
    return token_bayes.load(spark, path) if path_exists(spark, f"{path}/classes") else load_model(path)
