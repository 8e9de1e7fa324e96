"""Multinomial naive Bayes whose model is two tables, for vocabularies of any size.

``weights`` has ``token, log_weights`` for every token of the labelled URLs, a logarithm per label; ``classes`` has
``label, log_prior``, a row per label, in the order of the labels. Both come from one aggregate over the exploded tokens; a URL is scored by
joining its tokens with the weights and adding up. No vocabulary passes through the driver, only the classes do, and
no labelled row is left out.

Tokens such as ``com`` stand in nearly every URL. When fitting, they are summed in each task before they are shuffled. When scoring,
small weights are broadcast by their measured size, and large ones joined by a plain sort-merge join, whose
large partitions Spark splits at run time.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threatsieve.functions.tokens import token_word
from threatsieve.operators.weights import COPIES

SMOOTHING = 1.0
# Logarithms are added up as whole numbers of this part of one, so that sums do not depend on the order of their terms.
UNITS = 10**10


@dataclass(frozen=True)
class TokenBayes:
    """A fitted model; ``priors`` are the rows of ``classes``, by ascending label."""

    weights: DataFrame
    classes: DataFrame
    priors: tuple[tuple[int, float], ...]

    def long(self) -> DataFrame:
        """``token, label, log_weight``, a row per token and label."""
        labels = F.array(*[F.lit(label) for label, _ in self.priors])
        pairs = F.explode(F.arrays_zip(labels.alias("label"), F.col("log_weights").alias("log_weight"))).alias("of")
        return self.weights.select("token", pairs).select("token", "of.label", "of.log_weight")


def tokens_of(word: Column) -> Column:
    """The tokens of a token text; a NULL text has none."""
    return F.array_remove(F.split(F.coalesce(word, F.lit("")), "/+"), "")


def token_counts(labelled: DataFrame) -> DataFrame:
    """``token, label, n`` of ``url, label`` rows (weighted ones too); the NULL token counts the rows themselves."""
    copies = F.col(COPIES) if COPIES in labelled.columns else F.lit(1).cast("bigint")
    tokens = F.concat(tokens_of(token_word(F.col("url"))), F.array(F.lit(None).cast("string")))
    rows = labelled.select("label", copies.alias(COPIES), F.explode(tokens).alias("token"))
    return rows.groupBy("token", "label").agg(F.sum(COPIES).alias("n"))


def tables_of(counts: DataFrame, smoothing: float = SMOOTHING) -> tuple[DataFrame, DataFrame]:
    """``weights`` and ``classes`` of ``token_counts``; read more than once, so give it a stored or persisted frame."""
    known = counts.where("token IS NOT NULL")
    every = F.lit(smoothing)
    sizes = counts.groupBy("label").agg(
        F.sum(F.when(F.col("token").isNull(), F.col("n"))).alias("rows"),
        F.coalesce(F.sum(F.when(F.col("token").isNotNull(), F.col("n"))), F.lit(0)).alias("total"),
    )
    # A row per label each; as scalar subqueries they need no join.
    of_all = sizes.agg(F.sum("rows").alias("rows"), F.count("*").alias("labels"))
    all_rows, labels = of_all.select("rows").scalar(), of_all.select("labels").scalar()
    prior = F.log((F.col("rows") + every) / (all_rows + every * labels))
    classes = sizes.select("label", prior.alias("log_prior"))

    tokens = known.groupBy("token").agg(F.map_from_entries(F.collect_list(F.struct("label", "n"))).alias("by_label"))
    vocabulary = known.select(F.count_distinct("token")).scalar()
    totals = sizes.agg(F.array_sort(F.collect_list(F.struct("label", "total")))).scalar()
    sized = tokens.select("token", "by_label", totals.alias("totals"), vocabulary.alias("vocabulary"))

    def weight(of: Column) -> Column:
        n = F.coalesce(F.try_element_at("by_label", of["label"]), F.lit(0))
        return F.log((n + every) / (of["total"] + every * F.col("vocabulary")))

    return sized.select("token", F.transform("totals", weight).alias("log_weights")), classes


def fit(labelled: DataFrame, path: str, smoothing: float = SMOOTHING) -> TokenBayes:
    """Fit on all labelled rows and write the model below ``path``; gives it as read from there."""
    spark = labelled.sparkSession
    token_counts(labelled).write.mode("overwrite").parquet(f"{path}/counts")
    _write(*tables_of(spark.read.parquet(f"{path}/counts"), smoothing), path)
    return load(spark, path)


def _write(weights: DataFrame, classes: DataFrame, path: str) -> None:
    """Both tables; ``classes`` last, so that a model without it is not whole."""
    weights.write.mode("overwrite").parquet(f"{path}/weights")
    classes.coalesce(1).write.mode("overwrite").parquet(f"{path}/classes")


def save(model: TokenBayes, path: str) -> None:
    _write(model.weights, model.classes, path)


def load(spark: SparkSession, path: str) -> TokenBayes:
    weights, classes = (spark.read.parquet(f"{path}/{table}") for table in ("weights", "classes"))
    return TokenBayes(weights, classes, tuple(sorted(map(tuple, classes.collect()))))  # a row per label


def with_verdicts(rows: DataFrame, model: TokenBayes, word: Column, keep: Sequence[str] | None = None) -> DataFrame:
    """Append ``predictions`` and ``myProbability`` (by ascending label) from the token text ``word``.

    Rows must be distinct in the columns to ``keep`` (all), as weighted frames are. Tokens that the model does not know say nothing. A URL has the same
    probability in every run and plan; the smaller label wins a tie.
    """
    if not model.priors:
        raise ValueError("the model was fitted on no rows")
    kept = [F.col(f"`{c}`") for c in keep or rows.columns]
    exploded = rows.select(*kept, F.explode_outer(tokens_of(word)).alias("_token"))
    places = range(len(model.priors))
    units = [F.round(F.get("log_weights", k) * UNITS).cast("bigint").alias(f"_w{k}") for k in places]
    weights = model.weights.select(F.col("token").alias("_token"), *units)
    sums = [F.coalesce(F.sum(f"_w{k}"), F.lit(0)).alias(f"_s{k}") for k in places]
    summed = exploded.join(weights, "_token", "left").groupBy(*kept).agg(*sums)
    raw = [F.lit(prior) + F.col(f"_s{k}") / F.lit(float(UNITS)) for k, (_, prior) in enumerate(model.priors)]
    scored = summed.select(*kept, F.array(*raw).alias("_raw")).select("*", F.array_max("_raw").alias("_top"))
    shares = [F.exp(F.get("_raw", k) - F.col("_top")) for k in places]
    labels = F.array(*[F.lit(label) for label, _ in model.priors])
    best = F.element_at(labels, F.array_position("_raw", F.col("_top")).cast("int"))
    total = sum(shares[1:], shares[0])
    return scored.select(*kept, best.alias("predictions"), F.array(*[share / total for share in shares]).alias("myProbability"))
