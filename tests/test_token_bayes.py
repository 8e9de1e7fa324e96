"""Naive Bayes as tables: against the pipeline, by hand, and its plans."""

from __future__ import annotations

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from threatsieve.operators import scoring, token_bayes, training
from threatsieve.operators.weights import weigh
from threatsieve.plans import fixtures as fx
from threatsieve.plans.queries import _downloads, models_for

WORDS = ["com", "apk", "free", "movie", "x", "下载", "ok", "a b"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def corpus(rng, n):
    return [("http://" + "/".join(rng.choice(WORDS[: 4 + 4 * label]) for _ in range(rng.randint(0, 5))), label) for label in (rng.randint(0, 1) for _ in range(n))]


def by_hand(rows, smoothing=1.0):
    """Log weights and priors from the definition."""
    tokens = {label: Counter() for _, label in rows}
    for url, label in rows:
        tokens[label].update(t for t in url.replace("http://", "").split("/") if t)
    vocabulary = set().union(*tokens.values())
    weights = {
        (t, label): math.log((n[t] + smoothing) / (sum(n.values()) + smoothing * len(vocabulary))) for label, n in tokens.items() for t in vocabulary
    }
    count = Counter(label for _, label in rows)
    return weights, {label: math.log((n + smoothing) / (len(rows) + smoothing * len(count))) for label, n in count.items()}


@pytest.mark.parametrize("smoothing", [1.0, 0.25])
def test_tables_by_hand(spark, tmp_path, smoothing):
    rows = corpus(random.Random(1), 300) + [("http://", 1), ("http://only-here", 0)]
    rows = [(u.replace("-", "/"), label) for u, label in rows]
    frame = spark.createDataFrame(rows, "url string, label int").repartition(3)
    model = token_bayes.fit(frame, str(tmp_path / "m"), smoothing)
    weights, priors = by_hand(rows, smoothing)
    assert {(r.token, r.label): r.log_weight for r in model.long().collect()} == pytest.approx(weights)
    assert {r.label: r.log_prior for r in model.classes.collect()} == pytest.approx(priors) == dict(model.priors)
    again, _ = token_bayes.tables_of(token_bayes.token_counts(weigh(frame, "url", "label")), smoothing)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, model.weights.collect()))


def test_verdicts_by_hand(spark, tmp_path):
    rng = random.Random(2)
    rows = corpus(rng, 200)
    model = token_bayes.fit(spark.createDataFrame(rows, "url string, label int"), str(tmp_path / "m"))
    weights, priors = by_hand(rows)
    texts = ["", None, "unknown", "com/com//apk/", "a b/unknown/下载", "/".join(WORDS * 300)]
    found = token_bayes.with_verdicts(spark.createDataFrame([(t, k) for k, t in enumerate(texts)], "Word string, label int"), model, F.col("Word"))
    assert found.columns == ["Word", "label", "predictions", "myProbability"]
    rows = found.collect()
    assert len(rows) == len(texts)
    for row in rows:
        own = [t for t in (row.Word or "").split("/") if (t, 0) in weights]
        raw = [priors[label] + sum(weights[t, label] for t in own) for label in (0, 1)]
        assert row.predictions == raw.index(max(raw))
        assert row.myProbability[0] == pytest.approx(1 / (1 + math.exp(min(700, raw[1] - raw[0]))), abs=1e-9)
        assert sum(row.myProbability) == pytest.approx(1)


def test_equal_to_the_pipeline(spark, sf_dir):
    hits = fx.hits(spark, sf_dir)
    pipeline = training.fit_bayes(fx.labelled(hits))
    tables = models_for(spark, sf_dir).bayes
    assert isinstance(tables, token_bayes.TokenBayes)
    downloads = _downloads(hits)
    for threshold in ("10485760", "-1"):  # with and without a broadcast
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            first, second = (
                {r.url_Bayes: (round(r.prob_Bayes, 6), r.copies) for r in scoring.bayes_verdicts(downloads, m).collect()} for m in (pipeline, tables)
            )
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert first == second and first


def test_either_form_is_loaded(spark, sf_dir, tmp_path):
    labelled = fx.labelled(fx.hits(spark, sf_dir))
    training.save_model(training.fit_bayes(labelled), str(tmp_path / "pipeline"))
    training.save_model(models_for(spark, sf_dir).bayes, str(tmp_path / "tables"))
    assert isinstance(training.load_bayes(str(tmp_path / "tables")), token_bayes.TokenBayes)
    assert not isinstance(training.load_bayes(str(tmp_path / "pipeline")), token_bayes.TokenBayes)


def test_plans_have_no_collect_and_no_python(spark, sf_dir, tmp_path):
    """One shuffle for the counts; weights and URLs meet in a join; only a row per label is gathered in one place."""
    labelled = fx.labelled(fx.hits(spark, sf_dir))
    counts = token_bayes.token_counts(labelled)
    text = plan(counts)
    assert text.count("Exchange hashpartitioning") == 1 and "partial_sum" in text and "SinglePartition" not in text
    model = models_for(spark, sf_dir).bayes
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(scoring.bayes_verdicts(_downloads(fx.hits(spark, sf_dir)), model))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text and "CollectLimit" not in text and "SinglePartition" not in text
    assert "Python" not in text and "NestedLoop" not in text and "Cartesian" not in text


def test_empty_training_set(spark, tmp_path):
    empty = spark.createDataFrame([], "url string, label int")
    model = token_bayes.fit(empty, str(tmp_path / "m"))
    assert model.weights.count() == model.classes.count() == 0 and model.priors == ()


def test_a_hot_token_is_one_row_per_task(spark):
    rows = spark.range(60_000, numPartitions=6).select(F.concat(F.lit("http://com/"), F.col("id") % 7).alias("url"), (F.col("id") % 2).cast("int").alias("label"))
    counts = {(r.token, r.label): r.n for r in token_bayes.token_counts(rows).collect()}
    assert counts[("com", 0)] == counts[(None, 1)] == 30_000
