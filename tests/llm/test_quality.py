from __future__ import annotations

import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from threatsieve.llm import quality


@pytest.fixture(scope="module")
def scores(spark):
    folder = "/root/testdata/sf0.1"
    rows = quality.op10_quality(spark, folder).toPandas()
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{folder}/labels.parquet'").df()
    return rows, rows.merge(labels, on="doc_id")


def test_held_out_accuracy(scores):
    rows, known = scores
    assert len(rows) == 10_000 and rows.score.between(0, 1).all()
    assert (rows.held_out == rows.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)).all()
    assert (rows.predicted == (rows.score >= 0.3)).all()
    held = known[known.held_out]
    assert len(held) > 500
    assert (held.predicted == held.quality).mean() > 0.97
    assert held[held.quality == 1].predicted.mean() > 0.98
    rank = held.score.rank()
    good, bad = (held.quality == 1).sum(), (held.quality == 0).sum()
    assert (rank[held.quality == 1].sum() - good * (good + 1) / 2) / (good * bad) > 0.98


def test_interactions_are_learnt():
    """A label that is the exclusive or of two features needs a table of the pair."""
    values = np.random.default_rng(1).random((4000, 4))
    labels = ((values[:, 1] > 0.5) ^ (values[:, 2] > 0.5)).astype(int)
    model = quality.fit(values, labels)
    assert (1, 2) in model.pairs
    assert ((model.scores(values) > 0.5) == labels).mean() > 0.9
    by_hand = []
    for row in values[:50]:
        total = model.base + sum(model.tables[f][sum(row[f] >= c for c in model.cuts[f])] for f in range(4))
        for (f, g), table in zip(model.pairs, model.pair_tables, strict=True):
            total += table[sum(row[f] >= c for c in model.coarse[f]), sum(row[g] >= c for c in model.coarse[g])]
        by_hand.append(1 / (1 + np.exp(-total)))
    assert np.allclose(by_hand, model.scores(values[:50]))


def test_bound_and_held_out_rows(spark):
    docs = spark.createDataFrame([(i, f"word {i} " * (i % 7)) for i in range(300)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(300)], "doc_id long, quality int, toxic int")
    all_rows, few = quality.fit_on(docs, labels), quality.fit_on(docs, labels, max_labelled=40)
    assert len(few.cuts) == len(quality.FEATURES) and few.base != all_rows.base
    flipped = labels.selectExpr("doc_id", "IF(crc32(CAST(doc_id AS STRING)) % 5 = 0, 1 - quality, quality) AS quality")
    again = quality.fit_on(docs, flipped)
    assert again.base == all_rows.base and np.array_equal(again.tables, all_rows.tables)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(None, None, 1), (None, "a", 2), (1, "", 3), (1, "x " * 5000, 4)], "doc_id long, text string, score int")
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.fit_on(docs, none)
    assert {r.score for r in quality.scored(docs, model).collect()} == {0.5}
    one = spark.createDataFrame([(1, 1), (1, None), (None, 0), (1, 1)], "doc_id long, quality int")
    model = quality.fit_on(docs, one)
    assert quality.scored(docs, model).count() == 4
    kept = quality.keep_good(docs, model)
    assert kept.schema == docs.schema and kept.count() == 4
    assert quality.keep_good(docs, model, 1.1).count() == 0
    assert quality.scored(docs.limit(0), model).count() == 0
    assert all(np.isfinite(quality.feature_matrix([b"", b"\xff\xfe", b"a" * 9, "é日\n\n|".encode()])).ravel())


def test_repeated_ids_give_one_fit(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    again = docs.unionByName(docs.withColumn("text", F.concat(F.lit("zzz "), "text")).repartition(7))
    texts = [r.text.encode() for r in docs.orderBy("doc_id").limit(50).collect()]
    least = again.groupBy("doc_id").agg(F.min("text").alias("text"))
    first, second, third = (quality.fit_on(d, labels).scores(quality.feature_matrix(texts)).tolist() for d in (again, again.repartition(3), least))
    assert first == second == third
