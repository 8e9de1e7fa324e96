"""Manifests: half batches are not seen, whole ones are not run again, counts come from the write."""

from __future__ import annotations

import pytest
from pyspark.errors import ParseException
from pyspark.sql import functions as F

from threatsieve.jobs.daily_report import run_report
from threatsieve.operators import scoring
from threatsieve.operators.fusion import fuse_scored
from threatsieve.plans import fixtures as fx
from threatsieve.plans.queries import models_for
from threatsieve.sinks import commits
from threatsieve.sinks.text import write_batch_text
from threatsieve.sources import lines as src
from threatsieve.streaming import scorer as st

DAY = "20240506"


@pytest.fixture(scope="module")
def models(spark, sf_dir):
    return models_for(spark, sf_dir)


@pytest.fixture
def scorer(models, tmp_path):
    return st.Scorer(
        models, fx.URL_INDEX, str(tmp_path / "out"), str(tmp_path / "metrics"),
        bad_lines=str(tmp_path / "bad"), commits=str(tmp_path / "commits"),
    )


def batch(spark, scorer, urls):
    rows = spark.createDataFrame([(f"1|x|{u}" if u else "short",) for u in urls], "value string")
    return scorer.prepare(rows).withColumn("batch_ts", F.to_timestamp(F.lit("2024-05-06 23:59:59")))


def seen(spark, scorer, kind="results"):
    directory = {"results": scorer.output, "bad_lines": scorer.bad_lines}[kind]
    return sorted(r.value.split("|")[0] for r in commits.committed_lines(spark, directory, scorer.commits, DAY, kind).collect())


HOT = ["http://10.0.0.7/a.sisx", "http://10.0.0.8/a.sisx", "http://10.0.0.9/a.sisx"]


@pytest.mark.parametrize("stops_in", ["bad", "metrics", "commit"])
def test_half_batches_are_not_seen(spark, scorer, tmp_path, monkeypatch, stops_in):
    scorer.run_batch(batch(spark, scorer, [HOT[0], "", "http://a.com/page"]), "q-0")
    assert seen(spark, scorer) == [HOT[0]] and seen(spark, scorer, "bad_lines") == ["short"]

    def fail(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        if stops_in == "bad":
            write = st.write_batch_text
            patch.setattr(st, "write_batch_text", lambda df, directory, *a: fail() if directory == scorer.bad_lines else write(df, directory, *a))
        elif stops_in == "metrics":
            patch.setattr(st, "METRICS_SCHEMA", "day NOTHING")
        else:
            patch.setattr(st, "commit", fail)
        with pytest.raises((RuntimeError, ParseException)):
            scorer.run_batch(batch(spark, scorer, [HOT[1], HOT[2], ""]), "q-1")
    assert sorted(r.value.split("|")[0] for r in src.read_lines(spark, f"{scorer.output}/{DAY}").collect()) == sorted(HOT)
    assert seen(spark, scorer) == [HOT[0]]
    lists = tmp_path / "list.txt"
    lists.write_text("")
    args = (str(tmp_path / "reports"), str(lists), str(lists), 10)
    _, counts = run_report(spark, scorer.output, *args, commits=scorer.commits, day=DAY)
    assert counts["input_count"] == 1
    _, counts = run_report(spark, f"{scorer.output}/{DAY}", *args)
    assert counts["input_count"] == 3  # what a reader without the manifests takes for whole
    assert st.read_metrics(spark, scorer.metrics, DAY, scorer.commits).count() == 1
    # The batch runs again, with fewer results: only those count.
    scorer.run_batch(batch(spark, scorer, [HOT[1], "", ""]), "q-1")
    assert seen(spark, scorer) == HOT[:2] and seen(spark, scorer, "bad_lines") == ["short"] * 3
    rows = st.read_metrics(spark, scorer.metrics, DAY, scorer.commits).collect()
    assert sorted(r.input_count for r in rows) == [3, 3]


def test_whole_batches_are_not_run_again(spark, scorer):
    scorer.run_batch(batch(spark, scorer, HOT), "q-0")
    (before,) = commits.manifests(spark, scorer.commits, DAY).collect()
    scorer.run_batch(batch(spark, scorer, HOT[:1]), "q-0")
    (after,) = commits.manifests(spark, scorer.commits, DAY).collect()
    assert before == after and seen(spark, scorer) == HOT
    assert before.batch == "q-0" and len(before.results) >= 1 and before.bad_lines == []


def test_batches_without_results_are_committed(spark, scorer, tmp_path):
    assert commits.committed_lines(spark, scorer.output, scorer.commits).count() == 0
    scorer.run_batch(batch(spark, scorer, ["http://a.com/page"]), "q-0")
    assert commits.is_committed(spark, scorer.commits, DAY, "q-0")
    assert not commits.is_committed(spark, scorer.commits, DAY, "q-1")
    assert seen(spark, scorer) == [] and not (tmp_path / "out").exists()
    scorer.run_batch(batch(spark, scorer, []), "q-1")
    assert not commits.is_committed(spark, scorer.commits, DAY, "q-1")  # nothing read, nothing written


def test_stream_with_manifests(spark, sf_dir, scorer, tmp_path):
    source = str(tmp_path / "in")
    fx.hit_lines(fx.hits(spark, sf_dir)).select("value").repartition(4).write.text(source)
    query = st.build_query(src.stream_lines(spark, source, 2), scorer, str(tmp_path / "ck"), seconds=None)
    assert query.awaitTermination(300) and query.exception() is None
    rows = commits.manifests(spark, scorer.commits).collect()
    assert sorted(r.batch[-2:] for r in rows) == ["-0", "-1"]
    lines = commits.committed_lines(spark, scorer.output, scorer.commits)
    assert sorted(r.value for r in lines.collect()) == sorted(r.value for r in src.read_lines(spark, scorer.output).collect())
    counts = st.read_metrics(spark, scorer.metrics, commits=scorer.commits)
    assert counts.agg(F.sum("input_count")).first()[0] == 1000


def counts_by_hand(spark, scorer, rows):
    """The counts of a job of its own over the kept rows."""
    scored = scorer.score(rows).persist()
    try:
        return scored.agg(*scorer.stage_counts()).first().asDict()
    finally:
        scored.unpersist()


@pytest.mark.parametrize("normalized", [False, True])
def test_counts_are_observed_in_the_write(spark, sf_dir, models, tmp_path, normalized):
    lines = fx.hit_lines(fx.hits(spark, sf_dir)).select("value")
    listed = spark.createDataFrame([("http://10.0.0.5/a.sisx",)], "url string")
    scorer = st.Scorer(models, fx.URL_INDEX, str(tmp_path / "o"), str(tmp_path / "m"), lambda _: listed, normalized)
    rows = scorer.prepare(lines)
    context = spark.sparkContext

    def jobs(group, action):
        context.setJobGroup(group, group)
        try:
            return action(), len(context.statusTracker().getJobIdsForGroup(group))
        finally:
            context.setLocalProperty("spark.jobGroup.id", None)

    found, with_counts = jobs(f"observed{normalized}", lambda: scorer.write_results(scorer.score(rows), DAY, "q-0"))
    plain = fuse_scored(scorer.score(rows).where("NOT listed"), normalized).drop("copies")
    _, without = jobs(f"plain{normalized}", lambda: write_batch_text(plain, str(tmp_path / "p"), DAY, "q-0"))
    assert with_counts == without  # counting is no job
    assert found == counts_by_hand(spark, scorer, rows)
    assert found["output_count"] > 0 and found["listed_count"] > 0
    fused = scoring.score_lines(lines, fx.URL_INDEX, models, normalized).where("url <> 'http://10.0.0.5/a.sisx'")
    assert found["verdict_count"] == fused.count() == src.read_lines(spark, str(tmp_path / "o")).count()
