from __future__ import annotations

import json
import pathlib
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from threatsieve.operators import daily, fusion, scoring, training
from threatsieve.operators.weights import weigh
from threatsieve.plans import fixtures as fx
from threatsieve.plans.queries import models_for
from threatsieve.sources import lines as src
from threatsieve.streaming import scorer as st


@pytest.fixture(scope="module")
def models(spark, sf_dir):
    return models_for(spark, sf_dir)


@pytest.fixture(scope="module")
def source(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lines") / "in")
    fx.hit_lines(fx.hits(spark, sf_dir)).select("value").repartition(4).write.text(path)
    return path


def result_lines(spark, output):
    return sorted(r.value for r in src.read_lines(spark, output).collect())


def run(spark, source, scorer, checkpoint, max_files=None):
    stream = src.stream_lines(spark, source, max_files)
    query = st.build_query(stream, scorer, checkpoint, seconds=None)
    assert query.awaitTermination(300)
    assert query.exception() is None
    return query


def make(models, tmp_path, **kwargs):
    return st.Scorer(models, fx.URL_INDEX, str(tmp_path / "out"), str(tmp_path / "metrics"), **kwargs)


def test_stream_gives_the_batch_result(spark, source, models, tmp_path):
    run(spark, source, make(models, tmp_path), str(tmp_path / "ck"))
    lines = src.read_lines(spark, source)
    fused = scoring.score_lines(lines, fx.URL_INDEX, models)
    expected = sorted(f"{r.url}|0.58|{r.prob_Bayes}" for r in fused.collect())
    assert result_lines(spark, str(tmp_path / "out")) == expected
    counts = st.read_metrics(spark, str(tmp_path / "metrics")).first()
    assert (counts.input_count, counts.bad_count) == (1000, 10)
    kept = src.extract_field(lines, fx.URL_INDEX).where("url rlike '(apk|sisx|jar|exe|zip)$'")
    assert counts.suffix_count == kept.count()
    assert counts.output_count == sum(r.copies for r in fused.collect())
    days = [p.name for p in (tmp_path / "out").iterdir() if not p.name.startswith(".")]
    assert days == [counts.day] and len(counts.day) == 8


def test_repeated_lines_follow_the_join(spark, source, models, tmp_path):
    run(spark, source, make(models, tmp_path, repeat=True), str(tmp_path / "ck"))
    rows = src.extract_field(src.read_lines(spark, source), fx.URL_INDEX)
    rows = rows.where("url rlike '(apk|sis|sisx|jar|exe|cab|ipa|elf|cod|alx|prc|zip|rar)$'")
    one = rows.select("url", F.lit(1).cast("bigint").alias("copies"))
    joined = scoring.gbdt_verdicts(one, models.gbdt).join(
        scoring.bayes_verdicts(one, models.bayes), F.expr("url_GBDT = url_Bayes")
    )
    expected = sorted(f"{r.url_GBDT}|0.58|{r.prob_Bayes}" for r in joined.collect())
    assert result_lines(spark, str(tmp_path / "out")) == expected


def test_restart_and_replay_add_nothing(spark, source, models, tmp_path):
    scorer, checkpoint = make(models, tmp_path), str(tmp_path / "ck")
    run(spark, source, scorer, checkpoint, max_files=2)
    before = result_lines(spark, str(tmp_path / "out"))
    batches = st.read_metrics(spark, str(tmp_path / "metrics")).count()
    assert batches == 2
    run(spark, source, scorer, checkpoint, max_files=2)
    assert result_lines(spark, str(tmp_path / "out")) == before
    # The last batch is forgotten as a crash after its write would do, and so runs again.
    for entry in pathlib.Path(checkpoint, "commits").iterdir():
        if entry.name in ("1", ".1.crc"):
            entry.unlink()
    run(spark, source, scorer, checkpoint, max_files=2)
    assert result_lines(spark, str(tmp_path / "out")) == before
    assert st.read_metrics(spark, str(tmp_path / "metrics")).count() == batches


def test_whitelist_and_normalized_fusion(spark, source, models, tmp_path):
    kept = "http://10.0.0.5/a.sisx"
    listed = spark.createDataFrame([(kept,)], "url string")
    scorer = make(models, tmp_path, whitelist=lambda session: listed, normalized=True)
    run(spark, source, scorer, str(tmp_path / "ck"))
    urls = {line.split("|")[0] for line in result_lines(spark, str(tmp_path / "out"))}
    plain = scoring.score_lines(src.read_lines(spark, source), fx.URL_INDEX, models, True)
    assert urls == {r.url for r in plain.collect()} - {kept}
    assert st.read_metrics(spark, str(tmp_path / "metrics")).first().listed_count > 0


def test_batches_without_hits_write_nothing(spark, models, tmp_path):
    lines = tmp_path / "in"
    lines.mkdir()
    (lines / "a.txt").write_text("1|x|http://a.com/page\n2|x\n")
    run(spark, str(lines), make(models, tmp_path, bad_lines=str(tmp_path / "bad")), str(tmp_path / "ck"))
    assert not (tmp_path / "out").exists()
    assert result_lines(spark, str(tmp_path / "bad")) == ["2|x"]
    row = st.read_metrics(spark, str(tmp_path / "metrics")).first()
    assert (row.input_count, row.bad_count, row.suffix_count, row.output_count) == (2, 1, 0, 0)


def test_a_batch_run_again_without_bad_lines_leaves_none(spark, models, tmp_path):
    scorer = make(models, tmp_path, bad_lines=str(tmp_path / "bad"))

    def batch(values):
        frame = spark.createDataFrame([(v,) for v in values], "value string")
        scorer.run_batch(scorer.prepare(frame), "q-1")

    batch(["1|x|http://a.com/page", "2|x"])
    day = st.read_metrics(spark, str(tmp_path / "metrics")).first().day
    assert result_lines(spark, str(tmp_path / "bad")) == ["2|x"]
    batch(["1|x|http://a.com/page"])
    assert not (tmp_path / "bad" / day / "batch=q-1").exists()
    assert st.read_metrics(spark, str(tmp_path / "metrics"), day).first().bad_count == 0
    assert (tmp_path / "metrics" / f"day={day}" / "batch=q-1").is_dir()


def test_one_pass_fusion_equals_the_join(spark, models):
    urls = [
        "a.com/x.apk", "a.com/x.apk", "http://a.com/x.apk", "http://a.com/x.apk", "http://a.com/x.apk",
        "b.com/free.exe", "http://bad:port/x.apk", "https://a.com/x.apk", "ftp://10.0.0.1/a.sisx",
        "http://10.0.0.7/a.sisx", "10.0.0.7/a.sisx", "//10.0.0.8/a.sisx", "http:////10.0.0.8/a.sisx",
        "ahttp:/10.0.0.9/a.sisx", "10.0.0.1/r?u=http://10.0.0.2/a.sisx",
    ]
    rows = spark.createDataFrame([(u,) for u in urls], "url string")
    one_pass = fusion.fuse_scored(scoring.score_both(fusion.meeting_counts(rows).where("download"), models))
    weighted = weigh(rows, "url")
    joined = fusion.fusion_join(
        scoring.gbdt_verdicts(weighted, models.gbdt), scoring.bayes_verdicts(weighted, models.bayes)
    )
    columns = ["url", "prob_GBDT", "prob_Bayes", "copies"]
    found = sorted(map(tuple, one_pass.select(columns).collect()))
    assert found == sorted(map(tuple, joined.select(columns).collect()))
    assert found


def test_kafka_options():
    options = src.kafka_options(
        "h1:9092,h2:9092", "access", "group", "earliest", 100_000, seconds=5, partitions=3
    )
    assert options == {
        "kafka.bootstrap.servers": "h1:9092,h2:9092", "subscribe": "access",
        "startingOffsets": "earliest", "kafka.group.id": "group",
        "maxOffsetsPerTrigger": "1500000",
    }
    with pytest.raises(ValueError):
        src.kafka_options("h", "t", start="middle")
    noon = datetime(2024, 5, 1, 12, tzinfo=timezone(timedelta(hours=8)))
    timed = src.kafka_options("h:9092", "t", start_time=noon)
    assert timed == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "t",
        "startingTimestamp": "1714536000000", "startingOffsetsByTimestampStrategy": "latest",
    }
    with pytest.raises(ValueError):
        src.kafka_options("h", "t", start_time=datetime(2024, 5, 1))
    assert st.publish_options("h:9092", "url")["kafka.acks"] == "1"


def test_files_are_paced_by_bytes(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for k in range(6):
        (folder / f"{k}.log").write_text(f"line {k}\n" * 100)
    stream = src.stream_lines(spark, str(folder), max_bytes="1500")
    query = stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    assert query.awaitTermination(120) and query.exception() is None
    rows = [p.numInputRows for p in query.recentProgress if p.numInputRows]
    assert sum(rows) == 600 and len(rows) == 3
    with pytest.raises(ValueError):
        src.stream_lines(spark, str(folder), 1, "1m")


def test_probe_prints_rows(spark, source, tmp_path, capfd):
    query = st.probe_query(src.stream_lines(spark, source), fx.URL_INDEX, rows=10, seconds=1)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert json.loads(query.lastProgress.json)["sink"]["description"].startswith("org.apache.spark")


def test_saved_models_score_the_same(spark, sf_dir, models, tmp_path):
    training.save_model(models.gbdt, str(tmp_path / "gbdt"))
    training.save_model(models.bayes, str(tmp_path / "bayes"))
    loaded = scoring.load_models(str(tmp_path / "gbdt"), str(tmp_path / "bayes"))
    lines = fx.hit_lines(fx.hits(spark, sf_dir))
    first = sorted(map(tuple, scoring.score_lines(lines, fx.URL_INDEX, models).collect()))
    second = sorted(map(tuple, scoring.score_lines(lines, fx.URL_INDEX, loaded).collect()))
    assert first == second


def test_rerun_without_results_removes_the_old_ones(spark, models, tmp_path):
    scorer = make(models, tmp_path)
    rows = spark.createDataFrame([("http://10.0.0.7/a.sisx",)] * 3, "url string")
    batch = rows.withColumn("batch_ts", F.to_timestamp(F.lit("2024-05-06 23:59:59")))
    scorer.run_batch(batch, "q-0")
    scorer.run_batch(batch, "q-1")
    assert len(result_lines(spark, str(tmp_path / "out" / "20240506"))) == 2
    listed = rows.distinct()
    make(models, tmp_path, whitelist=lambda session: listed).run_batch(batch, "q-1")
    assert len(result_lines(spark, str(tmp_path / "out" / "20240506"))) == 1


def test_timed_batches(spark, source, models, tmp_path):
    stream = src.stream_lines(spark, source, 1)
    query = st.build_query(stream, make(models, tmp_path), str(tmp_path / "ck"), seconds=1)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    counts = st.read_metrics(spark, str(tmp_path / "metrics"))
    assert counts.count() == 4
    (day,) = daily.daily_stats(counts).collect()
    assert day.input_count == 1000
    assert day.output_count == counts.agg(F.sum("output_count")).first()[0]
