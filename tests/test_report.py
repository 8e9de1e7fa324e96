from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.java_urls import CORPUS, MORE, java_url
from threatsieve.functions import constants as C
from threatsieve.functions.stamps import DAY, SECOND, province, run_time, stamp
from threatsieve.jobs.daily_report import run_report
from threatsieve.operators import daily, report
from threatsieve.sinks.text import merge_small_files, write_batch_text, write_day_text
from threatsieve.sources.lines import read_lines

NOW = datetime(2024, 5, 6, 7, 8, 9)


def urls(spark, values):
    return spark.createDataFrame([(v,) for v in values], "url string")


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_document(spark):
    rows = urls(spark, ["http://b.cn:81/下.apk", "http://bad:port/x.apk", "a.com/x.apk", "http://a.com/\"1\".apk"])
    text = report.report_json(rows, 10, NOW).first().report
    found = json.loads(text)
    assert list(found) == ["date", "size", "list"]
    assert found["date"] == "2024-05-06 07:08:09"
    assert found["size"] == 4 and len(found["list"]) == 2
    assert [e["url"] for e in found["list"]] == ['http://a.com/"1".apk', "http://b.cn:81/下.apk"]
    assert [list(e) for e in found["list"]] == [["area", "degree", "domain", "url"]] * 2
    assert found["list"][1]["domain"] == "b.cn" and found["list"][1]["degree"] == "0.8"
    assert all(e["area"] in C.PROVINCE_CODES for e in found["list"])


def test_size_is_capped_by_the_limit(spark):
    rows = urls(spark, [f"http://a.com/{i}.apk" for i in range(9)] + ["b.com/x.apk"])
    found = json.loads(report.report_json(rows, 3, NOW).first().report)
    assert found["size"] == 3
    assert [e["url"] for e in found["list"]] == [f"http://a.com/{i}.apk" for i in range(3)]
    empty = json.loads(report.report_json(rows.limit(0), 3, NOW).first().report)
    assert empty == {"date": "2024-05-06 07:08:09", "size": 0, "list": []}
    with pytest.raises(ValueError):
        report.report_rows(rows, 0)


def test_domains_follow_the_parser(spark):
    strings = sorted(set(CORPUS + MORE))
    rows = {r.url: r.domain for r in report.report_rows(urls(spark, strings), 10_000).collect()}
    parsed = {s: java_url(spark, s) for s in strings}
    assert rows == {s: p.getHost() for s, p in parsed.items() if p is not None}


def test_province_is_stable(spark):
    rows = urls(spark, [f"http://a.com/{i}" for i in range(500)])
    first = rows.select("url", province(F.col("url")).alias("p")).collect()
    again = rows.repartition(5).select("url", province(F.col("url")).alias("p")).collect()
    assert dict(map(tuple, first)) == dict(map(tuple, again))
    assert {r.p for r in first} == set(C.PROVINCE_CODES)


def test_funnel(spark):
    rows = lines(spark, ["http://a/1.apk|0.58|0.9"] * 5 + ["http://a/2.apk|x", "http://a/3.zip", "|||", "http://a/4.apk"])
    listed = urls(spark, ["http://a/4.apk", "http://a/4.apk", "http://other/"])
    flagged = report.flagged_urls(rows, listed)
    assert tuple(report.funnel_counts(flagged).first()) == (9, 4, 5, 3, 2)
    kept = {r.url for r in report.result_urls(flagged).collect()}
    assert kept == {"http://a/1.apk", "http://a/2.apk"}
    none = report.funnel_counts(report.flagged_urls(rows.limit(0), listed)).first()
    assert tuple(none) == (0, 0, 0, 0, 0)


def test_report_job(spark, tmp_path):
    day = str(tmp_path / "result" / "20240506")
    frame = spark.createDataFrame(
        [("http://a.com/1.apk", "0.58", 0.9), ("http://a.com/2.apk", "0.58", None), ("http://a.com/3.zip", "0.58", 0.7)],
        "url string, g string, b double",
    )
    write_day_text(frame, str(tmp_path / "result"), "20240506")
    write_day_text(frame.limit(1), str(tmp_path / "result"), "20240506")
    write_batch_text(frame, str(tmp_path / "result"), "20240506", "q-1")
    write_batch_text(frame, str(tmp_path / "result"), "20240506", "q-1")
    assert sorted(r.value for r in read_lines(spark, day).collect()) == sorted(
        ["http://a.com/1.apk|0.58|0.9"] * 3 + ["http://a.com/2.apk|0.58"] * 2 + ["http://a.com/3.zip|0.58|0.7"] * 2
    )
    (tmp_path / "white.txt").write_text("http://a.com/2.apk\n")
    (tmp_path / "black.txt").write_text("http://z/\n")
    for merge_to in (None, str(tmp_path / "merged")):
        path, counts = run_report(
            spark, day, str(tmp_path / "report") + "/", str(tmp_path / "white.txt"),
            str(tmp_path / "black.txt"), 5, NOW, merge_to=merge_to,
        )
        assert path == str(tmp_path / "report" / "20240506_malicious_urls")
        assert counts == {
            "input_count": 7, "duplicate_count": 4, "dedup_count": 3, "filtered_count": 2, "result_count": 1,
        }
        document = [r.value for r in spark.read.text(path).collect()]
        assert len(document) == 1
        assert [e["url"] for e in json.loads(document[0])["list"]] == ["http://a.com/1.apk"]


def test_merge_keeps_lines_and_sources(spark, tmp_path):
    source = tmp_path / "day"
    (source / "sub").mkdir(parents=True)
    for i in range(30):
        (source / f"part-{i}.txt").write_text(f"line {i}\n")
    (source / "sub" / "more.txt").write_text("line 30\n")
    (source / "_SUCCESS").write_text("")
    (source / "_skipped").write_text("no\n")
    target = tmp_path / "merged"
    merge_small_files(spark, str(source), str(target), files=2)
    assert sorted(r.value for r in spark.read.text(str(target)).collect()) == sorted(
        f"line {i}" for i in range(31)
    )
    assert len(list(target.glob("part-*"))) <= 2
    assert len(list(source.glob("part-*"))) == 30


def test_stamps(spark):
    row = spark.range(1).select(
        stamp(run_time(datetime(2024, 1, 2, 3, 4, 5)), SECOND).alias("s"), run_time().alias("now")
    ).first()
    assert row.s == "20240102030405" and row.now is not None


def test_stream_and_report_count_days_on_one_clock(spark, tmp_path):
    """At noon UTC it is another day already at +14 or still at -12: both jobs take the session's."""
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("Etc/GMT-14", "Etc/GMT+12"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            stream_day = spark.range(1).select(F.date_format(F.current_timestamp(), DAY)).first()[0]
            (tmp_path / "list.txt").write_text("http://z/\n")
            lines(spark, ["http://a.com/1.apk|0.58|0.9"]).write.mode("overwrite").text(str(tmp_path / "in"))
            path, _ = run_report(
                spark, str(tmp_path / "in"), str(tmp_path / "report"), str(tmp_path / "list.txt"),
                str(tmp_path / "list.txt"), 5,
            )
            assert path.endswith(f"{stream_day}_malicious_urls")
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_daily_sums(spark):
    rows = spark.createDataFrame(
        [("20240101", 1, 1, 1, 1, 1), ("20240101", 2, 1, 0, 1, 0), ("20240102", 5, 4, 3, 2, 1)],
        "day string, " + ", ".join(f"{s} bigint" for s in daily.STAGES),
    )
    found = {r.day: tuple(r)[1:] for r in daily.daily_stats(rows).collect()}
    assert found == {"20240101": (3, 2, 1, 2, 1), "20240102": (5, 4, 3, 2, 1)}
