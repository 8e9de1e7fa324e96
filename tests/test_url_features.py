from __future__ import annotations

import random

import pytest

from pyspark.sql import functions as F

from tests.java_urls import CORPUS, MORE, REJECTED, feature_row, java_url
from threatsieve.functions import constants as C
from threatsieve.functions.tokens import token_text
from threatsieve.functions.url import (
    _HAS_QUAD,
    _NUMBERS,
    LEXICAL_FEATURES,
    lexical_columns,
    lexical_features,
    url_parts,
    with_default_scheme,
)

PIECES = [
    "http://", "https://", "HTTP:", "ftp://", "file:", "foo://", "mailto:", "jar:", "!/", "url:",
    "a.com", "b_c", "1.2.3.4", ":", ":80", ":-1", ":-2", ":+7", ":2147483648", "@", "/", "//", "////",
    "?", "#", ".", "..", " ", "[::1]", "[", "]", "[1:2::1.2.3.4]", "::", "%", "x12a34", "-5.6",
    ".apk", ".sisx", "下载", "😀", "sexmovie", "free~js", "\t", "|", "12", "!", "://", "\n",
]


def fuzz(count, seed):
    rng = random.Random(seed)
    out = set()
    while len(out) < count:
        text = "".join(rng.choice(PIECES) for _ in range(rng.randint(1, 8)))
        if rng.random() < 0.5:
            text = "http://" + text
        out.add(text)
    return sorted(out)


def frame(spark, strings):
    rows = list(enumerate(strings))
    return spark.createDataFrame(rows, "id int, url string")


def check_against_java(spark, strings):
    tlds = set(C.KNOWN_TLDS)
    rows = lexical_features(frame(spark, strings), keep=["id"]).collect()
    found = {row["id"]: tuple(row)[1:] for row in rows}
    wrong = [
        (text, found.get(i), expected)
        for i, text in enumerate(strings)
        if found.get(i) != (expected := feature_row(spark, text, tlds))
    ]
    assert wrong == []


def test_known_tlds():
    tlds = C.KNOWN_TLDS
    assert len(tlds) == len(set(tlds)) == 274
    assert {"com", "cn", "uk", "web", "zw", "cq"} <= set(tlds)
    assert not {"gb", "gq", "ax", "example", "apk"} & set(tlds)


def test_parity_corpus(spark):
    check_against_java(spark, CORPUS)
    kept = lexical_features(frame(spark, CORPUS), keep=["id"]).select("id").collect()
    assert {CORPUS[i] for i in range(len(CORPUS))} - {CORPUS[r.id] for r in kept} == REJECTED


def test_awkward_urls(spark):
    check_against_java(spark, MORE)


@pytest.mark.parametrize("seed", [1, 2])
def test_fuzzed_urls(spark, seed):
    check_against_java(spark, fuzz(500, seed))


def test_fuzzed_ip_hosts(spark):
    rng = random.Random(5)
    pieces = [":", ":", ":", "::", "1", "ab", "2001", "db8", "FFFF", "12345", "0001", "1.2.3.4", "010.0.0.255",
              "256.1.1.1", "1.2.3", "%en0", "%", "g", "."]
    strings = set()
    while len(strings) < 500:
        groups = [rng.choice(["1", "ab", "db8", "2001", "0000"]) for _ in range(rng.randint(1, 9))]
        if rng.random() < 0.5:
            groups.insert(rng.randint(0, len(groups)), "")
        host = ":".join(groups)
        if rng.random() < 0.3:
            host += rng.choice(["1.2.3.4", ":1.2.3.4", "::", "%1", "::9.9.9.9"])
        if rng.random() < 0.3:
            host = "".join(rng.choice(pieces) for _ in range(rng.randint(1, 8)))
        strings.add(f"{rng.choice(['http', 'ftp'])}://[{host}]{rng.choice(['', ':80', '/x'])}")
    strings = sorted(strings)
    parsed = [java_url(spark, s) is not None for s in strings]
    assert 50 < sum(parsed) < 450
    rows = url_parts(frame(spark, strings), "url").orderBy("id").collect()
    assert [s for s, r, p in zip(strings, rows, parsed) if r.parses != p] == []


def test_long_texts_neither_overflow_nor_hang(spark):
    n = 100_000
    strings = [
        "http://" + "a" * n, "http://" + "@" * n, "http://a.com/" + "/" * n, "http://[" + "1:" * n + "]/x",
        "http://a.com:" + "0" * n + "80/x", "jar:http://a/" + "!/" * n, "http://" + "a." * n + "com/x.apk",
        "http://a.com/" + "1-" * n, "jar:mailto:" + " " * n + "!/", "http://" + "." * n, "http://[" + "a" * n,
        "mailto:" + " " * n + "://", "http://a.com/" + "1." * n, " " * n + "http://a.com" + " " * n,
    ]
    valid = [r.valid for r in lexical_columns(frame(spark, strings)).orderBy("id").collect()]
    tlds = set(C.KNOWN_TLDS)
    assert valid == [feature_row(spark, s, tlds) is not None for s in strings]


def test_parts_without_default_scheme(spark):
    strings = CORPUS + MORE
    rows = url_parts(frame(spark, strings), "url").collect()
    for row in rows:
        parsed = java_url(spark, row.url)
        assert row.parses == (parsed is not None), row.url
        if parsed is not None:
            assert (row.host, row.port_number) == (parsed.getHost(), parsed.getPort()), row.url
            assert row.scheme == parsed.getProtocol(), row.url


@pytest.mark.parametrize(
    "raw, column, value",
    [
        ("http://a.com/x12a34.apk", "Numricinlength", 5),
        ("https://a.com/x.apk", "port", 80),
        ("http://a.com/v/1.2.3.4.zip", "isIP", True),
        ("http://sexmovie.tk/x", "longTermCount", 3),
        ("a.com/x.apk", "Url", "http://a.com/x.apk"),
    ],
)
def test_worked_examples(spark, raw, column, value):
    assert lexical_features(frame(spark, [raw])).first()[column] == value


def test_token_word(spark):
    rows = token_text(frame(spark, ["https://a-b.com:80/x(1)?q=2&u=http://c.d/9.apk", "a.com/x.apk"]))
    assert [tuple(r) for r in rows.collect()] == [
        ("https://a-b.com:80/x(1)?q=2&u=http://c.d/9.apk", "a/b/com//x/)/q//u/c/d//apk"),
        ("a.com/x.apk", "a/com/x/apk"),
    ]


def test_invalid_rows_are_kept_by_the_unfiltered_form(spark):
    df = lexical_columns(frame(spark, ["http://a.com/x", "http://a.com:x/"]))
    assert [r.valid for r in df.orderBy("id").collect()] == [True, False]


def test_broken_encoding_fails_no_task(spark):
    raw = b"http://a.com/\xff\xe4.apk"
    df = spark.createDataFrame([(bytearray(raw),)], "b binary").select(F.col("b").cast("string").alias("url"))
    row = lexical_features(df).first()
    assert (row.urllen, row.execfile_len, row.is_Prefix_sensitive) == (19, 6, True)
    assert token_text(df).first().Word is not None


def test_own_tlds(spark):
    df = lexical_features(frame(spark, ["http://a.corp/x", "http://a.com/x"]), tlds=["corp"])
    assert [r.isDing for r in df.orderBy("Url").collect()] == [False, True]


def test_features_stay_in_generated_code(spark):
    df = lexical_features(spark.range(10).select(F.concat(F.lit("a.com/"), F.col("id")).alias("url")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
    assert len(df.columns) == 1 + len(LEXICAL_FEATURES)


def test_null_url_gives_no_row(spark):
    df = spark.createDataFrame([(None,)], "url string")
    assert lexical_features(df).count() == 0
    assert df.select(with_default_scheme(F.col("url")).alias("u")).first().u in (None, "http://")


def test_short_patterns_find_the_same(spark):
    rng = random.Random(3)
    strings = ["".join(rng.choice("0125.9.-a") for _ in range(rng.randint(1, 18))) for _ in range(3000)]
    found = frame(spark, strings).select(
        "url",
        F.col("url").rlike(_HAS_QUAD).alias("quad"),
        F.col("url").rlike(C.IPV4_PATTERN).alias("full_quad"),
        F.regexp_replace("url", _NUMBERS, "").alias("rest"),
        F.regexp_replace("url", C.NUMBER_PATTERN, "").alias("full_rest"),
    )
    assert found.where("quad <> full_quad OR rest <> full_rest").collect() == []
    assert 0 < found.where("quad").count() < 3000
