"""Every registered query against its SQL counterpart, and the known counts of the fixtures."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as entry
from threatsieve.plans.oracle import oracle_sql
from threatsieve.plans.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
ORACLE = oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    yield connection
    connection.close()


def plain(value):
    return round(value, 9) if isinstance(value, float) and not math.isnan(value) else value


def test_every_oracle_has_a_query():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_training_keeps_what_the_other_drops(spark, sf_dir):
    counts = [QUERIES[name](spark, sf_dir).count() for name in ("train_lexical", "train_tokens")]
    assert counts[0] < counts[1] == 1000


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, duck, sf_dir, name):
    found = QUERIES[name](spark, sf_dir)
    relation = duck.sql(ORACLE[name])
    columns = sorted(found.columns)
    assert columns == sorted(relation.columns)
    order = [relation.columns.index(c) for c in columns]
    expected = sorted(
        (tuple(plain(row[i]) for i in order) for row in relation.fetchall()), key=repr
    )
    rows = sorted((tuple(plain(v) for v in row) for row in found.select(*columns).collect()), key=repr)
    assert rows == expected
    assert rows


def test_known_counts(spark, sf_dir):
    count = {name: QUERIES[name](spark, sf_dir).count() for name in (
        "hit_lines", "bad_records", "suffix_filter", "dedup_urls", "package_urls", "list_union")}
    assert count == {
        "hit_lines": 1000, "bad_records": 10, "suffix_filter": 875, "dedup_urls": 331,
        "package_urls": 223, "list_union": 53,
    }
    fused = QUERIES["fusion_join"](spark, sf_dir)
    assert fused.selectExpr("sum(cast(copies as bigint))").first()[0] == 433
    funnel = QUERIES["funnel_counts"](spark, sf_dir).first()
    assert tuple(funnel) == (1000, 669, 331, 158, 173)
    assert QUERIES["daily_stats"](spark, sf_dir).count() == 30


def test_entry_gives_one_document(spark):
    assert entry.entry(spark).count() == 1

