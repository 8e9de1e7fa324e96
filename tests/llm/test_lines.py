from __future__ import annotations

import random
import re

import duckdb

from threatsieve.llm import lines


def plain_key(line):
    return re.sub(r"[A-Z]", lambda m: m[0].lower(), re.sub(r"\A[ \t-\r]+|[ \t-\r]+\Z", "", line))


def by_hand(rows, least_docs, least_chars=1):
    seen = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            seen.setdefault(plain_key(line), set()).add(doc_id)
    gone = {k for k, ids in seen.items() if len(ids) >= least_docs and len(k) >= least_chars}
    out = []
    for doc_id, text in rows:
        own = (text or "").split("\n")
        kept = [line for line in own if plain_key(line) not in gone]
        out.append((doc_id, "\n".join(kept), len(own), len(own) - len(kept)))
    return sorted(out, key=repr)


def found(spark, rows, *args):
    frame = spark.createDataFrame([(i, t, "k", 5) for i, t in rows], "doc_id long, text string, key string, place int")
    return sorted(map(tuple, lines.without_common_lines(frame, *args).collect()), key=repr)


def test_lines_by_brute_force(spark):
    rng = random.Random(11)
    pool = ["Alpha", "alpha ", "\tALPHA\r", "École", "école", "ÉCOLE", "", "  ", "beta\x0b", "x\xa0", "x", " y", "İ", "i̇", "ſ", "Σας", "日本"]
    pool += [f"line {k}" for k in range(40)]
    rows = [(k, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 30)))) for k in range(60)]
    rows += [(100, None), (101, ""), (102, "\n"), (103, "\n\nalpha\n"), (None, "alpha\nonly here"), (None, "beta"), (5, rows[7][1]), (5, rows[7][1])]
    for least_docs, least_chars in ((10, 1), (2, 1), (25, 3), (10, 0)):
        assert found(spark, rows, least_docs, least_chars) == by_hand(rows, least_docs, least_chars)


def test_repeats_within_a_document_count_once(spark):
    rows = [(1, "a\na\na\nb"), (1, "a"), (2, "a\nc"), (None, "b"), (None, "b\nb")]
    assert found(spark, rows, 3) == by_hand(rows, 3) == [(1, "a", 1, 0), (1, "a\na\na\nb", 4, 0), (2, "a\nc", 2, 0), (None, "b", 1, 0), (None, "b\nb", 2, 0)]
    assert found(spark, rows, 2) == by_hand(rows, 2)


def test_long_and_empty(spark):
    long = "\n".join(f"row {k}" if k % 3 else "common" for k in range(200_000)) + "\n" + "z" * 500_000
    rows = [(k, "common\nown %d" % k) for k in range(12)] + [(99, long)]
    assert found(spark, rows, 10) == by_hand(rows, 10)
    assert found(spark, [], 10) == []


def test_no_python_in_the_plan(spark, sf_dir):
    plan = lines.op11_lines(spark, sf_dir)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|CartesianProduct|NestedLoop", plan)


def test_same_rows_as_sql(spark, sf_dir):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    relation = connection.sql(lines.ORACLE_SQL)
    rows = lines.op11_lines(spark, sf_dir).select(*relation.columns).collect()
    assert sorted(map(tuple, rows)) == sorted(relation.fetchall()) and any(r.n_dropped for r in rows)
