from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import duckdb

from threatsieve.llm import divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def by_hand(rows, least_docs=3, top=200):
    """``rows``: text, lang, source."""
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        terms = TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        counts[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
        groups[lang or ""].add(source or "")
    out = []
    for lang, sources in groups.items():
        kept = sorted(t for t, n in docs[lang].items() if n >= least_docs)
        own = {s: {t: counts[lang, s][t] for t in kept} for s in sources}
        whole = {t: sum(c[t] for c in own.values()) for t in kept}

        def shares(count, v=len(kept)):
            total = sum(count.values())
            return {t: 1 + 10**9 * (n + 1) // (total + v) for t, n in count.items()}

        p, q = {s: shares(c) for s, c in own.items()}, shares(whole)
        for s in sources:
            pair = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in sources - {s}]
            term = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if own[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pair, len(pair)), ("term", term, top)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, value, rank) for rank, (value, item) in enumerate(ranked, 1)]
    return sorted(out)


def found(spark, rows, *args):
    frame = spark.createDataFrame([(i, *r, 1, "x") for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string, page int, gid string")
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return sorted(map(tuple, divergence.audit(frame.repartition(4), *args).select(*columns).collect()))


def corpus(rng, n, sources, terms):
    pool = [f"t{'abcdefghij'[k % 10]}{'abcdefghij'[k // 10 % 10]}{'abcdefghij'[k // 100]}" for k in range(terms)] + ["Été", "été", "日本", "Zz", "zZ"]
    rows = []
    for _ in range(n):
        source = rng.randrange(sources)
        words = [pool[min(int(rng.expovariate(8 / len(pool)) + source % 3), len(pool) - 1)] for _ in range(rng.choice([0, 5, 80]))]
        rows.append((rng.choice([" ", "7", "@"]).join(words), rng.choice(["en", "de"]), f"s{source}"))
    return rows


def test_audit_by_brute_force(spark, monkeypatch):
    rng = random.Random(13)
    rows = corpus(rng, 400, 9, 300) + [(None, "en", "empty"), ("", "xx", "a"), ("one two", "xx", "b"), ("one two", None, None), ("one", "", "s"), ("one one two", None, "s")]
    assert found(spark, rows) == by_hand(rows)
    monkeypatch.setattr(divergence, "BLOCK_ROWS", 40)  # pages are dealt over pairs of blocks
    monkeypatch.setattr(divergence, "HELD", 50)  # counts and sums are handed on in parts
    assert found(spark, rows, 2, 7) == by_hand(rows, 2, 7)


def test_ties_single_sources_and_nothing_kept(spark):
    rows = [("a b c", "en", "x")] * 4 + [("a b c", "en", "y")] * 2 + [("only", "fr", "x")] * 5 + [("rare", "de", s) for s in "xy"]
    result = found(spark, rows)
    assert result == by_hand(rows)
    assert [r for r in result if r[0] == "de"] == [("de", "x", "pair", "y", 0, 1), ("de", "y", "pair", "x", 0, 1)]
    assert not [r for r in result if r[0] == "fr"]
    assert found(spark, []) == []


def test_long_text_counts_once(spark, monkeypatch):
    monkeypatch.setattr(divergence, "PIECE", 50)
    rows = [("alpha beta " * 2000 + "日本" * 400, "en", "x"), ("alpha beta", "en", "y"), ("alpha", "en", "x")]
    assert found(spark, rows) == by_hand(rows)
    assert found(spark, rows, 1) == by_hand(rows, 1)


def test_same_rows_as_sql(spark, sf_dir):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    relation = connection.sql(divergence.ORACLE_SQL)
    rows = divergence.op13_divergence(spark, sf_dir).select(*relation.columns).collect()
    assert sorted(map(tuple, rows)) == sorted(relation.fetchall()) and rows
