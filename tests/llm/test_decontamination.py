from __future__ import annotations

import itertools
import random
import re

import pytest

from threatsieve.llm import decontamination as d


@pytest.mark.parametrize("n, misses, masks", [(20, 4, (0, 1)), (15, 3, (0, 1)), (19, 3, (0, 1)), (10, 2, (0, 1, 2)), (14, 2, (0, 1, 2))])
def test_masks_hit_every_pattern(n, misses, masks):
    shapes = [[k for k, bit in enumerate(d.MASKS[m]) if bit == "1"] for m in masks]
    for changed in itertools.combinations(range(n), misses):
        equal = [k not in changed for k in range(n)]
        assert any(all(equal[s + k] for k in shape) for shape in shapes for s in range(n - shape[-1]))


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def by_hand(docs, items, window=20):
    found = {}
    for doc_id, text in docs:
        for item_id, item in items:
            a, b = words(text), words(item)
            if len(b) < 5:
                continue
            run = min(window, len(b))
            needed = run - (int(run * 0.2 + 1e-9) if len(b) >= 10 else 0)
            for shift in range(-len(b), len(a)):
                same = [0 <= shift + k < len(a) and a[shift + k] == b[k] for k in range(len(b))]
                best = max(sum(same[s : s + run]) for s in range(len(b) - run + 1))
                if best >= needed:
                    found[doc_id, item_id] = max(best, found.get((doc_id, item_id), 0))
    return found


def test_matches_by_brute_force(spark, monkeypatch):
    rng = random.Random(11)
    vocabulary = [a + b for a in "bcdfg" for b in ("an", "el", "ir")]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(n))) for k, n in enumerate([3, 5, 9, 10, 13, 15, 20, 33, 120])]
    docs = []
    for k in range(120):
        own = words(rng.choice(items)[1])
        cut = own[rng.randrange(max(1, len(own) // 4)) :][: rng.choice([18, 22, 500])]
        for _ in range(rng.choice([0, 0, 1, 2, 4, 6])):
            cut[rng.randrange(len(cut))] = rng.choice(["other", *vocabulary])
        around = [rng.choice(vocabulary) for _ in range(60)]
        docs.append((k, " ".join(around[:30]).upper() + ". " * (k % 2) + " " + ", ".join(cut) + " " + " ".join(around[30:])))
    docs += [(900, None), (901, ""), (902, items[7][1]), (903, items[1][1])]
    expected = by_hand(docs, items)
    frame, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.matched for r in d.matches(frame, bench).collect()}
    assert found == expected and len(found) > 30
    long_only = bench.where("item_id >= 5")
    found = {(r.doc_id, r.item_id): r.matched for r in d.matches(frame, long_only).collect()}
    assert found == {k: v for k, v in expected.items() if k[1] >= 5}
    monkeypatch.setattr(d, "BROADCAST_SEEDS", 1)  # seeds are shuffled, lists fetched after
    found = {(r.doc_id, r.item_id): r.matched for r in d.matches(frame, bench).collect()}
    assert found == expected


def test_shuffled_when_the_benchmark_is_large(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k"), (2, "z y x")], "doc_id long, text string")
    bench = spark.createDataFrame([(5, "a b c d e f g h i j")], "item_id long, text string")
    monkeypatch.setattr(d, "BROADCAST_SEEDS", 1)
    found = d.matches(docs, bench)
    assert [tuple(r) for r in found.collect()] == [(1, 5, 10)]
    odd = docs.unionByName(docs.limit(1)).unionByName(spark.createDataFrame([(None, "x a b c d e f g h i j k"), (None, None)], docs.schema))
    assert sorted((r.doc_id or 0, r.matched) for r in d.matches(odd, bench).collect()) == [(0, 10), (1, 10)]
    # What is shuffled by seed has no word list.
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert "doc_key" in text
    exchanges = [line for line in found._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange hashpartitioning(seed" in line]
    assert exchanges


def test_odd_rows(spark):
    leak = "one two three four five six seven eight nine ten eleven twelve"
    docs = spark.createDataFrame(
        [(None, leak, 1), (4, leak, 2), (4, leak, 2), (5, "clean text", 3), (6, None, 4), (7, leak * 3, 5)],
        "doc_id long, text string, item_id int",
    )
    bench = spark.createDataFrame([(1, leak, "x"), (1, leak, "y"), (2, None, "z"), (3, "", None)], "item_id long, text string, doc_id string")
    assert sorted((r.doc_id or 0, r.item_id) for r in d.matches(docs, bench).collect()) == [(0, 1), (4, 1), (7, 1)]
    kept = d.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [5, 6]
    assert d.drop_contaminated(docs, bench.limit(0)).count() == 6
    assert d.matches(docs.limit(0), bench).count() == 0


def test_no_python_in_the_plan(spark, sf_dir):
    text = d.op2_decontamination(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "Cartesian" not in text
