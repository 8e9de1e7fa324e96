from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from threatsieve.llm import simhash
from threatsieve.llm.shared import components, unite


def plain_fingerprint(text: str) -> int:
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_by_hand(values: dict, distance: int = 3) -> dict:
    """Key to the smallest key reachable over links."""
    keys = list(values)
    found = {k: k for k in keys}
    changed = True
    while changed:
        changed = False
        for a in keys:
            for b in keys:
                if bin(values[a] ^ values[b]).count("1") <= distance and found[a] != found[b]:
                    found[a] = found[b] = min(found[a], found[b])
                    changed = True
    return found


def documents(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


TEXTS = [
    "", None, " \t\n", "One", "one", "one two", "ONE TWO three", "ÀB c D e", "a\x0bb\x0cc\rd e", "a b c d e f g",
    *[" ".join(random.Random(s).choice("ab cd ef gh ij kl mn".split()) for _ in range(n)) for s, n in ((1, 4), (2, 40), (3, 400), (4, 40_000))],
]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint(text):
    assert simhash.fingerprint((text or "").encode()) == plain_fingerprint(text or "")


def test_groups_by_brute_force(spark, monkeypatch):
    rng = random.Random(7)
    base = [[rng.choice("abcdefghij") * 3 for _ in range(60)] for _ in range(6)]
    texts = []
    for k in range(120):
        words = list(base[k % 6])
        for _ in range(rng.choice([0, 0, 1, 1, 3, 20])):
            words[rng.randrange(60)] = rng.choice("xyz") * 2
        texts.append(" ".join(words))
    texts += ["", None, texts[0], texts[0]]
    monkeypatch.setattr(simhash, "BLOCK_ROWS", 8)  # the large groups go over pairs of blocks
    expected = groups_by_hand({i: plain_fingerprint(t or "") for i, t in enumerate(texts)})
    for partitions in (3, 4):
        rows = simhash.near_duplicates(documents(spark, texts), partitions=partitions).collect()
        assert {r.doc_id: r.component_id for r in rows} == expected
    kept = {r.doc_id for r in simhash.one_per_group(documents(spark, texts)).collect()}
    assert kept == set(expected.values())


def test_thresholds_cover_every_pair():
    """For thresholds that sum as they must, some part of each close pair is within its own."""
    parts = [list(range(k, 64, 4)) for k in range(4)]
    rng = np.random.default_rng(3)
    for limits in ([0, 0, 0, 0], [1, 0, 0, -1], [2, 0, -1, -1], [1, 1, -1, -1]):
        assert sum(t + 1 for t in limits) == 4
        for _ in range(200):
            flips = rng.choice(64, 3, replace=False)
            near = [sum(int(f) in part for f in flips) for part in parts]
            assert any(n <= t for n, t in zip(near, limits, strict=True))


def test_odd_rows(spark):
    frame = spark.createDataFrame(
        [(None, "a b c", 1, "x", 4, 7), (3, "a b c", 2, None, 4, 7), (3, "a b c", 2, None, 4, 7), (None, None, 3, "y", 4, 7), (None, None, 3, "y", 4, 7)],
        "doc_id long, text string, fp int, component string, chosen_id int, text_hash long",
    )
    rows = simhash.near_duplicates(frame).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in rows) == [(-1, -1), (-1, -1), (-1, 3), (3, 3), (3, 3)]
    kept = simhash.one_per_group(frame)
    assert kept.columns == frame.columns
    assert {(r.chosen_id, r.text_hash) for r in kept.collect()} == {(4, 7)}
    assert sorted((r.doc_id or -1, r.text or "") for r in kept.collect()) == [(-1, ""), (3, "a b c")]
    assert simhash.near_duplicates(frame.limit(0)).count() == 0
    assert simhash.one_per_group(frame.limit(0)).count() == 0


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (300, 200), (None, 5)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    expected = {i: 0 for i in range(41)} | {k: 100 for k in range(100, 160)} | {200: 200, 300: 200}
    assert {n: found.get(n, n) for n in expected} == expected
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
    parents = np.arange(6)
    unite(parents, np.array([5, 3, 4]), np.array([4, 2, 2]))
    assert parents.tolist() == [0, 1, 2, 2, 2, 2]
