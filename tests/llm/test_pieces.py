from __future__ import annotations

import random
import time

import pytest

from threatsieve.llm import pieces

COMMON = ["", None, "a", "the thing", " two  spaces ", "line\nbreak\n\nand\ttab", "Größe café 日本語 🙂 \U0001f9ff", "x" * 300, "\x00\x07"]


@pytest.fixture(scope="module")
def coder():
    return pieces.Lattice(pieces.default_model(), 4)


def all_paths(coder, part):
    """Every segmentation of a short part with its score, from the model's pieces alone."""
    flat = {}

    def walk(tree, name):
        for letter, (below, piece) in tree.items():
            if piece:
                flat[name + letter] = piece
            walk(below, name + letter)

    walk(coder.tree, "")
    found = []

    def step(at, score, ids):
        if at == len(part):
            found.append((score, tuple(ids)))
        for end in range(at + 1, len(part) + 1):
            if part[at:end] in flat:
                value, own = flat[part[at:end]]
                step(end, score + value, [*ids, *own])
        if at < len(part) and part[at] not in flat:
            step(at + 1, score + coder.unknown, [*ids, *(coder.bytes[b] for b in part[at].encode())])

    step(0, 0.0, [])
    return sorted(found, reverse=True)


@pytest.mark.parametrize("part", ["▁the", "▁thing", "▁aaaa", "▁x日y", "▁▁▁", "\n", "▁inging"])
def test_search_by_brute_force(coder, part):
    expected = all_paths(coder, part)
    found = coder.search(part)
    assert [s for s, _ in found] == pytest.approx([s for s, _ in expected[: len(found)]])
    assert len(found) == min(4, len(expected)) and len({ids for _, ids in found}) == len(found)
    assert {ids for _, ids in found} <= {ids for _, ids in expected}
    _, best, loss = coder.part(part)
    assert best == pytest.approx(expected[0][0])
    assert loss == pytest.approx(expected[0][0] - expected[1][0]) if len(expected) > 1 else loss > 1e200


@pytest.mark.parametrize("text", ["ab cd", "the a\nof", "a a a"])
def test_whole_texts_by_brute_force(coder, text):
    expected = all_paths(coder, "▁" + text.replace(" ", "▁"))
    found = coder.encode(text)
    assert [s for s, _ in found] == pytest.approx([s for s, _ in expected[:4]])
    assert all(coder.decode(ids.tolist()) == text for _, ids in found)
    assert len({tuple(ids.tolist()) for _, ids in found}) == 4


def test_round_trip(coder):
    rng = random.Random(2)
    texts = [t or "" for t in COMMON] + ["".join(rng.choice("ab  é\n日.") for _ in range(rng.randint(1, 40))) for _ in range(200)]
    for text in texts:
        found = coder.encode(text)
        assert all(coder.decode(ids.tolist()) == text for _, ids in found), text
        assert [s for s, _ in found] == sorted((s for s, _ in found), reverse=True)
    ((score, ids),) = coder.encode("")
    assert (score, len(ids)) == (0.0, 0)
    (score, ids), *_ = coder.encode("a▁b")
    assert coder.decode(ids.tolist()) == "a b"  # the space mark itself reads as a space


def test_ties_and_long_parts_take_no_longer(coder):
    rng = random.Random(6)
    n = 100_000
    texts = ["a" * n, "-" * n, "".join(rng.choices("abcdefghijklmnopqrstuvwxyzABCDEFGH0123456789+/", k=n)), "".join(map(chr, rng.choices(range(0x4E00, 0x9FA0), k=n)))]
    for text in texts:
        began = time.monotonic()
        found = coder.encode(text)
        assert time.monotonic() - began < 20
        # Characters without longer pieces have one segmentation.
        assert len(found) == (4 if text.isascii() else 1) and coder.decode(found[-1][1].tolist()) == text
        assert [s for s, _ in found] == sorted((s for s, _ in found), reverse=True)


def test_frames(spark):
    frame = spark.createDataFrame([(i, t, 7) for i, t in enumerate(COMMON)] + [(None, "the", 7), (1, None, 7)], "doc_id long, text string, rank int")
    best = {(r.doc_id, r.rank): r for r in pieces.segmentations(frame, n_best=2).where("doc_id <> 1").collect()}
    back = {r.doc_id: r.text for r in pieces.decoded(pieces.segmentations(frame, n_best=2).where("rank = 1")).where("doc_id <> 1").collect()}
    assert back == {i: t or "" for i, t in enumerate(COMMON) if i != 1}
    rows = pieces.summary(frame, n_best=2, with_ids=True).collect()
    assert len(rows) == len(COMMON) + 2 and all(r.decodes and r.n_tokens == len(r.ids) for r in rows)
    assert all(best[r.doc_id, 1].ids == r.ids for r in rows if r.doc_id not in (None, 1))
    assert pieces.summary(frame.limit(0)).count() == 0
