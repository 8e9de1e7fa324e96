from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from threatsieve.llm import suffixes


@pytest.mark.parametrize("alphabet", [1, 2, 4, 200])
def test_suffix_array(alphabet):
    rng = np.random.default_rng(alphabet)
    for n in [*range(1, 30), 100, 333, 1000]:
        text = rng.integers(1, alphabet + 1, n)
        assert suffixes.suffix_array(text).tolist() == sorted(range(n), key=lambda i: text[i:].tolist())


@pytest.mark.parametrize("length, gram", [(400, 100), (20, 7), (9, 8), (5, 5)])
def test_equal_windows_name_the_same_anchor(length, gram):
    rng = np.random.default_rng(length)
    texts = [bytes(rng.integers(97, 99, n).astype(np.uint8)) for n in (3, length - 1, length, 3000, 900)]
    texts.append(texts[3][200:])
    named = {}
    for text, h, place, first, last in suffixes.window_anchors(texts, length, gram):
        for t, value, at, a, b in zip(text.tolist(), h.tolist(), place.tolist(), first.tolist(), last.tolist(), strict=True):
            for w in range(a, b + 1):
                assert w <= at <= w + length - gram
                assert named.setdefault(texts[t][w : w + length], (value, at - w)) == (value, at - w)
    assert set(named) == {t[w : w + length] for t in texts for w in range(len(t) - length + 1)}


def test_smallest_and_hashes():
    values = np.random.default_rng(1).integers(0, 1000, 100).astype(np.uint64)
    for width in (1, 2, 3, 7, 16, 100):
        expected = [values[i : i + width].min() for i in range(len(values) - width + 1)]
        assert suffixes.smallest(values, width).tolist() == expected
    data = np.frombuffer(b"abcabcabcab" * 9, np.uint8)
    for gram in (1, 2, 5, 12):
        hashes = suffixes.gram_hashes(data, gram).tolist()
        strings = [data[i : i + gram].tobytes() for i in range(len(data) - gram + 1)]
        assert len(set(hashes)) == len(set(strings)) == len(set(zip(hashes, strings, strict=True)))


def by_hand(texts, length):
    """``n_bytes, n_removed, n_spans, sha`` per text by counting every string of ``length`` bytes."""
    count = Counter(t[p : p + length] for t in texts for p in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if count[t[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        kept = bytes(x for x, g in zip(t, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out.append((len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("length, gram, block_rows, piece", [(40, 12, 512, 1 << 18), (40, 12, 2, 64), (9, 4, 3, 100)])
def test_removal_by_brute_force(spark, monkeypatch, length, gram, block_rows, piece):
    monkeypatch.setattr(suffixes, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(suffixes, "PIECE", piece)
    rng = random.Random(length)

    def prose(n):
        return " ".join(rng.choice(["ab", "cde", "fghi", "é", "日本"]) + rng.choice("xyz") for _ in range(n))

    passages = [prose(20) for _ in range(3)]
    texts = [prose(rng.randint(0, 40)) + "".join(rng.choice([*passages, "|"]) for _ in range(rng.randint(0, 3))) + prose(10) for _ in range(40)]
    texts += ["ab" * 300, "z" * length, "z" * (length - 1), "", None, texts[0], texts[0], "q" * (length + 5)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.without_repeats(frame, length, gram).collect()}
    expected = by_hand([(t or "").encode() for t in texts], length)
    assert [rows[i] for i in range(len(texts))] == expected
    assert sum(n for _, n, _, _ in expected) > 1000


def test_odd_rows(spark):
    long = "abcdefgh" * 80 + "end"
    frame = spark.createDataFrame([(None, None, 1), (None, long, 2), (3, long, 3), (3, long, 3), (4, "short", 5)], "doc_id long, text string, k1 int")
    rows = sorted((r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans) for r in suffixes.without_repeats(frame).collect())
    assert rows == [(0, 0, 0, 0), (0, 643, 643, 1), (3, 643, 643, 1), (3, 643, 643, 1), (4, 5, 0, 0)]
    once = suffixes.without_repeats(frame.where("k1 = 2")).first()
    assert (once.n_removed, once.n_spans, [tuple(s) for s in once.spans]) == (640, 1, [(0, 640)])
    assert suffixes.without_repeats(frame.limit(0)).count() == 0
