from __future__ import annotations

import random

from threatsieve.llm import spans


def by_hand(rows, span):
    """Kept text per row, from units alone: all occurrences of a run but the first lose it."""
    seen, gone = {}, {}
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0))
    for k in order:
        own = [w for _, _, w in spans.units(rows[k][1] or "")]
        for i in range(len(own) - span + 1):
            seen.setdefault(" ".join(own[i : i + span]), []).append((rows[k][0], i, k))
    for found in seen.values():
        for doc_id, i, k in found:
            if (doc_id, i) != found[0][:2]:
                gone.setdefault(k, set()).update(range(i, i + span))
    return [
        None if text is None else "".join(text[a:b] for i, (a, b, _) in enumerate(spans.units(text)) if i not in gone.get(k, ()))
        for k, (_, text) in enumerate(rows)
    ]


def prose(rng, sentences):
    words = [a + b + c for a in "bcdfg" for b in "aeiou" for c in ("n", "rt", "s")]
    return " ".join(
        " ".join(rng.choice(words) for _ in range(rng.choice([1, 2, 6, 12, 30]))).capitalize() + rng.choice([". ", "! ", ".\n"]).strip()
        for _ in range(sentences)
    )


def test_units_cover_the_text():
    rng = random.Random(1)
    for text in ["", "a", "  \n ", "One. Two. Three four five six.", "x " * 500, prose(rng, 60), "a.b.c. d"]:
        own = spans.units(text)
        assert "".join(text[a:b] for a, b, _ in own) == text
        assert " ".join(" ".join(w.split()) for _, _, w in own).split() == text.lower().split()


def test_passages_by_brute_force(spark):
    rng = random.Random(4)
    passage = prose(rng, 12)
    rows = [(k, prose(rng, 6) + " " + (passage + " " if k % 3 == 0 else "") + prose(rng, 6)) for k in range(30)]
    rows += [(50, rows[2][1]), (51, rows[2][1]), (60, passage * 2), (None, passage), (None, None), (61, ""), (2, rows[2][1])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for span in (2, 3):
        found = sorted((r.doc_id or -1, r.text or "") for r in spans.without_repeats(frame, span).collect())
        assert found == sorted((i or -1, t or "") for (i, _), t in zip(rows, by_hand(rows, span), strict=True))
    kept = {r.doc_id: r.text for r in spans.without_repeats(frame).collect()}
    assert kept[51] == kept[50] == ""
    assert kept[4] == dict(rows)[4]
    assert len(kept[3].split()) < len(dict(rows)[3].split()) - 50


def test_passages_inside_sentences(spark):
    """Passages of 51 to 60 words that begin and end anywhere in long sentences: nearly all are found, and nothing else goes."""
    rng = random.Random(7)
    vocabulary = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(5000)]

    def words(n, left, low, high):
        out = []
        for _ in range(n):
            left -= 1
            out.append(rng.choice(vocabulary) + ("." if left <= 0 else ""))
            left = rng.randint(low, high) if left <= 0 else left
        return out

    rows, passages = [], {}
    for k in range(400):
        low, high = rng.choice([(8, 20), (20, 30)])
        passage = words(rng.randint(51, 60), rng.randint(1, high), low, high)
        for side in range(2):
            before, after = words(70 + rng.randint(0, high), high, low, high), words(70, rng.randint(1, high), low, high)
            rows.append((2 * k + side, " ".join([*before, *passage, *after])))
        passages[2 * k + 1] = (len(before), len(before) + len(passage))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id: r.text.split() for r in spans.without_repeats(frame).collect()}
    missed = covered = 0
    for doc_id, text in rows:
        own = text.split()
        if doc_id % 2 == 0:
            assert kept[doc_id] == own  # the first occurrence stays
            continue
        begin, end = passages[doc_id]
        gone = len(own) - len(kept[doc_id])
        # One run of words went, from within the passage: what is left is the text around it.
        head = next((i for i, (a, b) in enumerate(zip(own, kept[doc_id], strict=False)) if a != b), len(kept[doc_id]))
        assert gone == 0 or (own[:head] + own[head + gone :] == kept[doc_id] and begin - 1 <= head and head + gone <= end + 1)
        missed += gone == 0
        covered += gone
    assert missed <= 0.005 * len(passages)
    assert covered > 0.75 * sum(e - b for b, e in passages.values())


def test_odd_rows(spark):
    frame = spark.createDataFrame([(None, None, 1), (1, "", 2)], "doc_id long, text string, place int")
    assert sorted((r.doc_id or 0, r.text, r.n_removed) for r in spans.without_repeats(frame).collect()) == [(0, None, 0), (1, "", 0)]
    assert spans.without_repeats(frame.limit(0)).count() == 0
