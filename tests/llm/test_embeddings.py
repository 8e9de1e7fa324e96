from __future__ import annotations

import math

import numpy as np
import pytest

from threatsieve.llm import embeddings


def by_hand(rows, threshold=0.9):
    """``links, component`` per row, over all pairs in double precision."""
    usable = {
        k: np.array(v, float) for k, (_, v) in enumerate(rows)
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    }
    links, component = {k: 0 for k in range(len(rows))}, {k: rows[k][0] for k in range(len(rows))}
    near = [
        (a, b) for a in usable for b in usable
        if a != b and len(usable[a]) == len(usable[b])
        and usable[a] @ usable[b] / (np.linalg.norm(usable[a]) * np.linalg.norm(usable[b])) >= threshold
    ]
    for a, _ in near:
        links[a] += 1
    for _ in rows:
        for a, b in near:
            component[a] = min(component[a], component[b])
    return links, component


def clustered(seed, n, width, clusters=8, noise=0.35):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, width))
    vectors = centres[rng.integers(0, clusters, n)] + noise * rng.normal(size=(n, width)) * rng.random((n, 1))
    return [[float(np.float32(x)) for x in v] for v in vectors]


@pytest.mark.parametrize(
    "kind, block_rows, width, pivots", [("float", 10_000, 8, 512), ("float", 40, 8, 512), ("double", 25, 70, 2), ("float", 40, 1300, 512)]
)
def test_links_by_brute_force(spark, monkeypatch, kind, block_rows, width, pivots):
    monkeypatch.setattr(embeddings, "MAX_PIVOTS", pivots)
    vectors = clustered(width, 160, width)
    vectors += [vectors[3]] * 5 + [[2 * x for x in vectors[4]], [0.0] * width, [-x for x in vectors[5]], vectors[6][:-1]]
    rows = list(enumerate(vectors))
    frame = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    links, component = by_hand(rows)
    found = {r.vec_id: r for r in embeddings.near_duplicates(frame, block_rows=block_rows).collect()}
    assert {k: r.n_links for k, r in found.items()} == links
    assert {k: r.component_id for k, r in found.items()} == component
    assert all(r.kept == (r.vec_id == r.component_id) for r in found.values())
    assert sum(links.values()) > 100


def test_bounds_hold(spark):
    """The quantised product is never further off than its bound."""
    rng = np.random.default_rng(5)
    block = embeddings.Block(rng.normal(size=(200, 40)) * rng.random((200, 40)) ** 6, np.ones(200, int))
    unit = block.raw / block.norm[:, None]
    about = embeddings.integer_products(block.small, block.small) * block.step[:, None] * block.step[None, :]
    dx, dy = block.error[:, None], block.error[None, :]
    assert (np.abs(unit @ unit.T - about) <= dx + (1 + dx) * dy + 1e-12).all()


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0, 0.0]), (7, [1.0, 0.0]),
        (None, [1.0, 0.1]), (8, [1e-30, 1e-31]), (9, [0.0, 1.0]),
    ]
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, node string")
    found = sorted((r.vec_id or 0, r.n_links, r.component_id) for r in embeddings.near_duplicates(frame).collect())
    assert found == [
        (0, 3, 7), (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 0, 4), (5, 0, 5), (6, 0, 6), (7, 3, 7), (7, 3, 7), (8, 3, 7), (9, 0, 9),
    ]
    assert embeddings.near_duplicates(frame.limit(0)).count() == 0
