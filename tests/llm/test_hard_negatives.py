"""Operator 11 against plain integer scores."""

from __future__ import annotations

import math

import numpy as np
import pytest

from forgeline.llm import hard_negatives as H

COLUMNS = "vec_id bigint, embedding array<double>, label int"


def plain(rows: list[tuple], asked, scale: int = 256) -> list[tuple]:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score); no two rows share an id and a score."""
    taking = [(i, [math.floor(scale * x) for x in v], label) for i, v, label in rows
              if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (i, v, label) in enumerate(taking):
        if not asked(i):
            continue
        scored = sorted(((-sum(a * b for a, b in zip(v, w)), j, k) for p, (j, w, k) in enumerate(taking) if p != at), key=lambda r: r[:2])
        for s, j, _ in [r for r in scored if r[2] == label][:5]:
            near = [(t, n) for t, n, k in scored if k != label and 80 * -s <= 100 * -t <= 100 * -s][:5]
            out += [(i, j, rank, n, -s, -t) for rank, (t, n) in enumerate(near, 1)]
    return sorted(out)


def found(spark, rows, anchor="vec_id % 100 = 0", **options) -> list[tuple]:
    df = spark.createDataFrame(rows, COLUMNS).repartition(3).selectExpr("*", "1 as id", "2 as row", "3 as q", "4 as cell", "5 as score")
    return sorted(map(tuple, H.mined(df, anchor, **options).collect()))


def vectors(n: int, dim: int, seed: int, spread: float) -> list[tuple]:
    """Rows around a few centres, norms from small to large."""
    r = np.random.default_rng(seed)
    centres = r.normal(size=(6, dim))
    v = (centres[r.integers(0, 6, n)] + spread * r.normal(size=(n, dim))) * r.uniform(0.1, 3, (n, 1))
    return [(i, x.tolist(), int(k)) for i, (x, k) in enumerate(zip(v, r.integers(0, 4, n)))]


@pytest.mark.parametrize("spread", [0.05, 0.6, 5.0])
def test_equals_plain_scores(spark, spread):
    rows = vectors(900, 16, 3, spread)
    assert found(spark, rows) == plain(rows, lambda i: i % 100 == 0)


@pytest.mark.parametrize("block_bytes,block_anchors,tile", [(4_000, 3, (2, 16)), (1 << 20, 2, (256, 4096))])
def test_any_grid_gives_the_same(spark, monkeypatch, block_bytes, block_anchors, tile):
    rows = vectors(400, 8, 5, 0.3)
    want = plain(rows, lambda i: i % 20 == 0)
    monkeypatch.setattr(H, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(H, "BLOCK_ANCHORS", block_anchors)
    monkeypatch.setattr(H, "_TILE", tile)
    assert found(spark, rows, "vec_id % 20 = 0") == want


def test_equal_vectors_and_ties_by_id(spark):
    rows = [(i, [1.0, 2.0, 0.5], i % 3) for i in range(300)] + [(1000 + i, [0.9, 2.0, 0.5], i % 3) for i in range(60)]
    got = found(spark, rows)
    assert got == plain(rows, lambda i: i % 100 == 0)
    assert [r[3] for r in got if r[:2] == (0, 3)] == [1, 2, 4, 5, 7]


def test_odd_rows(spark):
    """Nulls, infinities, empty and short vectors, zeros, huge numbers, negative scores."""
    nan, inf = float("nan"), float("inf")
    rows = vectors(120, 4, 9, 1.0) + [
        (200, None, 1), (300, [1.0, nan], 1), (400, [1.0, None], 1), (500, [inf, 1.0], 1), (600, [1.0], None), (None, [1.0, 2.0], 1),
        (700, [], 1), (800, [0.0, 0.0, 0.0, 0.0], 2), (801, [1.5, 2.5], 2), (900, [-3.0, -3.0, -3.0, -3.0], 3), (901, [3.0, 3.0, 3.0, 3.0], 3),
        (1000, [2.0] * 4, 9), (1100, [2.0**21, 3.0**9], 0), (1101, [2.0**20, 2.0**19 + 0.3], 0), (1102, [2.0**20, 1.0], 1)]
    assert found(spark, rows) == plain(rows, lambda i: i % 100 == 0)
    far = [(0, [1e300, 0.0], 1), (1, [1e300, 0.0], 1), (2, [1e299, 0.0], 2)]  # beyond a long: its end
    assert found(spark, far) == [(0, 1, 1, 2, 2**63 - 1, 2**63 - 1)]


def test_repeated_rows_and_empty_tables(spark):
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (1, [0.9, 0.0], 2)]
    assert found(spark, rows) == [(0, 0, 1, 1, 65_536, 58_880)] * 2
    assert found(spark, []) == [] and found(spark, [(1, [1.0], 1)]) == [] and found(spark, [(0, [1.0], 1)]) == []


def test_bounds_hold_and_skip():
    rows = vectors(500, 12, 11, 0.1)
    q = H._whole(np.array([v for _, v, _ in rows]), 256)
    chosen = H.references(q.astype(float))
    norm = np.linalg.norm(q, axis=1)
    angles = np.arccos(np.clip(q @ chosen.T / norm[:, None], -1, 1))
    ids = np.arange(500)
    block = H.Block(ids, ids, ids, q, norm, angles)
    low, high = H.bounds(block, block)
    exact = q @ q.T
    assert (low <= exact).all() and (exact <= high).all()
    # around few centres, most pairs are known to be far below the best ones
    assert (high >= 0.8 * norm[:, None] * norm).mean() < 0.5
