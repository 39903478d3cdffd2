"""Hard negatives against brute force, and the cover tree against its invariants."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewlens.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, rank int, forest string, x int"


def by_hand(rows, positives=5, negatives=10, low=30, high=90, every=100):
    kept = {}
    for i, vector, label in rows:
        if i is None or label is None or vector is None or any(v is None or not math.isfinite(v) for v in vector):
            continue
        one = ((label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * v) for v in vector])
        kept[i] = min(kept.get(i, one), one)
    out = []
    for a in (i for i in kept if i % every == 0):
        score = {i: sum(p * q for p, q in zip(kept[a][1], kept[i][1])) for i in kept if i != a}
        ranked = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in ranked if kept[i][0] == kept[a][0]][:positives]:
            inside = [i for i in ranked if kept[i][0] != kept[a][0] and low * score[p] <= 100 * score[i] <= high * score[p]]
            out += [(a, p, n, i, score[p], score[i]) for n, i in enumerate(inside[:negatives], 1)]
    return sorted(out)


def found(df, **settings):
    return sorted(tuple(r) for r in hn.hard_negatives(df, **settings).collect())


def made(n, size, seed, spread):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(6, size))
    return [(i, (centres[draw.integers(6)] + spread * draw.normal(size=size)).astype(np.float32).tolist(), int(draw.integers(4))) for i in range(n)]


@pytest.mark.parametrize("spread", [0.0, 0.05, 1.0])
def test_cover_tree(spread):
    vectors = np.array([v for _, v, _ in made(600, 5, 1, spread)])
    vectors = hn.augmented(vectors, (vectors**2).sum(1).max())
    assert np.allclose((vectors**2).sum(1), (vectors**2).sum(1).max())
    order, nodes = hn.grow(vectors)
    assert sorted(order.tolist()) == list(range(600))
    for n, (level, start, own, end, centre, radius) in enumerate(nodes.tolist()):
        below = vectors[order[int(start) : int(end)]]
        far = np.sqrt(((below - vectors[order[int(centre)]]) ** 2).sum(1))
        assert abs(far.max() - radius) < 1e-9 and start <= own <= end
        children = [m for m in nodes[n + 1 :].tolist() if m[0] == level + 1 and start <= m[1] < end]
        assert own + sum(m[3] - m[1] for m in children) - start == end - start - (0 if children else end - own)
        if children:
            assert any(m[4] == centre for m in children) or centre < own
            assert all(m[5] <= radius / hn.BASE + 1e-9 for m in children)
            heads = vectors[order[[int(m[4]) for m in children]]]
            gaps = np.sqrt(((heads[:, None] - heads[None]) ** 2).sum(2)) + np.eye(len(heads)) * 1e9
            assert gaps.min() > radius / hn.BASE - 1e-9


@pytest.mark.parametrize("seed, spread, size", [(1, 0.02, 3), (2, 0.3, 8), (3, 1.5, 16)])
def test_search_skips_nothing(seed, spread, size):
    rows = made(900, size, seed, spread)
    vectors = np.floor(256 * np.array([v for _, v, _ in rows]))
    square = float((vectors**2).sum(1).max())
    order, nodes = hn.grow(hn.augmented(vectors, square))
    ids = np.array([i for i, _, _ in rows])[order]
    forest = hn.Forest(ids, np.zeros(900, np.int64), vectors[order], nodes, square)
    draw = np.random.default_rng(seed)
    for _ in range(40):
        anchor = vectors[draw.integers(900)]
        scores = forest.vectors @ anchor
        edges = np.sort(draw.choice(scores, (3, 2)), axis=1)
        for (got, at), (low, high) in zip(forest.search(anchor, forest.roots, edges[:, 0], edges[:, 1], 7, None), edges):
            want = sorted((-s, i) for s, i in zip(scores, ids) if low <= s <= high)[:7]
            assert [(-s, i) for s, i in zip(got, ids[at])] == want


@pytest.mark.parametrize("rows_a_forest, per_block, spread", [(8192, 4096, 0.4), (100, 3, 0.05)])
def test_equals_brute_force(spark, monkeypatch, rows_a_forest, per_block, spread):
    """Also over several regions, forests and blocks of anchors."""
    monkeypatch.setattr(hn, "FOREST_ROWS", rows_a_forest)
    monkeypatch.setattr(hn, "BLOCK_ANCHORS", per_block)
    rows = made(1200, 6, 7, spread)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)
    assert found(df) == by_hand(rows) and len(by_hand(rows)) > 200
    few = dict(positives=2, negatives=3, low=10, high=70)
    assert found(df, is_anchor=F.col("vec_id") % 150 == 0, **few) == by_hand(rows, **few, every=150)


def test_odd_tables(spark):
    draw = random.Random(3)
    rows = [(i, [float(draw.randint(-2, 2)) for _ in range(3)], draw.randint(0, 2)) for i in range(400)]
    rows += [(100, [9.0, 1.0, 1.0], 5), (7, None, 1), (None, [1.0, 1.0, 1.0], 1), (800, [1.0, None, 1.0], 1), (801, [1.0, math.nan, 1.0], 1)]
    rows += [(802, [math.inf, 1.0, 1.0], 1), (803, [1.0, 1.0, 1.0], None), (900, [], 1), (901, [2.0], 1), (1000, [2.0, 2.0], 2), (1000, [2.0, 2.0], 2)]
    rows += [(2000 + i, [1.0, 2.0, 1.0], 1) for i in range(300)]  # copies: ties by id
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)
    padded = [(i, v + [0.0] * (3 - len(v)) if v is not None and len(v) < 3 else v, n) for i, v, n in rows]
    assert found(df) == by_hand(padded) != []
    assert found(df.limit(0)) == []
    assert found(df.where("vec_id % 100 <> 0")) == []
