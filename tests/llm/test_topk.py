import random

import numpy as np
import pytest

from riskwindow.llm import topk


@pytest.fixture
def vectors(spark):
    def build(rows):
        return spark.createDataFrame(
            [(i, v, 0, "x", "y") for i, v in rows],
            "vec_id long, embedding array<float>, label int, v string, region string",
        )

    return build


def plain(rows, k=20, every=20):
    good = [
        (i, tuple(int(np.floor(64 * float(np.float32(x)))) for x in v))
        for i, v in rows
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for a, (i, q) in enumerate(good):
        if i % every:
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(q, v)), j) for b, (j, v) in enumerate(good) if a != b and len(v) == len(q)
        )
        out += [(i, r, j, -s) for r, (s, j) in enumerate(scored[:k], 1)]
    return sorted(out)


def found(frame, **options):
    return sorted(tuple(r) for r in topk.top_k(frame, **options).collect())


def test_equals_brute_force(vectors):
    draw = np.random.default_rng(2)
    rows = [(i, draw.normal(0, 0.2, 8).tolist()) for i in range(400)]
    rows += [(400 + i, rows[7][1]) for i in range(60)]  # many alike
    assert found(vectors(rows)) == plain(rows)


def test_many_small_shards_and_groups(vectors, monkeypatch):
    monkeypatch.setattr(topk, "SHARD", 16)
    monkeypatch.setattr(topk, "SAMPLE", 64)
    monkeypatch.setattr(topk, "REGION", 16)
    monkeypatch.setattr(topk, "GROUP", 4)
    draw = np.random.default_rng(3)
    rows = [(i, (draw.integers(-3, 4, 3) / 64).tolist()) for i in range(300)]
    assert found(vectors(rows), every=5) == plain(rows, every=5)


def test_odd_rows(vectors):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [0.5, 0.5]), (20, [1.0, 2.0]), (3, None), (4, [1.0, None]), (5, [nan, 1.0]),
        (40, [inf, 1.0]), (None, [1.0, 1.0]), (60, [1.0, 2.0, 3.0]), (61, [0.0, 1.0, 0.0]), (80, []), (81, []), (100, [9.0]),
        (7, [-1.0, 0.01]),
    ]
    assert found(vectors(rows)) == plain(rows)


def test_copies_fill_the_places(vectors):
    rows = [(1, [1.0])] * 30 + [(2, [2.0]), (20, [1.0]), (3, [0.5])]
    assert found(vectors(rows)) == plain(rows)


def test_no_rows(vectors):
    assert found(vectors([])) == [] == found(vectors([(20, None)]))
    assert found(vectors([(20, [1.0])])) == []


def test_boxes_hold_and_bound_their_points():
    draw = random.Random(5)
    points = np.array([[draw.randrange(-9, 9) for _ in range(4)] for _ in range(200)])
    tree = topk.Tree(points, 8)
    ordered = points[tree.order]
    assert sorted(tree.order.tolist()) == list(range(200))
    reach = topk.bounds(points[:10], tree.low, tree.high)
    for node, (lo, hi) in enumerate(tree.range):
        assert (ordered[lo:hi].min(axis=0) == tree.low[node]).all() and (ordered[lo:hi].max(axis=0) == tree.high[node]).all()
        assert (points[:10] @ ordered[lo:hi].T <= reach[:, node, None]).all()
    leaves = {n for n, c in enumerate(tree.child) if not c}
    assert set(tree.regions(points).tolist()) == leaves


def test_large_numbers_stay_exact():
    points = np.array([[2**30, 1], [2**30, 2], [2**30, 3]])
    tree = topk.Tree(points, 1)
    ids = np.arange(3)[tree.order]
    best = topk.search(tree, ids, points[tree.order], points[:1], np.array([-np.inf]), np.array([-1]), 2)[0]
    assert [s for s, _ in best] == [2**60 + 3, 2**60 + 2]


def test_a_shard_goes_to_the_teams_that_enter_it_only(spark):
    shards = spark.createDataFrame([(2, r, p, f"s{r}{p}") for r in range(3) for p in range(2)], "length long, region long, part long, shard string")
    loads = spark.createDataFrame(
        [(2, 0, 0, 5, "q"), (2, 0, 0, 5, "q2"), (2, 0, 0, 6, "q3"), (2, 1, 1, 5, "q")],
        "length long, region long, part long, team long, load string",
    )
    found = topk.entered(shards, loads)
    assert sorted((r.shard, r.team) for r in found.collect()) == [("s00", 5), ("s00", 6), ("s11", 5)]
