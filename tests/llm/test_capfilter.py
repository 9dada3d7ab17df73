import math

import numpy as np
import pytest

from riskwindow.llm import capfilter

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute_force(rows, similarity=0.98):
    """vec_id, n_links, component_id, kept by all pairs; no code shared with the operator."""

    def takes_part(row):
        i, v, label = row
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            return False
        return any(v)

    def cosine(a, b):
        a, b = np.array(a, np.float32).astype(float), np.array(b, np.float32).astype(float)
        return a @ b / math.sqrt(a @ a) / math.sqrt(b @ b)

    n = len(rows)
    links = [set() for _ in rows]
    for i in range(n):
        for j in range(i):
            a, b = rows[i], rows[j]
            if takes_part(a) and takes_part(b) and a[2] == b[2] and len(a[1]) == len(b[1]):
                if a[1] == b[1] or cosine(a[1], b[1]) >= similarity:
                    links[i].add(j)
                    links[j].add(i)
    out = []
    for i in range(n):
        seen, front = {i}, [i]
        while front:
            front = [k for f in front for k in links[f] if k not in seen]
            seen |= set(front)
        least = min((rows[k][0] for k in seen if rows[k][0] is not None), default=None)
        out.append((rows[i][0], len(links[i]), least, rows[i][0] == least))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect()), key=str)


def planted(dim, groups, size, noise, seed=1):
    """Groups around random centres, so close that all of a group are well above the similarity, and strangers."""
    draw = np.random.default_rng(seed)
    vectors = []
    for _ in range(groups):
        centre = draw.standard_normal(dim)
        centre /= np.linalg.norm(centre)
        for _ in range(size):
            v = centre + draw.standard_normal(dim) * noise / math.sqrt(dim)
            vectors.append((v * draw.uniform(0.1, 9)).astype(np.float32).tolist())
    vectors += draw.standard_normal((100, dim)).astype(np.float32).tolist()
    draw.shuffle(vectors)
    return [(1000 - i, v, int(draw.integers(2))) for i, v in enumerate(vectors)]


@pytest.mark.parametrize("dim", [1, 2, 3, 8, 64])
def test_equals_brute_force(spark, dim):
    rows = planted(dim, 12, 8, 0.03)
    df = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(capfilter.near_duplicates(df)) == brute_force(rows)


def test_large_group_in_small_blocks(spark, monkeypatch):
    """One group of most rows, blocks of a few rows, batches that end inside groups."""
    rows = [(i, v, 1) for i, v, _ in planted(16, 1, 150, 0.02)]
    df = spark.createDataFrame(rows, SCHEMA)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        found = rows_of(capfilter.near_duplicates(df, block=8))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found == brute_force(rows)
    assert sum(n >= 149 for _, n, _, _ in found) == 150


def test_chain_reaches_the_smallest(spark):
    """Neighbours in a chain are linked, its ends are not; one component."""
    rows = [(50 - i, [math.cos(0.15 * i), math.sin(0.15 * i)], 3) for i in range(12)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = rows_of(capfilter.near_duplicates(df))
    assert found == brute_force(rows)
    assert {c for _, _, c, _ in found} == {39}


def test_rows_that_take_no_part_and_copies(spark):
    nan, inf = float("nan"), float("inf")
    v = [1.0, 2.0, 3.0]
    rows = [
        (1, None, 1), (2, [], 1), (3, [0.0, 0.0, 0.0], 1), (4, [1.0, None, 3.0], 1), (5, [1.0, nan, 3.0], 1),
        (6, [inf, 2.0, 3.0], 1), (7, v, None), (8, v, None), (9, v, 1), (9, v, 1), (10, v, 1), (11, v, 2),
        (12, [2.0, 4.0, 6.0], 1), (13, [-1.0, -2.0, -3.0], 1), (14, [1.0, 2.0], 1), (15, [1e-42, 0.0, 0.0], 1),
        (16, [3e38, 0.0, 0.0], 1), (17, [-0.0, 0.0, 5.0], 1), (18, [0.0, -0.0, 5.0], 1),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(capfilter.near_duplicates(df)) == brute_force(rows)
    unnamed = spark.createDataFrame([(None, v, 1), (None, v, 1), (3, v, 1)], SCHEMA)
    assert rows_of(capfilter.near_duplicates(unnamed)) == [(3, 0, 3, True), (None, 0, None, True), (None, 0, None, True)]


def test_clashing_columns_and_no_rows(spark):
    rows = planted(4, 3, 5, 0.02)
    df = spark.createDataFrame(rows, SCHEMA)
    wide = df.selectExpr("*", *[f"'x' AS {c}" for c in ("rep", "code", "copies", "filters", "links", "node", "root", "kept")])
    assert rows_of(capfilter.near_duplicates(wide)) == brute_force(rows)
    assert capfilter.near_duplicates(df.limit(0)).count() == 0
    named = df.selectExpr("vec_id", "CAST(embedding AS ARRAY<DOUBLE>) AS embedding", "concat('l', label) AS label")
    assert rows_of(capfilter.near_duplicates(named)) == brute_force(rows)


@pytest.mark.parametrize("dim,filters", [(2, 5000), (8, 20_000), (64, 640_000), (64, 10**8), (300, 10**6)])
def test_recall_of_pairs_that_are_just_similar_enough(dim, filters):
    """Pairs at a cosine of 0.98, the hardest ones: at least 99 % share a filter."""
    draw = np.random.default_rng(5)
    made = capfilter.code(dim, filters)
    a = capfilter.unit(draw.standard_normal((300, dim)))
    aside = draw.standard_normal((300, dim))
    aside = capfilter.unit(aside - (aside * a).sum(axis=1, keepdims=True) * a)
    b = 0.98 * a + math.sqrt(1 - 0.98**2) * aside
    met = [len(np.intersect1d(x, y)) > 0 for x, y in zip(capfilter.lists(a, made), capfilter.lists(b, made))]
    assert np.mean(met) >= 0.99


def test_lists_hold_every_filter_that_is_exceeded():
    made = capfilter.code(12, 3000)
    draw = np.random.default_rng(2)
    x = capfilter.unit(draw.standard_normal((20, 12)))
    turned = x @ made.turn
    size = len(made.words[0])
    for row, found in zip(turned, capfilter.lists(x, made)):
        total = np.zeros(1)
        for a, b, w in zip(made.cuts[:-1], made.cuts[1:], made.words):
            total = (total[:, None] + (w @ row[a:b])[None, :]).ravel()
        least = min(made.height, total.max() - made.slack)
        sure = np.flatnonzero(total >= least + 1e-9)
        assert set(sure) <= set(found.tolist()) <= set(np.flatnonzero(total >= least - 1e-9).tolist())
        assert len(total) == size ** len(made.words)
