import collections

import pytest
from frames import executed_plan, sample_rows, table
from hypothesis import given
from hypothesis import strategies as st

from riskwindow import schema as S
from riskwindow.operators import split


def _sides(df):
    return collections.Counter((r.incident, r.split) for r in df.collect())


def test_sizes_round_the_test_side_up():
    assert split.test_sizes({0: 112, 1: 4}) == {0: 23, 1: 1}
    assert split.test_sizes({0: 10, 1: 10}) == {0: 2, 1: 2}


def test_remainder_ties_go_to_the_smaller_label():
    # 13 of 17 rows train, 3.82 of each five and 5.35 of seven: the fives are filled up.
    assert split.test_sizes({0: 5, 1: 5, 2: 7}) == {0: 1, 1: 1, 2: 2}
    # 14 of 18 rows train, 4.67 of each six: only two of the three can be filled up.
    assert split.test_sizes({0: 6, 1: 6, 2: 6}) == {0: 1, 1: 1, 2: 2}


@given(st.lists(st.integers(2, 500), min_size=2, max_size=5))
def test_sizes_add_up(counts):
    counts = dict(enumerate(counts))
    total = sum(counts.values())
    wanted = -(-total // 5)
    if wanted < len(counts):
        with pytest.raises(ValueError):
            split.test_sizes(counts)
        return
    sizes = split.test_sizes(counts)
    assert sum(sizes.values()) == wanted
    assert all(abs(sizes[c] - 0.2 * n) < 1.2 for c, n in counts.items())


@pytest.mark.parametrize("counts", [{0: 50, 1: 1}, {0: 2, 1: 2, 2: 2}])
def test_impossible_splits(counts):
    with pytest.raises(ValueError):
        split.test_sizes(counts)


def test_split_is_exact_complete_and_disjoint(sample):
    parts = split.stratified_split(sample)
    assert _sides(parts) == {(0, "train"): 144, (0, "test"): 36, (1, "train"): 16, (1, "test"): 4}
    assert sorted(tuple(r)[:6] for r in parts.collect()) == sorted(sample_rows())


def test_split_ignores_the_partitioning(sample):
    first = split.stratified_split(sample)
    second = split.stratified_split(sample.repartition(7))
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, second.collect()))
    other = split.stratified_split(sample, seed=7)
    assert sorted(map(tuple, first.collect())) != sorted(map(tuple, other.collect()))


def test_copies_of_one_row_are_shared_out(make):
    rows = [("hot", "240101_00", 1, 1, 1, 0)] * 600 + sample_rows()
    parts = split.stratified_split(make(rows))
    assert _sides(parts)[0, "test"] + _sides(parts)[1, "test"] == 160
    assert sorted(tuple(r)[:6] for r in parts.collect()) == sorted(rows)


def test_only_copies(make):
    rows = [("hot", "240101_00", 1, 1, 1, 0)] * 90 + [("hot", "240101_00", 1, 1, 1, 1)] * 10
    assert _sides(split.stratified_split(make(rows))) == {
        (0, "train"): 72, (0, "test"): 18, (1, "train"): 8, (1, "test"): 2,
    }


def test_many_copies_are_spread(spark):
    one = spark.createDataFrame([("a", 250_001)], "name string, n bigint")
    repeated = split._repeat(one, "n")
    assert repeated.columns == ["name"] and repeated.count() == 250_001


def test_null_in_rows_is_kept(make):
    rows = [*sample_rows(), (None, None, None, None, None, 0)]
    parts = split.stratified_split(make(rows))
    assert parts.count() == 201 and parts.filter("component IS NULL").count() == 1


def test_missing_label_is_refused(make):
    with pytest.raises(ValueError, match="missing"):
        split.stratified_split(make([("a", "x", 1, 1, 1, None), ("a", "y", 1, 1, 1, 0)]))
    with pytest.raises(ValueError, match="no rows"):
        split.stratified_split(make([]))


def test_many_classes(make):
    rows = [(f"c{i}", f"240101_{i:02d}", j, 1, 1, i) for i in range(20) for j in range(10 + i)]
    found = _sides(split.stratified_split(make(rows)))
    sizes = split.test_sizes({i: 10 + i for i in range(20)})
    assert {i: found[i, "test"] for i in range(20)} == sizes
    assert sum(found.values()) == len(rows)


def test_one_row_per_class_reaches_the_driver(sample, monkeypatch):
    collected = []
    frame = type(sample)
    whole = frame.collect
    monkeypatch.setattr(frame, "collect", lambda self: collected.append(rows := whole(self)) or rows)
    split.stratified_split(sample)
    assert [len(rows) for rows in collected] == [2, 2]


def test_decided_rows_do_not_shuffle(sample):
    plan = executed_plan(split.stratified_split(sample))
    decided = plan[plan.index("Union") :].split("\n")[1:4]
    assert all("Exchange" not in line for line in decided)
    assert "Python" not in plan


@pytest.mark.parametrize("ordered", [1, 3, 20])
def test_boundary_is_narrowed_until_few_rows_are_ordered(make, monkeypatch, ordered):
    """By single digits: the same sides as without narrowing, and few rows left to put in order."""
    rows = sample_rows(400, 40) + [("hot", "240101_00", 1, 1, 1, 0)] * 150
    expected = sorted(map(tuple, split.stratified_split(make(rows)).collect()))
    monkeypatch.setattr(split, "_PREFIX_DIGITS", 1)
    monkeypatch.setattr(split, "ORDERED", ordered)
    df = make(rows)
    assert sorted(map(tuple, split.stratified_split(df).collect())) == expected
    hashed = df.selectExpr("*", f"{split.row_hash(df)} AS _hash")
    boundary, missing, digits = split._boundaries(hashed, S.INCIDENT, S.TEST_SHARE)
    for label, edge in boundary.items():
        inside = hashed.filter(f"incident = {label} AND substr(_hash, 1, {digits}) = '{edge}'")
        assert inside.select("_hash").distinct().count() <= max(ordered, 1)
        assert 0 <= missing[label] <= inside.count()


def test_only_copies_need_no_narrowing(make, monkeypatch):
    monkeypatch.setattr(split, "ORDERED", 1)
    df = make([("hot", "240101_00", 1, 1, 1, 0)] * 90 + [("hot", "240101_00", 1, 1, 1, 1)] * 10)
    hashed = df.selectExpr("*", f"{split.row_hash(df)} AS _hash")
    assert split._boundaries(hashed, S.INCIDENT, 0.2)[2] == split._PREFIX_DIGITS


def test_random_split(sample):
    train, test = split.random_split(sample)
    assert train.count() + test.count() == 200
    assert train.intersect(test).isEmpty()


def test_class_weights(make, sample):
    weighted = split.with_class_weight(sample, split.label_counts(sample))
    rows = table(weighted.select("incident", "weight").distinct(), "incident")
    assert [r["weight"] for r in rows] == [200 / (2 * 180), 200 / (2 * 20)]
    assert weighted.selectExpr("sum(weight)").first()[0] == pytest.approx(200)
    one = make([("a", "x", 1, 1, 1, 1)] * 3)
    assert split.with_class_weight(one, split.label_counts(one)).first().weight == 1.0
