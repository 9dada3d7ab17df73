import pytest
from frames import executed_plan, table

from riskwindow import schema as S
from riskwindow.operators.features import engineer_features, with_date_hour

ROWS = [
    ("a", "240101_00", 5, 20, 0, 0),
    ("b", "240101_01", 6, 21, None, 1),
    ("c", "240101_23", None, 9, -1, 0),
    ("d", "240102_07", 2, 9, 2, 0),
]


@pytest.mark.parametrize(
    "policy, expected",
    [
        ("null", [None, None, -9.0, 4.5]),
        ("zero", [0.0, 0.0, -9.0, 4.5]),
        ("plus_one", [20.0, None, None, 3.0]),
    ],
)
def test_ratio_policies(make, policy, expected):
    rows = table(engineer_features(make(ROWS), policy), "component")
    assert [r[S.EVENT_RATIO] for r in rows] == expected


def test_unknown_policy(make):
    with pytest.raises(ValueError):
        engineer_features(make(ROWS), "other")


def test_flags_are_strict_and_zero_for_null(make):
    rows = table(engineer_features(make(ROWS)), "component")
    assert [r[S.WARN_FLAG] for r in rows] == [0, 1, 0, 0]
    assert [r[S.VOLUME_FLAG] for r in rows] == [0, 1, 0, 0]


def test_interaction_does_not_overflow(make):
    big = 2_000_000_000
    row = engineer_features(make([("a", "240101_00", big, big, 1, 0)])).first()
    assert row[S.INTERACTION] == big * big


@pytest.mark.parametrize("window", ["", "240101", "240101_xx", None])
def test_malformed_hour_is_null(make, window):
    assert engineer_features(make([("a", window, 1, 1, 1, 0)])).first()[S.HOUR] is None


def test_date_and_hour(make):
    row = with_date_hour(make([("a", "081109_20", 1, 1, 1, 0)])).first()
    assert (row[S.DATE], row[S.HOUR]) == ("081109", 20)


def test_label_is_optional(make):
    df = make(ROWS).drop(S.INCIDENT)
    assert S.INCIDENT not in engineer_features(df).columns


def test_projection_does_not_shuffle(make):
    plan = executed_plan(engineer_features(make(ROWS)))
    assert "Exchange" not in plan and "Python" not in plan
