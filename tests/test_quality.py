import pytest
from frames import table

from riskwindow import schema as S
from riskwindow.operators import quality

ROWS = [
    (None, "240101_00", None, 1, 1, 0),
    ("a", "bad", None, 2, 1, 1),
    ("b", None, 3, 3, 1, 0),
]


def test_missing_counts_nan_and_null(make):
    df = make(ROWS).selectExpr("*", "IF(log_volume = 2, double('NaN'), 1.0) AS share")
    counts = {r.column: r.missing for r in quality.missing_by_column(df).collect()}
    assert counts == {
        "component": 1,
        "time_window": 1,
        "warn_count": 2,
        "log_volume": 0,
        "unique_event_count": 0,
        "incident": 0,
        "share": 1,
    }
    assert quality.missing_by_column(df, only_present=True).count() == 4
    assert quality.missing_total(df).first().missing_values == 5


def test_missing_is_one_aggregation(make):
    plan = quality.missing_by_column(make(ROWS))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_stats_row(make):
    row = quality.dataset_stats(make(ROWS), windows=True).first()
    assert (row.total_records, row.total_features, row.incident_count) == (3, 6, 1)
    assert row.incident_rate == pytest.approx(1 / 3)
    assert (row.missing_values, row.malformed_windows) == (4, 2)
    assert quality.malformed_windows(make(ROWS)).first()[0] == 2


def test_shape_and_schema(make):
    assert tuple(quality.shape(make(ROWS)).first()) == (3, 6)
    rows = table(quality.schema_table(make(ROWS)), "position")
    assert [(r["column"], r["type"], r["non_null"]) for r in rows][:3] == [
        ("component", "string", 2),
        ("time_window", "string", 2),
        ("warn_count", "int", 1),
    ]


def test_numeric_columns(make):
    assert quality.numeric_columns(make(ROWS)) == [*S.MEASURES, S.INCIDENT]


def test_checks(make):
    quality.require_columns(make(ROWS))
    quality.require_rows(make(ROWS))
    with pytest.raises(ValueError, match="incident"):
        quality.require_columns(make(ROWS).drop("incident"))
    with pytest.raises(ValueError, match="no rows"):
        quality.require_rows(make([]))
    assert quality.dataset_stats(make([])).first().total_records == 0
