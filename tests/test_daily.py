import random

import pytest
from frames import executed_plan, sample_rows, table

from riskwindow import schema as S
from riskwindow.operators import analysis, explore, quality
from riskwindow.plans import daily

ODD = [
    (None, "240101_05", 3, None, 1, 1),
    ("svc.1", None, 2, 2, None, None),
    ("svc.2", "240102_xx", None, 5, 1, 0),
    ("svc.2", "bad", 1, 1, 1, 1),
    ("", "", 1, 1, 1, 0),
]


@pytest.fixture
def rows():
    return [*sample_rows(), *ODD]


@pytest.fixture
def days(spark, make, rows, tmp_path):
    """Partials of all days, stored one day after the other, the second one twice."""
    path = str(tmp_path / "days")
    dates = sorted({(r[1] or "")[:6] for r in rows})
    for date in [*dates, dates[2]]:
        daily.store_days(make([r for r in rows if (r[1] or "")[:6] == date]), path)
    return daily.read_days(spark, path)


def _same(left, right):
    assert left.columns == right.columns
    said = lambda df: sorted(
        tuple(f"{v:.9g}" if isinstance(v, float) else str(v) for v in r) for r in df.collect()
    )
    assert said(left) == said(right)


def test_combined_days_equal_the_rows(days, make, rows):
    df = make(rows)
    _same(daily.basic_statistics(days), analysis.basic_statistics(df))
    _same(daily.incident_rate_by_component(days), analysis.incident_rate_by_component(df))
    _same(daily.component_feature_ranges(days), analysis.component_feature_ranges(df))
    _same(daily.component_warning_category(days), analysis.component_warning_category(df))
    _same(daily.dataset_stats(days), quality.dataset_stats(df, windows=True))
    _same(daily.missing_by_column(days), quality.missing_by_column(df))


def test_profiles_equal_the_rows(spark, make, tmp_path):
    rows = [r for r in [*sample_rows(), *ODD] if r[1]]
    path = str(tmp_path / "days")
    daily.store_days(make(rows), path)
    days, df = daily.read_days(spark, path), make(rows)
    profile, direct = daily.group_profile(days), explore.group_profile(df)
    for build in (explore.component_card, explore.date_stats, explore.hour_stats, explore.component_series):
        _same(build(profile), build(direct))
    _same(daily.incidents_by_date(days), analysis.incidents_by_date(df))


def test_a_range_reads_its_dates_only(spark, days, make, rows, tmp_path):
    some = daily.read_days(spark, str(tmp_path / "days"), first="240102", last="240104")
    own = [r for r in rows if "240102" <= (r[1] or "")[:6] <= "240104"]
    _same(daily.basic_statistics(some), analysis.basic_statistics(make(own)))
    plan = executed_plan(daily.incidents_by_date(some))
    assert "PartitionFilters: [isnotnull(date_part" in plan and "240102" in plan


def test_no_days(spark, make, tmp_path):
    path = str(tmp_path / "days")
    daily.store_days(make(sample_rows()), path)
    none = daily.read_days(spark, path, first="990101")
    assert daily.basic_statistics(none).first().total_records == 0
    assert daily.incidents_by_date(none).isEmpty()
    sketched = daily.read_days(spark, path, "sketches", first="990101")
    assert daily.distinct_components(sketched).first().unique_components == 0
    assert daily.approximate_quantiles(sketched).isEmpty()


def test_sketches_keep_their_stated_error(spark, tmp_path):
    """Ten days of 3,000 components each, half of them new every day."""
    path = str(tmp_path / "days")
    for day in range(1, 11):
        spark.range(3000).selectExpr(
            f"concat('c', id + {day * 1500}) AS component", f"'2401{day:02d}_00' AS time_window",
            f"CAST((id * id * {day}) % 100003 AS INT) AS warn_count", "CAST(id AS INT) AS log_volume",
            "1 AS unique_event_count", "0 AS incident",
        ).write.mode("append").parquet(f"{path}-rows")
    rows = spark.read.schema(S.WINDOW_SCHEMA).parquet(f"{path}-rows")
    daily.store_days(rows, path)
    for first, last in (("240101", "240110"), ("240103", "240104")):
        days = daily.read_days(spark, path, "sketches", first, last)
        own = rows.filter(f"substr(time_window, 1, 6) BETWEEN '{first}' AND '{last}'")
        exact = own.select("component").distinct().count()
        assert abs(daily.distinct_components(days).first()[0] - exact) <= 3 * 1.04 / 64 * exact
        found = table(daily.approximate_quantiles(days, [0.01, 0.5, 0.9]), "feature")
        total = own.count()
        assert [r["count"] for r in found] == [total] * 3
        for r in found:
            for name, p in (("p1", 0.01), ("p50", 0.5), ("p90", 0.9)):
                below, upto = (own.filter(f"{r['feature']} {sign} {r[name]}").count() for sign in ("<", "<="))
                assert below / total <= p + 0.0266 and upto / total >= p - 0.0266
    plan = executed_plan(daily.distinct_components(daily.read_days(spark, path, "sketches", "240103", "240104")))
    assert "components" in plan and "values_" not in plan[plan.index("ReadSchema") :]


def test_random_days_in_any_order(spark, make, tmp_path):
    draw = random.Random(1)
    rows = sample_rows(120, 12)
    path = str(tmp_path / "days")
    dates = sorted({r[1][:6] for r in rows}) * 2
    draw.shuffle(dates)
    for date in dates:
        daily.store_days(make([r for r in rows if r[1][:6] == date]), path)
    _same(daily.incidents_by_date(daily.read_days(spark, path)), analysis.incidents_by_date(make(rows)))
