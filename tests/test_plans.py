"""What the physical plans must look like, whatever the size of the data."""

import re

import pytest
from frames import executed_plan

from riskwindow import schema as S
from riskwindow.operators import (
    analysis,
    correlation,
    distribution,
    evaluate,
    explore,
    quality,
    split,
)
from riskwindow.operators.features import engineer_features


@pytest.fixture
def stored(spark, sample, tmp_path):
    path = str(tmp_path / "windows")
    sample.write.parquet(path)
    return spark.read.parquet(path)


def _read_columns(plan):
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    return [{field.split(":")[0] for field in schema.split(",") if field} for schema in schemas]


@pytest.mark.parametrize(
    "build, columns",
    [
        (analysis.incidents_by_date, {"time_window", "incident", "warn_count"}),
        (
            lambda f: explore.date_stats(explore.group_profile(f, [S.DATE])),
            {"time_window", "incident", "warn_count"},
        ),
        (lambda f: explore.value_counts(f, S.COMPONENT), {"component"}),
        (explore.target_rate, {"incident"}),
        (
            lambda f: correlation.correlation_with_target(f, ["warn_count"]),
            {"warn_count", "incident"},
        ),
        (
            lambda f: engineer_features(f).select(S.COMPONENT, S.HOUR),
            {"component", "time_window"},
        ),
        (lambda f: split.with_class_weight(f, {0: 9, 1: 1}).groupBy("weight").count(), {"incident"}),
        (explore.scatter_density, {"warn_count", "log_volume", "incident"}),
    ],
)
def test_only_used_columns_are_read(stored, build, columns):
    assert _read_columns(executed_plan(build(stored))) == [columns]


def test_filter_reaches_the_scan(stored):
    plan = executed_plan(analysis.high_risk_windows(stored))
    assert "PushedFilters: [IsNotNull(incident), EqualTo(incident,1)]" in plan


@pytest.mark.parametrize(
    "build",
    [
        quality.column_profile,
        quality.dataset_stats,
        quality.missing_total,
        explore.group_profile,
        correlation.correlation_matrix,
        analysis.component_feature_ranges,
        analysis.component_warning_category,
    ],
)
def test_one_scan_one_shuffle_after_partial_aggregation(stored, build):
    plan = executed_plan(build(stored))
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
    assert "partial_" in plan


@pytest.mark.parametrize(
    "build",
    [
        lambda f: distribution.histogram(distribution.value_frequencies(f, S.MEASURES)),
        lambda f: distribution.box_statistics(distribution.value_frequencies(f, S.MEASURES)),
        lambda f: distribution.box_statistics(
            distribution.value_frequencies(f, S.MEASURES, [S.INCIDENT]), [S.INCIDENT]
        ),
        lambda f: distribution.outlier_values(distribution.value_frequencies(f, S.MEASURES)),
        lambda f: distribution.describe_columns(f, S.MEASURES),
        explore.stats_by_incident,
    ],
)
def test_distributions_scan_once(stored, build):
    df = build(stored)
    df.collect()
    plan = executed_plan(df)
    assert plan[: plan.index("Initial Plan")].count("FileScan") == 1


def test_metrics_come_from_one_scan(stored):
    scored = stored.selectExpr("incident AS y_true", "CAST(warn_count > 3 AS INT) AS y_pred")
    pairs = evaluate.confusion_pairs(scored)
    for table in (
        evaluate.classification_report,
        evaluate.weighted_metrics,
        evaluate.confusion_matrix,
        evaluate.positive_metrics,
    ):
        plan = executed_plan(table(pairs))
        assert plan.count("FileScan") == 1 and "partial_count" in plan


def test_split_hashes_each_row_once_per_scan(stored):
    plan = executed_plan(split.stratified_split(engineer_features(stored)))
    assert plan.count("md5(") == plan.count("FileScan") == 2


@pytest.mark.parametrize(
    "build",
    [
        lambda f: distribution.histogram(distribution.value_frequencies(f, S.MEASURES)),
        lambda f: distribution.box_statistics(distribution.value_frequencies(f, S.MEASURES)),
        lambda f: distribution.describe_columns(f, S.MEASURES),
        explore.stats_by_incident,
    ],
)
def test_values_do_not_meet_by_feature_below_a_join(spark, stored, build):
    """Also without automatic broadcasts: the side of few rows is broadcast by a hint."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = executed_plan(build(stored))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan


def test_scaling_reads_the_raw_rows_once(spark, sample, tmp_path, monkeypatch):
    """The split is stored; indexer, scaler and result start from it."""
    from riskwindow.plans import training

    path = str(tmp_path / "windows")
    sample.write.parquet(path)
    train, test = training.train_and_test(engineer_features(spark.read.parquet(path), "plus_one"))
    assert path not in executed_plan(train) and path not in executed_plan(test)


def test_report_reads_the_stored_basis_only(spark, sample, tmp_path):
    from riskwindow.plans import exploration

    path = str(tmp_path / "windows")
    sample.write.parquet(path)
    report = exploration.eda_report(spark.read.parquet(path))
    report.collect()
    plan = executed_plan(report)
    assert path not in plan and "InMemoryTableScan" not in plan and "FileScan" in plan
