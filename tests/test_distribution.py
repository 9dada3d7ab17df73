import math
import random

import numpy as np
import pandas as pd
import pytest
from frames import executed_plan, sample_rows, table

from riskwindow import schema as S
from riskwindow.operators import correlation, distribution as D, explore
from riskwindow.plans import exploration

SKEWED = [0] * 400 + [1] * 7 + [65535, 65536, 65537, -65537, -1, 2**31 - 1, -(2**31)]
DOUBLES = [0.0, -0.0, 1e-300, -1e-300, 1e300, -1e300, 0.1, 0.1, 0.30000000000000004, 0.3, 5e-324]


def _column(spark, values, kind):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


@pytest.mark.parametrize("kind", ["int", "bigint", "double"])
def test_quantiles_match_pandas(spark, kind):
    values = [float(v) for v in SKEWED] if kind == "double" else SKEWED
    probabilities = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    row = D.quantiles(
        D.value_frequencies(_column(spark, values, kind), ["x"]), probabilities=probabilities
    ).first()
    expected = pd.Series(SKEWED, dtype="float64").quantile(probabilities)
    assert [row[D.quantile_name(p)] for p in probabilities] == pytest.approx(list(expected))


def test_quantiles_of_wide_integers(spark):
    generator = random.Random(7)
    values = [generator.randint(-(2**62), 2**62) for _ in range(501)] + [0, 1, 2]
    row = D.quantiles(D.value_frequencies(_column(spark, values, "bigint"), ["x"])).first()
    expected = pd.Series(sorted(values), dtype="float64").quantile([0.25, 0.5, 0.75])
    assert [row.p25, row.p50, row.p75] == pytest.approx(list(expected), rel=1e-12)


def test_quantiles_of_extreme_doubles(spark):
    generator = random.Random(3)
    values = DOUBLES + [generator.uniform(-1, 1) * 10 ** generator.randint(-30, 30) for _ in range(300)]
    probabilities = [i / 20 for i in range(21)]
    row = D.quantiles(
        D.value_frequencies(_column(spark, values, "double"), ["x"]), probabilities=probabilities
    ).first()
    expected = pd.Series(values).quantile(probabilities)
    assert [row[D.quantile_name(p)] for p in probabilities] == pytest.approx(
        list(expected), rel=1e-9, abs=1e-320
    )


@pytest.mark.parametrize("kind", ["int", "bigint", "double"])
@pytest.mark.parametrize("ranked, parts", [(1, 4), (5, 16), (40, 1 << 22)])
def test_quantiles_through_every_level(spark, monkeypatch, kind, ranked, parts):
    """Windows of a few values: groups of one value, few and many values, clusters far apart."""
    monkeypatch.setattr(D, "RANKED", ranked)
    monkeypatch.setattr(D, "PARTS", parts)
    draw = random.Random(ranked)
    reach = 2**31 - 1 if kind == "int" else 2**62
    cast = float if kind == "double" else int
    columns = {
        "x": [7] * 300,
        "y": [draw.randrange(-20, 20) for _ in range(300)],
        "z": [draw.randint(-reach, reach) for _ in range(150)] + [reach - i % 50 for i in range(150)],
    }
    rows = [(i % 2, *map(cast, r)) for i, r in enumerate(zip(*columns.values()))]
    df = spark.createDataFrame(rows, f"incident int, x {kind}, y {kind}, z {kind}")
    frequencies = D.value_frequencies(df, list(columns), [S.INCIDENT])
    frame = pd.DataFrame(rows, columns=["incident", *columns])
    found = {(r.incident, r.feature): [r.p25, r.p50, r.p75] for r in D.quantiles(frequencies, [S.INCIDENT]).collect()}
    assert len(found) == 6
    for (label, feature), got in found.items():
        expected = frame[frame.incident == label][feature].astype("float64").quantile([0.25, 0.5, 0.75])
        assert got == pytest.approx(list(expected), rel=1e-9)


def test_codes_of_doubles_keep_their_order(spark):
    draw = random.Random(5)
    values = [draw.uniform(-2, 2) * 10.0 ** draw.randint(-300, 300) for _ in range(2000)]
    values += [2.0**k * s * (1 + e) for k in range(-1000, 1000, 37) for s in (-1, 1) for e in (-2e-16, 0, 2e-16)]
    values += [0.0, -0.0, float("inf"), float("-inf"), 5e-324, -5e-324, 1.7976931348623157e308]
    coded = _column(spark, values, "double").selectExpr("x AS value").selectExpr("value", f"{D._code('double')} AS code")
    codes = [r.code for r in sorted(coded.collect(), key=lambda r: r.value)]
    assert codes == sorted(codes) and len(set(codes)) > 2200


def test_describe_matches_pandas(sample):
    expected = pd.DataFrame(sample_rows(), columns=sample.columns)[list(S.MEASURES)].describe()
    for row in D.describe_columns(sample, S.MEASURES).collect():
        assert list(row)[1:] == pytest.approx(list(expected[row.feature]))


def test_describe_by_label_matches_pandas(sample):
    frame = pd.DataFrame(sample_rows(), columns=sample.columns)
    expected = frame.groupby("incident")[list(S.MEASURES)].agg(["mean", "std", "median"])
    rows = explore.stats_by_incident(sample).collect()
    assert len(rows) == 6
    for row in rows:
        assert [row["mean"], row["std"], row["median"]] == pytest.approx(
            list(expected.loc[row.incident][row.feature])
        )


def test_single_row_group_has_no_deviation(make):
    df = make([("a", "x", 4, 1, 1, 1), ("a", "y", 1, 1, 1, 0), ("a", "z", 3, 1, 1, 0)])
    rows = {(r.incident, r.feature): r for r in explore.stats_by_incident(df).collect()}
    assert rows[1, "warn_count"].std is None and rows[1, "warn_count"].median == 4.0
    assert rows[0, "warn_count"].std == pytest.approx(math.sqrt(2))


def test_missing_values_are_left_out(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "x double")
    row = D.describe_columns(df, ["x"]).first()
    assert (row["count"], row["mean"], row["p50"]) == (2, 2.0, 2.0)
    sketch = D.describe_columns(df, ["x"], approx=True).first()
    assert (sketch["count"], sketch["min"], sketch["max"]) == (2, 1.0, 3.0)


def test_large_offset_keeps_the_deviation(spark):
    values = [2_000_000_000 + i for i in range(5)]
    row = D.describe_columns(_column(spark, values, "int"), ["x"]).first()
    assert row["std"] == pytest.approx(math.sqrt(2.5), rel=1e-12)


def test_data_is_scanned_once(spark, tmp_path):
    path = str(tmp_path / "windows")
    spark.range(1000).selectExpr("CAST(id % 7 AS INT) AS x", "id AS y").write.parquet(path)
    described = D.describe_columns(spark.read.parquet(path), ["x"])
    described.collect()
    plan = executed_plan(described)
    final = plan[: plan.index("Initial Plan")]
    assert final.count("FileScan") == 1
    assert "y#" not in final[final.index("FileScan") :].split("\n")[0]


def test_histogram_matches_numpy(sample):
    frame = pd.DataFrame(sample_rows(), columns=sample.columns)
    bins = D.histogram(D.value_frequencies(sample, S.MEASURES))
    for measure in S.MEASURES:
        rows = table(bins.filter(f"feature = '{measure}'"), "bin")
        counts, edges = np.histogram(frame[measure], bins=30)
        assert len(rows) == 30 and sum(r["count"] for r in rows) == 200
        assert [r["bin_start"] for r in rows] == pytest.approx(list(edges[:-1]))
        assert [r["count"] for r in rows] == list(counts)


def test_histogram_of_a_constant(spark):
    rows = table(D.histogram(D.value_frequencies(_column(spark, [4] * 9, "int"), ["x"])), "bin")
    assert (rows[0]["bin_start"], rows[29]["bin_end"]) == (3.5, 4.5)
    assert {r["bin"]: r["count"] for r in rows if r["count"]} == {15: 9}


def test_box_statistics(spark):
    values = [-50, 1, 2, 3, 4, 5, 6, 7, 100, 100]
    frequencies = D.value_frequencies(_column(spark, values, "int"), ["x"])
    row = D.box_statistics(frequencies).first()
    q1, median, q3 = pd.Series(values).quantile([0.25, 0.5, 0.75])
    assert (row.q1, row.median, row.q3) == (q1, median, q3)
    assert (row.whisker_low, row.whisker_high, row.outliers) == (1.0, 7.0, 3)
    assert {(r.value, r.n) for r in D.outlier_values(frequencies).collect()} == {(-50, 1), (100, 2)}


def test_whisker_stays_outside_the_box(spark):
    # The third quartile is interpolated above the largest value inside the fence.
    values = [0, 0, 0, 1, 100]
    row = D.box_statistics(D.value_frequencies(_column(spark, values, "int"), ["x"])).first()
    assert row.q3 == 1.0 and row.whisker_high == 1.0
    values = [0, 0, 0, 100]
    row = D.box_statistics(D.value_frequencies(_column(spark, values, "int"), ["x"])).first()
    assert (row.q3, row.whisker_high, row.outliers) == (25.0, 25.0, 1)


def test_boxes_by_label(sample):
    frequencies = D.value_frequencies(sample, S.MEASURES, [S.INCIDENT])
    assert D.box_statistics(frequencies, [S.INCIDENT]).count() == 6


def test_correlations_match_pandas(sample):
    columns = [*S.MEASURES, S.INCIDENT]
    expected = pd.DataFrame(sample_rows(), columns=sample.columns)[columns].corr()
    rows = correlation.correlation_matrix(sample).collect()
    assert len(rows) == 16
    cells = {(r.x, r.y): r.r for r in rows}
    for (x, y), r in cells.items():
        assert r == pytest.approx(expected.loc[x, y]) and r == cells[y, x]
    heat = {(r.x, r.y): r.r for r in correlation.correlation_heatmap(sample).collect()}
    assert heat == {k: round(v, 2) for k, v in cells.items()}


def test_correlation_ignores_incomplete_pairs(make):
    rows = [("a", "x", w, v, 1, 0) for w, v in [(1, 2), (2, 4), (3, 9), (None, 50), (7, None)]]
    expected = pd.DataFrame({"w": [1, 2, 3], "v": [2, 4, 9]}).corr().loc["w", "v"]
    cells = correlation.correlation_matrix(make(rows), ["warn_count", "log_volume"])
    assert cells.filter("x < y").first().r == pytest.approx(expected)


def test_constant_column_has_no_correlation(make):
    df = make([("a", "x", i, 5, 1, i % 2) for i in range(4)])
    rows = correlation.correlation_with_target(df, [*S.MEASURES, S.INCIDENT]).collect()
    assert [r.feature for r in rows] == ["incident", "warn_count", "log_volume", "unique_event_count"]
    assert rows[0].r == 1.0 and rows[2].r is None and rows[3].r is None


def test_report_and_run(spark, make, sample, tmp_path):
    df = sample.union(make([(None, "240201_00", 2, 2, 2, None)]))
    tables = exploration.run_exploration(df, str(tmp_path))
    report = {(r.section, r.key, r.metric): r.value for r in tables["report"].collect()}
    assert report["shape", "dataset", "row_count"] == 201
    assert report["shape", "dataset", "column_count"] == 8
    assert report["incident_distribution", "1", "count"] == 20
    assert report["summary", "warn_count", "count"] == 201
    assert report["summary", "incident", "count"] == 200
    direct = {
        (r.section, r.key, r.metric): r.value for r in exploration.eda_report(df).collect()
    }
    assert report.keys() == direct.keys()
    assert all(report[k] == pytest.approx(direct[k]) for k in report)
    assert len(tables) == 21
    assert tables["describe"].count() == 4 and tables["histograms"].count() == 90
    rows = {(r.incident, r.feature): r.median for r in tables["stats_by_incident"].collect()}
    assert len(rows) == 6
    cells = {(r.x, r.y): r.r for r in correlation.correlation_matrix(df).collect()}
    assert {(r.x, r.y): r.r for r in tables["correlations"].collect()} == pytest.approx(cells)
    assert {r.incident: r["count"] for r in tables["class_share"].collect()} == {0: 180, 1: 20}
    assert tables["incident_rate"].first()[0] == pytest.approx(0.1)
