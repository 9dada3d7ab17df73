import random
import re

import pytest

import __spark_entry__ as entry
from frames import sample_rows
from riskwindow.operators import evaluate


@pytest.mark.parametrize("digits", [1, 4, 12])
def test_area_equals_counted_pairs(spark, digits):
    draw = random.Random(digits)
    rows = [(int(draw.random() < 0.3), round(draw.random() ** 6, digits)) for _ in range(1500)]
    ups, downs = ([p for y, p in rows if y == k] for k in (1, 0))
    wins = sum((a > b) + (a == b) / 2 for a in ups for b in downs)
    frame = spark.createDataFrame(rows, "y_true int, y_proba double")
    area = entry._area_again(frame, "y_proba")
    assert area.first()["auc"] == pytest.approx(wins / len(ups) / len(downs), abs=1e-12)


def test_no_task_ranks_all_scores(spark):
    frame = spark.range(4000).selectExpr("CAST(id % 2 AS INT) AS y_true", "id / 4000 AS y_proba")
    plan = entry._area_again(frame, "y_proba")._jdf.queryExecution().optimizedPlan().toString()
    # Scores are ordered within a range; across ranges only the ranges are.
    assert len(re.findall(r"windowspecdefinition\(part#\d+, score#\d+ ASC", plan)) == 1
    assert len(re.findall(r"windowspecdefinition\(", plan)) == 2 and "windowspecdefinition(score" not in plan


@pytest.mark.parametrize("only", [0, 1])
def test_area_of_one_class_is_zero_as_reported(spark, only):
    rows = [(only, 0, i % 7 / 7) for i in range(50)]
    frame = spark.createDataFrame(rows, "y_true int, y_pred int, y_proba double")
    assert entry._area_again(frame, "y_proba").first()["auc"] == 0.0 == evaluate.roc_auc(frame)


def _of_one_class(make, incident):
    return make([(*row[:-1], incident) for row in sample_rows(60)])


@pytest.mark.parametrize("incident", [0, 1])
def test_model_metrics_of_windows_of_one_class(make, incident):
    assert all(entry._model_metrics_check(_of_one_class(make, incident)).first())


def test_run_report_of_windows_of_one_class(make):
    assert all(entry._run_report_check(_of_one_class(make, 1)).first())


def test_training_metrics_of_windows_of_one_class(make):
    assert all(entry._training_metrics_check(_of_one_class(make, 1)).first())
