import random

import pytest
from frames import table

from riskwindow.operators import evaluate


@pytest.fixture
def scored(spark):
    def build(rows):
        return spark.createDataFrame(rows, "y_true int, y_pred int, y_proba double")

    return build


@pytest.fixture
def pairs(scored):
    return lambda rows: evaluate.confusion_pairs(scored(rows))


def _rows(tn=0, fp=0, fn=0, tp=0):
    return (
        [(0, 0, 0.1)] * tn + [(0, 1, 0.9)] * fp + [(1, 0, 0.1)] * fn + [(1, 1, 0.9)] * tp
    )


def test_rare_class_never_predicted(pairs):
    df = pairs(_rows(tn=23, fn=1))
    assert tuple(evaluate.positive_metrics(df).first()) == pytest.approx((23 / 24, 0, 0, 0))
    row = evaluate.weighted_metrics(df).first()
    assert tuple(row) == pytest.approx((0.9583333, 0.9184028, 0.9583333, 0.9379433), abs=1e-7)
    cells = {(r.label, r.metric): r.value for r in evaluate.classification_report(df).collect()}
    assert len(cells) == 17
    assert cells["0", "f1-score"] == pytest.approx(0.9787234, abs=1e-7)
    assert cells["1", "recall"] == 0.0 and cells["1", "support"] == 1.0
    assert cells["macro avg", "precision"] == pytest.approx(0.4791667, abs=1e-7)
    assert cells["macro avg", "recall"] == 0.5
    assert cells["weighted avg", "support"] == 24.0
    assert cells["accuracy", "accuracy"] == pytest.approx(23 / 24)


def test_confusion(pairs):
    df = pairs(_rows(tn=5, fp=2, fn=3, tp=4))
    rows = table(evaluate.confusion_matrix(df), "actual")
    assert [tuple(r.values()) for r in rows] == [("Incident", 3, 4), ("No Incident", 5, 2)]
    assert [tuple(r) for r in df.collect()] == [
        (0, 0, 5), (0, 1, 2), (1, 0, 3), (1, 1, 4),
    ]
    assert tuple(evaluate.prediction_totals(df).first()) == (14, 7, 6)
    assert evaluate.accuracy(df).first()[0] == pytest.approx(9 / 14)
    row = evaluate.positive_metrics(df).first()
    assert tuple(row) == pytest.approx((9 / 14, 4 / 6, 4 / 7, 8 / 13))


@pytest.mark.parametrize("label", [0, 1])
def test_single_class(scored, pairs, label):
    rows = [(label, label, 0.5)] * 4
    assert evaluate.roc_auc(scored(rows)) == 0.0
    df = pairs(rows)
    assert evaluate.weighted_metrics(df).first().weighted_f1 == 1.0
    assert evaluate.positive_metrics(df).first().f1 == float(label)
    assert evaluate.confusion_matrix(df).selectExpr("sum(no_incident + incident)").first()[0] == 4


def test_class_seen_only_as_prediction(pairs):
    cells = {
        (r.label, r.metric): r.value
        for r in evaluate.classification_report(pairs(_rows(tn=1, fp=1))).collect()
    }
    assert cells["1", "support"] == 0.0 and cells["1", "precision"] == 0.0
    assert cells["macro avg", "recall"] == 0.25


def test_matches_mllib(scored):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    df = scored(_rows(tn=50, fp=7, fn=9, tp=21)).selectExpr(
        "CAST(y_true AS DOUBLE) AS y_true", "CAST(y_pred AS DOUBLE) AS y_pred"
    )
    row = evaluate.weighted_metrics(evaluate.confusion_pairs(df)).first()
    for metric, value in (
        ("accuracy", row.accuracy),
        ("weightedPrecision", row.weighted_precision),
        ("weightedRecall", row.weighted_recall),
        ("f1", row.weighted_f1),
    ):
        evaluator = MulticlassClassificationEvaluator(
            labelCol="y_true", predictionCol="y_pred", metricName=metric
        )
        assert evaluator.evaluate(df) == pytest.approx(value)


def _brute_auc(rows):
    wins = [
        1.0 if p > n else 0.5 if p == n else 0.0
        for t, _, p in rows
        if t
        for u, _, n in rows
        if not u
    ]
    return sum(wins) / len(wins)


def test_auc_with_ties(scored):
    generator = random.Random(5)
    rows = [(generator.randint(0, 1), 0, generator.randint(0, 9) / 10) for _ in range(120)]
    df = scored(rows)
    area = evaluate.roc_auc(df)
    assert area == pytest.approx(_brute_auc(rows))
    assert evaluate.rank_auc(df).first().auc == area
    flipped = df.selectExpr("y_true", "-y_proba AS y_proba")
    assert evaluate.roc_auc(flipped) == pytest.approx(1 - area)


def test_auc_is_not_down_sampled(scored):
    rows = [(int(i % 3 == 0), 0, float((i * 7919) % 5003)) for i in range(3000)]
    assert evaluate.roc_auc(scored(rows)) == pytest.approx(_brute_auc(rows))


def test_gate(spark):
    frame = lambda *row: spark.createDataFrame([row], "accuracy double, f1 double, auc double")
    assert tuple(evaluate.quality_gate(frame(0.7, 0.6, 0.7)).first()) == (True,) * 4
    gate = evaluate.quality_gate(frame(0.96, 0.0, 0.33))
    assert tuple(gate.first()) == (True, False, False, False)
    with pytest.raises(ValueError):
        evaluate.require_gate(gate)
    assert not evaluate.quality_gate(frame(0.9, None, 0.9)).first().all_checks_passed
