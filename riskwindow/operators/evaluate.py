"""Metrics from confusion counts, ROC AUC and the quality gate.

Predictions are reduced once to counts per (label, prediction); every metric
table but the ROC area is computed from those few rows.
"""

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskwindow import schema as S
from riskwindow.functions import literal, quoted, rows_from, share, share_or_zero

LABEL, PREDICTION, SCORE = "y_true", "y_pred", "y_proba"


def confusion_pairs(predictions: DataFrame, label=LABEL, prediction=PREDICTION) -> DataFrame:
    """(y_true, y_pred, count) for the pairs that occur."""
    return (
        predictions.groupBy(
            F.expr(f"CAST({quoted(label)} AS INT) AS y_true"),
            F.expr(f"CAST({quoted(prediction)} AS INT) AS y_pred"),
        )
        .agg(F.expr("count(*) AS count"))
        .orderBy("y_true", "y_pred")
    )


def _rows_where(condition: str) -> str:
    return f"coalesce(sum(IF({condition}, count, 0L)), 0L)"


def confusion_matrix(pairs: DataFrame) -> DataFrame:
    """2 x 2 matrix, true classes down and predicted classes across, zeros included."""
    cells = pairs.agg(
        *[
            F.expr(f"{_rows_where(f'y_true = {true} AND y_pred = {said}')} AS n{true}{said}")
            for true in (0, 1)
            for said in (0, 1)
        ]
    )
    rows = [("'No Incident'", "n00", "n01"), ("'Incident'", "n10", "n11")]
    return cells.selectExpr(rows_from(["actual", "no_incident", "incident"], rows))


def accuracy(pairs: DataFrame) -> DataFrame:
    hits = _rows_where("y_true = y_pred")
    return pairs.agg(F.expr(f"{share(hits, 'sum(count)')} AS accuracy"))


def positive_metrics(pairs: DataFrame) -> DataFrame:
    """Accuracy, and precision, recall and F1 of class 1; 0 on an empty denominator."""
    return pairs.agg(
        F.expr(f"{_rows_where('y_true = 1 AND y_pred = 1')} AS tp"),
        F.expr(f"{_rows_where('y_true = 1')} AS actual"),
        F.expr(f"{_rows_where('y_pred = 1')} AS predicted"),
        F.expr(f"{_rows_where('y_true = y_pred')} AS hits"),
        F.expr("sum(count) AS n"),
    ).selectExpr(
        f"{share_or_zero('hits', 'n')} AS accuracy",
        f"{share_or_zero('tp', 'predicted')} AS precision",
        f"{share_or_zero('tp', 'actual')} AS recall",
        f"{share_or_zero('(2 * tp)', '(actual + predicted)')} AS f1",
    )


def class_metrics(pairs: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support of every class seen as label or prediction."""
    roles = rows_from(
        ["class", "support", "predicted", "tp"],
        [
            ("y_true", "count", "0L", "IF(y_true = y_pred, count, 0L)"),
            ("y_pred", "0L", "count", "0L"),
        ],
    )
    return (
        pairs.selectExpr(roles)
        .groupBy("class")
        .agg(
            F.expr("sum(support) AS support"),
            F.expr("sum(predicted) AS predicted"),
            F.expr("sum(tp) AS tp"),
        )
        .selectExpr(
            "class",
            f"{share_or_zero('tp', 'predicted')} AS precision",
            f"{share_or_zero('tp', 'support')} AS recall",
            f"{share_or_zero('(2 * tp)', '(support + predicted)')} AS f1",
            "support",
            "tp",
        )
    )


def _by_support(metric: str) -> str:
    return share_or_zero(f"sum({metric} * support)", "sum(support)")


def weighted_metrics(pairs: DataFrame) -> DataFrame:
    """Accuracy, and precision, recall and F1 averaged over classes by support."""
    return class_metrics(pairs).agg(
        F.expr(f"{share_or_zero('sum(tp)', 'sum(support)')} AS accuracy"),
        *[F.expr(f"{_by_support(m)} AS weighted_{m}") for m in ("precision", "recall", "f1")],
    )


def classification_report(pairs: DataFrame) -> DataFrame:
    """(label, metric, value): every class, accuracy, macro and weighted averages.

    A rollup gives the class rows and the averages from the same counts.
    """
    metrics = ("precision", "recall", "f1")
    rolled = (
        class_metrics(pairs)
        .rollup("class")
        .agg(
            F.expr("grouping(class) AS overall"),
            F.expr("CAST(sum(support) AS DOUBLE) AS support"),
            F.expr(f"{share_or_zero('sum(tp)', 'sum(support)')} AS accuracy"),
            *[F.expr(f"avg({m}) AS macro_{m}") for m in metrics],
            *[F.expr(f"{_by_support(m)} AS weighted_{m}") for m in metrics],
        )
    )

    def cells(name: str, prefix: str) -> str:
        values = {
            "precision": f"{prefix}_precision",
            "recall": f"{prefix}_recall",
            "f1-score": f"{prefix}_f1",
            "support": "support",
        }
        return ", ".join(_cell(name, metric, value) for metric, value in values.items())

    own = f"array({cells('CAST(class AS STRING)', 'macro')})"
    overall = (
        f"array({_cell(literal('accuracy'), 'accuracy', 'accuracy')}, "
        f"{cells(literal('macro avg'), 'macro')}, {cells(literal('weighted avg'), 'weighted')})"
    )
    return rolled.selectExpr(f"inline(IF(overall = 0, {own}, {overall}))")


def _cell(name: str, metric: str, value: str) -> str:
    return f"named_struct('label', {name}, 'metric', {literal(metric)}, 'value', {value})"


def prediction_totals(pairs: DataFrame) -> DataFrame:
    return pairs.agg(
        F.expr("sum(count) AS total_predictions"),
        F.expr("sum(y_true * count) AS actual_incidents"),
        F.expr("sum(y_pred * count) AS predicted_incidents"),
    )


def roc_auc(predictions: DataFrame, label=LABEL, score=SCORE) -> float:
    """Exact area under the ROC curve, ties counted half; 0.0 when one class is absent.

    ``score`` may be a number or MLlib's rawPrediction vector. Rows of equal
    score and label are counted before the evaluator sorts the distinct scores
    by range over the cluster.
    """
    if isinstance(predictions.schema[score].dataType, VectorUDT):
        predictions = predictions.withColumn(score, vector_to_array(score)[1])
    counted = (
        predictions.groupBy(
            F.expr(f"CAST({label} AS DOUBLE) AS label"), F.expr(f"CAST({score} AS DOUBLE) AS score")
        )
        .agg(F.expr("CAST(count(*) AS DOUBLE) AS n"))
        .persist()
    )
    try:
        if counted.select("label").distinct().count() < 2:
            return 0.0
        return BinaryClassificationEvaluator(
            labelCol="label",
            rawPredictionCol="score",
            weightCol="n",
            metricName="areaUnderROC",
            numBins=0,
        ).evaluate(counted)
    finally:
        counted.unpersist()


def rank_auc(predictions: DataFrame, label=LABEL, score=SCORE) -> DataFrame:
    """The ROC area as a one-row table."""
    area = roc_auc(predictions, label, score)
    return predictions.sparkSession.range(1).select(F.lit(float(area)).alias("auc"))


def quality_gate(
    metrics: DataFrame,
    min_accuracy: float = S.MIN_ACCURACY,
    min_f1: float = S.MIN_F1,
    min_auc: float = S.MIN_AUC,
) -> DataFrame:
    """Compare a (accuracy, f1, auc) row with the thresholds; reaching one is enough."""
    checks = {"accuracy": min_accuracy, "f1": min_f1, "auc": min_auc}
    passed = {m: f"coalesce({m} >= {least!r}D, false)" for m, least in checks.items()}
    return metrics.selectExpr(
        *[f"{check} AS {m}_check" for m, check in passed.items()],
        f"{' AND '.join(passed.values())} AS all_checks_passed",
    )


def require_gate(gate: DataFrame) -> None:
    """Stop the run when a check failed; the pipeline itself only reports."""
    if not gate.first()["all_checks_passed"]:
        raise ValueError("a metric is below its threshold; the gate table says which")
