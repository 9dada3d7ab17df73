"""Validate, preprocess, train, then evaluate and gate, then record the run.

One Spark application. The steps hand tables to each other as parquet under the
output folder (``tables``), with the types they have, so a step that is repeated after
a failure starts from storage and scored rows are read back, not scored again. CSV and
JSON files beside them are written for other readers and never read again.
"""

from collections.abc import Callable

from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskwindow import schema as S
from riskwindow.operators import evaluate, models, quality, split
from riskwindow.operators.features import engineer_features
from riskwindow.sources import append_run, write_csv, write_json, write_parquet


def _stored(df: DataFrame, output: str, name: str, deliver: Callable | None = None) -> DataFrame:
    """The table as stored, for the steps that follow; also written in another format on demand."""
    path = f"{output}/tables/{name}"
    write_parquet(df, path)
    table = df.sparkSession.read.parquet(path)
    if deliver:
        deliver(table, f"{output}/{name}")
    return table


def validate(windows: DataFrame, output: str) -> tuple[DataFrame, DataFrame]:
    """Check columns and rows, store the raw table and its statistics."""
    quality.require_columns(windows)
    quality.require_rows(windows)
    raw = _stored(windows, output, "raw")
    stats = quality.dataset_stats(raw, windows=True)
    return raw, _stored(stats, output, "data_stats", write_json)


def preprocess(raw: DataFrame, output: str) -> tuple[DataFrame, StringIndexerModel]:
    """Engineer features, fit the component code on all rows, store the split."""
    spark = raw.sparkSession
    engineered = engineer_features(raw, policy="plus_one")
    indexer = models.component_indexer("alphabetAsc").fit(engineered)
    indexer.write().overwrite().save(f"{output}/component_code")
    write_parquet(split.stratified_split(engineered), f"{output}/samples", ["split"])
    return spark.read.parquet(f"{output}/samples"), indexer


def train(
    samples: DataFrame,
    indexer: StringIndexerModel,
    output: str,
    model_type: str,
    classifier=None,
    partitions: int | None = None,
) -> dict[str, DataFrame]:
    """Fit the preset, store model, predictions, metrics and reports."""
    fit_rows = samples.filter(f"split = '{split.TRAIN}'")
    test_rows = samples.filter(f"split = '{split.TEST}'")
    counts = split.label_counts(fit_rows)
    n = sum(counts.values())
    model = models.fit_scaled(
        split.with_class_weight(fit_rows, counts),
        indexer,
        classifier or models.scaled_model(model_type, n),
        n,
        partitions,
    )
    models.save_model(model, f"{output}/model")
    scored = models.prediction_table(models.score(model, test_rows))
    predictions = _stored(scored, output, "predictions", write_csv)
    pairs = _stored(evaluate.confusion_pairs(predictions), output, "confusion_pairs")
    matrix = _stored(evaluate.confusion_matrix(pairs), output, "confusion_matrix", write_csv)
    report = evaluate.classification_report(pairs)
    report = _stored(report, output, "classification_report", write_json)
    fitted = evaluate.confusion_pairs(models.score(model, fit_rows), S.INCIDENT, "prediction")
    train_accuracy = evaluate.accuracy(fitted).first()[0]
    area = evaluate.roc_auc(predictions)
    metrics = evaluate.positive_metrics(pairs).select(
        F.lit(model_type).alias("model_type"),
        F.lit(train_accuracy).alias("train_accuracy"),
        "accuracy",
        "precision",
        "recall",
        "f1",
        F.lit(area).alias("auc"),
        F.current_timestamp().alias("trained_at"),
    )
    return {
        "predictions": predictions,
        "confusion_pairs": pairs,
        "confusion_matrix": matrix,
        "classification_report": report,
        "metrics": _stored(metrics, output, "metrics", write_json),
    }


def evaluation_report(metrics: DataFrame, pairs: DataFrame) -> DataFrame:
    """(section, metric, value): the written evaluation as one table of texts."""
    measured = _as_text(metrics)
    totals = _as_text(evaluate.prediction_totals(pairs))
    model = ["model_type", "trained_at"]
    scores = [c for c in metrics.columns if c not in model]
    return _section(measured, "model", model).unionByName(
        _section(measured, "performance", scores)
    ).unionByName(_section(totals, "dataset", totals.columns))


def _as_text(row: DataFrame) -> DataFrame:
    return row.selectExpr(*[f"CAST({c} AS STRING) AS {c}" for c in row.columns])


def _section(row: DataFrame, name: str, columns) -> DataFrame:
    return row.unpivot([], list(columns), "metric", "value").selectExpr(
        f"'{name}' AS section", "metric", "value"
    )


def run_pipeline(
    spark: SparkSession,
    windows: DataFrame,
    output: str,
    model_type: str = "random_forest",
    strict: bool = False,
    classifier=None,
    partitions: int | None = None,
) -> dict[str, DataFrame]:
    """The whole chain; returns the stored tables by name.

    A failed gate is reported and the run still recorded, unless ``strict``.
    """
    raw, data_stats = validate(windows, output)
    samples, indexer = preprocess(raw, output)
    found = train(samples, indexer, output, model_type, classifier, partitions)
    report = evaluation_report(found["metrics"], found["confusion_pairs"])
    report = _stored(report, output, "evaluation_report")
    gate = _stored(evaluate.quality_gate(found["metrics"]), output, "gate", write_json)
    if strict:
        evaluate.require_gate(gate)
    append_run(spark, f"{output}/runs", output)
    return {
        "raw": raw,
        "samples": samples,
        "data_stats": data_stats,
        **found,
        "evaluation_report": report,
        "gate": gate,
        "runs": spark.read.parquet(f"{output}/runs"),
    }
