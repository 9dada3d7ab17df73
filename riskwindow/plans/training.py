"""Train, evaluate and save one model over one-hot features."""

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskwindow import schema as S
from riskwindow.operators import evaluate, models, split
from riskwindow.operators.features import engineer_features
from riskwindow.operators.quality import require_columns, require_rows
from riskwindow.session import discard, shared_folder
from riskwindow.sources import write_parquet

SPLITS = ("stratified", "random")


@dataclass
class TrainedModel:
    model: PipelineModel
    predictions: DataFrame
    metrics: DataFrame
    confusion: DataFrame
    importances: DataFrame
    folders: tuple[str, ...] = ()

    def discard(self) -> None:
        """Delete the stored split and predictions; the tables above cannot be read afterwards."""
        for folder in self.folders:
            discard(self.predictions.sparkSession, folder)


def train_and_test(
    engineered: DataFrame,
    method: str = "stratified",
    folder: str | None = None,
    test_share: float = S.TEST_SHARE,
    seed: int = S.SEED,
) -> tuple[DataFrame, DataFrame]:
    """(train, test) rows, stored once so that fitting does not derive them again.

    ``random`` is a Bernoulli split and can leave a rare class without test
    rows; ``stratified`` is exact. The rows are kept in ``folder``, by default
    a new one in the cluster's shared folder, which outlives a lost executor.
    """
    spark = engineered.sparkSession
    folder = folder or shared_folder(spark, "split")
    if method == "random":
        write_parquet(engineered, folder)
        return split.random_split(spark.read.parquet(folder), test_share, seed)
    if method != "stratified":
        raise ValueError(f"unknown split {method!r}, expected one of {SPLITS}")
    engineered.persist()
    try:
        parts = split.stratified_split(engineered, S.INCIDENT, test_share, seed)
        write_parquet(parts, folder, ["split"])
    finally:
        engineered.unpersist()
    stored = spark.read.parquet(folder)
    train, test = (
        stored.filter(f"split = '{side}'").drop("split") for side in (split.TRAIN, split.TEST)
    )
    return train, test


def weighted_evaluation(predictions: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row: ROC area and the class-weighted accuracy, precision, recall and F1."""
    area = evaluate.roc_auc(predictions, S.INCIDENT, "rawPrediction")
    return evaluate.weighted_metrics(pairs).select(
        F.lit(area).alias("auc"),
        F.col("weighted_f1").alias("f1"),
        "accuracy",
        F.col("weighted_precision").alias("precision"),
        F.col("weighted_recall").alias("recall"),
    )


def run_training(
    windows: DataFrame,
    model_type: str = "random_forest",
    model_path: str | None = None,
    split_method: str = "stratified",
    classifier=None,
    unseen: str = "keep",
    folder: str | None = None,
    partitions: int | None = None,
) -> TrainedModel:
    """Engineer, split, fit, score and evaluate; save when a path is given.

    ``classifier`` replaces the preset of that name. The split and the scored test rows are
    stored below ``folder``, by default in the shared folder, so the metrics do not score
    them again; ``discard`` of the result deletes them.
    """
    estimator = classifier or models.plain_model(model_type)
    require_columns(windows, S.WINDOW_SCHEMA.names)
    require_rows(windows)
    folder = folder or shared_folder(windows.sparkSession, "training")
    folders = (f"{folder}/split", f"{folder}/predictions")
    engineered = engineer_features(windows, policy="zero")
    train, test = train_and_test(engineered, split_method, folders[0])
    model = models.fit_plain(train, estimator, unseen, partitions)
    write_parquet(models.score(model, test), folders[1])
    predictions = windows.sparkSession.read.parquet(folders[1])
    confusion = evaluate.confusion_pairs(predictions, S.INCIDENT, "prediction")
    metrics = weighted_evaluation(predictions, confusion)
    if model_path:
        models.save_model(model, model_path)
    importances = models.feature_importances(model)
    return TrainedModel(model, predictions, metrics, confusion, importances, folders)
