"""MLlib pipelines, model presets, scoring, importances and persistence."""

import uuid
from collections.abc import Callable, Sequence

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import (
    ElementwiseProduct,
    OneHotEncoder,
    SQLTransformer,
    StandardScaler,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskwindow import schema as S
from riskwindow.functions import quoted
from riskwindow.operators.features import engineer_features
from riskwindow.session import discard

COMPONENT_INDEX = "component_index"
COMPONENT_VECTOR = "component_vec"
COMPONENT_ENCODED = "component_encoded"
SCALED_FEATURES = (*S.NUMERIC_FEATURES, COMPONENT_ENCODED)
WEIGHT = "weight"

MAX_TREE_DEPTH = 30  # the deepest tree MLlib grows
# Room for node statistics, per task; MLlib's default. More of it saves passes at deep levels.
TREE_MEMORY_MB = 256


def component_indexer(order: str = "frequencyDesc", unseen: str = "keep") -> StringIndexer:
    """Category index: by falling frequency, or ``alphabetAsc`` for a plain code.

    ``unseen="keep"`` scores components that were absent from training under
    one extra index; ``unseen="error"`` fails on them.
    """
    return StringIndexer(
        inputCol=S.COMPONENT,
        outputCol=COMPONENT_INDEX,
        stringOrderType=order,
        handleInvalid=unseen,
    )


def feature_stages(unseen: str = "keep") -> list:
    """Index and one-hot encode the component, then assemble it with the eight numbers.

    The last category is dropped. With ``unseen="keep"`` that is the slot for
    unknown components, with ``"error"`` the least frequent component.
    """
    return [
        component_indexer(unseen=unseen),
        OneHotEncoder(inputCols=[COMPONENT_INDEX], outputCols=[COMPONENT_VECTOR], dropLast=True),
        VectorAssembler(
            inputCols=[*S.NUMERIC_FEATURES, COMPONENT_VECTOR],
            outputCol="features",
            handleInvalid="error",
        ),
    ]


def scaled_feature_stages(indexer: StringIndexerModel, train_rows: int) -> list:
    """Alphabetical component code and eight numbers, standardised.

    ``indexer`` is fitted beforehand, on all rows. MLlib's scaler divides by the
    sample deviation; the product turns that into the population deviation.
    """
    if train_rows < 2:
        raise ValueError("scaling needs at least 2 training rows")
    correction = (train_rows / (train_rows - 1)) ** 0.5
    return [
        indexer,
        # The sum drops the category metadata, so that trees see a plain number.
        SQLTransformer(
            statement=f"SELECT *, {COMPONENT_INDEX} + 0.0D AS {COMPONENT_ENCODED} FROM __THIS__"
        ),
        VectorAssembler(
            inputCols=list(SCALED_FEATURES), outputCol="assembled", handleInvalid="error"
        ),
        StandardScaler(inputCol="assembled", outputCol="centred", withMean=True, withStd=True),
        ElementwiseProduct(
            inputCol="centred",
            outputCol="features",
            scalingVec=Vectors.dense([correction] * len(SCALED_FEATURES)),
        ),
    ]


def _forest(
    trees: int, depth: int, seed: int, memory_mb: int, **params
) -> RandomForestClassifier:
    return RandomForestClassifier(
        labelCol=S.INCIDENT,
        featuresCol="features",
        numTrees=trees,
        maxDepth=depth,
        seed=seed,
        maxMemoryInMB=memory_mb,
        **params,
    )


def _boosting(
    iterations: int, depth: int, seed: int, memory_mb: int, **params
) -> GBTClassifier:
    return GBTClassifier(
        labelCol=S.INCIDENT,
        featuresCol="features",
        maxIter=iterations,
        maxDepth=depth,
        seed=seed,
        maxMemoryInMB=memory_mb,
        **params,
    )


def _regression(iterations: int, penalty: float, **params) -> LogisticRegression:
    return LogisticRegression(
        labelCol=S.INCIDENT,
        featuresCol="features",
        maxIter=iterations,
        regParam=penalty,
        **params,
    )


# Presets over one-hot features; the argument is the memory for node statistics.
PLAIN_MODELS: dict[str, Callable[[int], Estimator]] = {
    "random_forest": lambda mb: _forest(100, 10, S.SEED, mb),
    "gbt": lambda mb: _boosting(50, 5, S.SEED, mb),
    "logistic_regression": lambda mb: _regression(100, 0.01),
}

# Presets over scaled features; the first argument is the number of training rows.
SCALED_MODELS: dict[str, Callable[[int, int], Estimator]] = {
    "random_forest": lambda n, mb: _forest(100, 10, S.SEED, mb, weightCol=WEIGHT),
    "gradient_boosting": lambda n, mb: _boosting(100, 5, S.SEED, mb, stepSize=0.1),
    # An L2 strength of C = 1 on a summed loss is 1/n on MLlib's mean loss.
    "logistic_regression": lambda n, mb: _regression(
        1000, 1.0 / n, weightCol=WEIGHT, standardization=False
    ),
}


def plain_model(name: str, tree_memory_mb: int = TREE_MEMORY_MB) -> Estimator:
    """Classifier preset by name; an unknown name is an error."""
    if name.lower() not in PLAIN_MODELS:
        raise ValueError(f"no model preset is called {name!r}; there are {sorted(PLAIN_MODELS)}")
    return PLAIN_MODELS[name.lower()](tree_memory_mb)


def scaled_model(name: str, train_rows: int, tree_memory_mb: int = TREE_MEMORY_MB) -> Estimator:
    """Classifier preset by name; an unknown name gives an unweighted deep forest."""
    if name in SCALED_MODELS:
        return SCALED_MODELS[name](train_rows, tree_memory_mb)
    return _forest(100, MAX_TREE_DEPTH, S.SEED, tree_memory_mb)


def _parted(train: DataFrame, partitions: int | None) -> DataFrame:
    return train if partitions is None else train.coalesce(partitions)


def fit_plain(
    train: DataFrame,
    classifier: Estimator,
    unseen: str = "keep",
    partitions: int | None = None,
) -> PipelineModel:
    """Fit encoder, assembler and classifier on engineered training rows.

    Forests draw their samples per partition. The rows are taken as they lie, unless
    ``partitions`` asks for fewer; the same stored rows give the same model.
    """
    stages = [*feature_stages(unseen), classifier]
    return Pipeline(stages=stages).fit(_parted(train, partitions))


def fit_scaled(
    train: DataFrame,
    indexer: StringIndexerModel,
    classifier: Estimator,
    train_rows: int,
    partitions: int | None = None,
) -> PipelineModel:
    """Fit scaler and classifier on engineered, weighted training rows."""
    stages = [*scaled_feature_stages(indexer, train_rows), classifier]
    return Pipeline(stages=stages).fit(_parted(train, partitions))


def positive_probability(predictions: DataFrame) -> DataFrame:
    """Add the probability of class 1 as ``y_proba``; NULL for rows that were not scored."""
    given = F.col("probability").isNotNull()
    return predictions.withColumn(
        "y_proba", F.when(given, vector_to_array("probability")[1])
    )


def prediction_table(predictions: DataFrame, label: str = S.INCIDENT) -> DataFrame:
    """(y_true, y_pred, y_proba) from scored rows."""
    return positive_probability(predictions).selectExpr(
        f"CAST({label} AS INT) AS y_true", "CAST(prediction AS INT) AS y_pred", "y_proba"
    )


def score(model: PipelineModel, engineered: DataFrame) -> DataFrame:
    """Score engineered rows, batch or streaming.

    A row in which a number is missing (an hour that does not parse, say) is kept, with NULL
    for what the model adds; ``prediction IS NULL`` counts these. The model sees zeros there,
    so that one such row does not end the run.
    """
    if model is None:
        raise ValueError("pass a fitted or a loaded model to score with")
    kinds = dict(engineered.dtypes)
    missing = {
        c: f"({quoted(c)} IS NULL OR isnan({quoted(c)}))"
        if kinds[c] in ("float", "double")
        else f"{quoted(c)} IS NULL"
        for c in S.NUMERIC_FEATURES
    }
    filled = engineered.selectExpr(
        "*",
        f"struct({', '.join(map(quoted, S.NUMERIC_FEATURES))}) AS _given",
        f"NOT ({' OR '.join(missing.values())}) AS _whole",
    ).withColumns(
        {
            c: F.expr(f"IF({test}, CAST(0 AS {kinds[c]}), {quoted(c)})")
            for c, test in missing.items()
        }
    )
    scored = model.transform(filled)
    added = [c for c in scored.columns if c not in filled.columns]
    given = [
        f"_given.{quoted(c)} AS {quoted(c)}" if c in missing else quoted(c)
        for c in engineered.columns
    ]
    return scored.selectExpr(*given, *[f"IF(_whole, {quoted(c)}, NULL) AS {quoted(c)}" for c in added])


def score_windows(
    model: PipelineModel, windows: DataFrame, policy: str = "zero", **thresholds
) -> DataFrame:
    """Engineer and score raw six-column rows, batch or streaming."""
    return score(model, engineer_features(windows, policy, **thresholds))


def feature_importances(
    model: PipelineModel, top: int | None = 10, names: Sequence[str] = S.NUMERIC_FEATURES
) -> DataFrame:
    """(feature, importance), largest first; empty for models without importances.

    Slots after the named ones are component slots in index order.
    """
    spark = SparkSession.active()
    schema = T.StructType(
        [T.StructField("feature", T.StringType()), T.StructField("importance", T.DoubleType())]
    )
    classifier = model.stages[-1]
    if not hasattr(classifier, "featureImportances"):
        return spark.createDataFrame([], schema)
    values = classifier.featureImportances.toArray().tolist()
    labels = [*names, *[f"component_{i}" for i in range(len(values) - len(names))]]
    ranked = spark.createDataFrame(list(zip(labels, values)), schema).orderBy(
        F.desc("importance"), "feature"
    )
    return ranked if top is None else ranked.limit(top)


#: Names the version that counts, in the folder of a saved model.
POINTER = "CURRENT"


def save_model(model: PipelineModel, path: str) -> None:
    """Save a new version of a model below ``path`` and point to it.

    The version is written whole before the pointer file is replaced, in one step where the file
    system renames in one step. A save that fails half-way leaves the model that was there
    before. The version before this one is kept for readers that have begun to load it; older ones
    go, so a path has one writer at a time.
    """
    spark = SparkSession.active()
    before = _current_version(spark, path)
    version = f"version-{uuid.uuid4().hex}"
    model.write().save(f"{path}/{version}")
    _point_to(spark, path, version)
    for old in _versions(spark, path) - {version, before}:
        discard(spark, f"{path}/{old}")


def load_model(path: str) -> PipelineModel:
    """The version that ``path`` points to; a folder without a pointer is a model itself."""
    version = _current_version(SparkSession.active(), path)
    return PipelineModel.load(f"{path}/{version}" if version else path)


def _folder(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _current_version(spark: SparkSession, path: str) -> str | None:
    folder, system = _folder(spark, f"{path}/{POINTER}")
    if not system.exists(folder):
        return None
    return spark.read.text(f"{path}/{POINTER}").first()[0]


def _versions(spark: SparkSession, path: str) -> set[str]:
    folder, system = _folder(spark, path)
    names = (status.getPath().getName() for status in system.listStatus(folder))
    return {name for name in names if name.startswith("version-")}


def _point_to(spark: SparkSession, path: str, version: str) -> None:
    """Replace the pointer file by one rename."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    written, system = _folder(spark, f"{path}/.{POINTER}-{version}")
    out = system.create(written)
    out.write(bytearray(version.encode()))
    out.close()
    pointer = jvm.org.apache.hadoop.fs.Path(f"{path}/{POINTER}")
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), conf)
    files.rename(system.makeQualified(written), system.makeQualified(pointer), options)
