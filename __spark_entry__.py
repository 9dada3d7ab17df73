"""

The test tables hold raw events and no feature table, so every query starts by
rolling the whole ``events`` table up to (component, hour) rows. The mapping is
ours: component = user_id % 6, warnings = events of type ``error``, incident =
any value of 200 or more. The default cut-offs of 5 warnings and 20 lines
never fire on the smaller tables, so the queries pass 1 and 3; the library
defaults stay at 5 and 20.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.ml import Pipeline
from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskwindow import schema as S
from riskwindow.operators import (
    analysis,
    correlation,
    distribution,
    evaluate,
    explore,
    models,
    quality,
    split,
)
from riskwindow.operators.features import engineer_features, with_date_hour
from riskwindow.plans import daily, exploration, sql_suite, training
from riskwindow.plans.incident_pipeline import run_pipeline
from riskwindow.plans.rollup import close_windows
from riskwindow.session import shared_folder
from riskwindow.sources import (
    append_run,
    create_external_table,
    drop_table,
    export_delimited,
    overwrite_table,
    preview,
    read_dated_windows,
    read_delimited,
    save_table,
    use_database,
    windows_from_events,
    write_csv,
    write_json,
    write_windows,
)
from riskwindow.streaming import (
    merge_stream,
    read_batches,
    score_stream,
    windows_from_event_stream,
    write_batches,
    write_stream,
)

SMOKE_DIR = "/root/testdata/sf0.001"
WARN, VOLUME = 1, 3
CUTS = {"warn_threshold": WARN, "volume_threshold": VOLUME}
HIGH, MEDIUM = 0.52, 0.5


MAPPING = {
    "component": "concat('svc.', CAST(user_id % 6 AS STRING))",
    "event": "event_type",
    "warning": "event_type = 'error'",
    "incident": "value >= 200",
}


def windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table of a test data folder."""
    return windows_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"), **MAPPING)


def _rule_scores(df: DataFrame) -> DataFrame:
    """Predictions of a plain rule: an incident where half of the lines are warnings."""
    return df.selectExpr(
        "incident AS y_true",
        "CAST(warn_count / log_volume >= 0.5D AS INT) AS y_pred",
        "warn_count / log_volume AS y_proba",
    )


def _gappy(df: DataFrame) -> DataFrame:
    """Feature table in which quiet windows have no warning count and no warning share."""
    return df.selectExpr(
        "component",
        "time_window",
        "nullif(warn_count, 0) AS warn_count",
        "log_volume",
        "IF(warn_count = 0, CAST('NaN' AS DOUBLE), warn_count / log_volume) AS warn_share",
        "incident",
    )


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.selectExpr(
        *[f"round({c}, 9) AS {c}" if c in columns else f"`{c}`" for c in df.columns]
    )


def _gate_metrics(df: DataFrame) -> DataFrame:
    scored = _rule_scores(df)
    area = evaluate.roc_auc(scored)
    metrics = evaluate.positive_metrics(evaluate.confusion_pairs(scored))
    return metrics.select("accuracy", "f1", F.lit(area).alias("auc"))


def _standardized(df: DataFrame) -> DataFrame:
    """Both sides of a stored split in the nine scaled slots that the incident pipeline fits on."""
    train, test = training.train_and_test(engineer_features(df, "plus_one", **CUTS))
    indexer = models.component_indexer("alphabetAsc").fit(train.unionByName(test))
    scaler = Pipeline(stages=models.scaled_feature_stages(indexer, train.count())).fit(train)
    sides = train.withColumn("split", F.lit("train")).unionByName(
        test.withColumn("split", F.lit("test"))
    )
    slots = scaler.transform(sides).withColumn("features", vector_to_array("features"))
    names = models.SCALED_FEATURES
    return slots.selectExpr(
        S.COMPONENT,
        S.TIME_WINDOW,
        "split",
        *[f"round(features[{i}], 9) AS scaled_{c}" for i, c in enumerate(names)],
    )


def _class_weights(df: DataFrame) -> DataFrame:
    """The weight that training gives the rows of a class."""
    weighted = split.with_class_weight(df, split.label_counts(df))
    return weighted.groupBy(S.INCIDENT, "weight").agg(F.expr("count(*) AS n"))


def _indexed(df: DataFrame, order: str) -> DataFrame:
    model = models.component_indexer(order).fit(df)
    return model.transform(df).select(S.COMPONENT, S.TIME_WINDOW, models.COMPONENT_INDEX)


def _plain(df: DataFrame, name: str):
    """A preset over one-hot features, and the rows to score."""
    train, test = training.train_and_test(engineer_features(df, "zero", **CUTS))
    return models.fit_plain(train, models.plain_model(name)), test


def _scaled(df: DataFrame, name: str):
    """A preset over scaled features, and the rows to score."""
    train, test = training.train_and_test(engineer_features(df, "plus_one", **CUTS))
    indexer = models.component_indexer("alphabetAsc").fit(train.unionByName(test))
    counts = split.label_counts(train)
    n = sum(counts.values())
    weighted = split.with_class_weight(train, counts)
    return models.fit_scaled(weighted, indexer, models.scaled_model(name, n), n), test


def _scored(model, rows: DataFrame) -> DataFrame:
    return _scored_columns(models.score(model, rows))


def _scored_columns(scored: DataFrame) -> DataFrame:
    return models.positive_probability(scored).select(
        S.COMPONENT, S.TIME_WINDOW, S.INCIDENT, "prediction", "y_proba"
    )


def _reloaded(df: DataFrame) -> DataFrame:
    model, test = _plain(df, "logistic_regression")
    path = shared_folder(df.sparkSession, "model")
    models.save_model(model, path)
    return _scored(models.load_model(path), test)


def _run_report(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    folder = shared_folder(spark, "run")
    return run_pipeline(spark, df, folder, "logistic_regression")["evaluation_report"]


def _model_metrics(df: DataFrame) -> DataFrame:
    model, test = _scaled(df, "logistic_regression")
    predictions = models.prediction_table(models.score(model, test))
    area = evaluate.roc_auc(predictions)
    return evaluate.positive_metrics(evaluate.confusion_pairs(predictions)).select(
        F.lit("logistic_regression").alias("model_type"), "*", F.lit(area).alias("auc")
    )


def _assembled(df: DataFrame, unseen: str = "keep") -> DataFrame:
    """The assembled vector, one column per slot of the fitted encoder."""
    engineered = engineer_features(df, "zero", **CUTS)
    fitted = Pipeline(stages=models.feature_stages(unseen)).fit(engineered)
    slots = len(S.NUMERIC_FEATURES) + len(fitted.stages[0].labels) - (unseen != "keep")
    return (
        fitted.transform(engineered)
        .withColumn("features", vector_to_array("features"))
        .selectExpr(
            "component", "time_window", *[f"features[{i}] AS slot_{i:02d}" for i in range(slots)]
        )
    )


# Checks of results that depend on a seed or a fitted model: what must hold for any of them,
# as counts that SQL gives too.

MODELS = {
    "rf": (_plain, "random_forest"),
    "gbt": (_plain, "gbt"),
    "lr": (_plain, "logistic_regression"),
    "balanced_rf": (_scaled, "random_forest"),
    "balanced_lr": (_scaled, "logistic_regression"),
    "gb100": (_scaled, "gradient_boosting"),
}


def _scored_rows(df: DataFrame, model: str) -> DataFrame:
    """Keys and label of the rows that a model scores; must be the test side of the split."""
    fit, name = MODELS[model]
    scored = _scored(*fit(df, name))
    sound = "y_proba BETWEEN 0 AND 1 AND prediction = CAST(y_proba > 0.5 AS INT)"
    return scored.selectExpr(S.COMPONENT, S.TIME_WINDOW, S.INCIDENT, f"{sound} AS sound")


def _random_split_check(df: DataFrame) -> DataFrame:
    keys = [S.COMPONENT, S.TIME_WINDOW]
    sides = _randomly_split(df).groupBy(*keys).agg(
        F.expr("count(*) AS n"), F.expr("count(DISTINCT split) AS sides")
    )
    joined = df.select(*keys).join(sides, keys, "left")
    return joined.agg(
        F.expr("count(*) AS row_count"),
        F.expr("count_if(n IS NULL) AS lost"),
        F.expr("count_if(sides > 1) AS on_both_sides"),
    )


def _reload_check(df: DataFrame) -> DataFrame:
    """A saved model scores as the one that was saved."""
    model, test = _plain(df, "logistic_regression")
    path = shared_folder(df.sparkSession, "model")
    models.save_model(model, path)
    keys = [S.COMPONENT, S.TIME_WINDOW]
    before = _scored(model, test).select(*keys, F.col("y_proba").alias("before"))
    after = _scored(models.load_model(path), test).select(*keys, F.col("y_proba").alias("after"))
    return before.join(after, keys).agg(
        F.expr("count(*) AS row_count"), F.expr("max(abs(before - after)) AS difference")
    )


def _importance_check(df: DataFrame) -> DataFrame:
    found = models.feature_importances(_plain(df, "random_forest")[0], top=None)
    return found.agg(
        F.expr("count(DISTINCT feature) AS slots"), F.expr("round(sum(importance), 6) AS total")
    )


# Each metric from the scored rows, without the operators that the runs use.
_AGAIN = {
    "accuracy": "avg(CAST(y_pred = y_true AS INT))",
    "precision": "coalesce(try_divide(count_if(y_pred = 1 AND y_true = 1), count_if(y_pred = 1)), 0D)",
    "recall": "coalesce(try_divide(count_if(y_pred = 1 AND y_true = 1), count_if(y_true = 1)), 0D)",
    "f1": "coalesce(try_divide(2 * count_if(y_pred = 1 AND y_true = 1),"
    " count_if(y_pred = 1) + count_if(y_true = 1)), 0D)",
}


#: Ranges of the score that the ROC area is summed over.
_RANGES = 1000


def _area_again(predictions: DataFrame, score: str) -> DataFrame:
    """The ROC area: pairs of a positive and a lower negative, equal scores as half, by ranges of the score.

    0 when one class is absent, as in ``evaluate.roc_auc``: in a dense log every window has an incident.
    """
    counts = predictions.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.expr("count_if(y_true = 1) AS pos"), F.expr("count_if(y_true = 0) AS neg")
    )
    bounds = sorted(set(counts.approxQuantile("score", [i / _RANGES for i in range(1, _RANGES)], 0.1 / _RANGES)))
    cut = Bucketizer(splits=[-float("inf"), *(bounds or [0.0]), float("inf")], inputCol="score", outputCol="part")
    ranged = cut.transform(counts)
    before = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    # One row for each range, so the window without partition is small at any size of the table.
    below = ranged.groupBy("part").agg(F.sum("neg").alias("neg")).selectExpr(
        "part", f"coalesce(sum(neg) OVER (ORDER BY part {before}), 0) AS below"
    )
    return ranged.join(below, "part").selectExpr(
        "pos",
        "neg",
        f"below + coalesce(sum(neg) OVER (PARTITION BY part ORDER BY score {before}), 0) AS lower",
    ).selectExpr("coalesce(try_divide(sum(pos * (lower + neg / 2)), sum(pos) * sum(neg)), 0D) AS auc")


def _difference(reported: DataFrame, predictions: DataFrame, again: dict) -> DataFrame:
    """Whether each reported metric equals the one computed anew; the ROC area of tests is small data."""
    anew = predictions.agg(*[F.expr(f"{e} AS {m}") for m, e in again.items()]).first()
    area = _area_again(predictions, "y_proba").first()["auc"]
    expected = {**anew.asDict(), "auc": area}
    return reported.selectExpr(
        *[f"abs({m} - {float(v)!r}D) < 1e-9 AS {m}_equal" for m, v in expected.items()]
    )


def _model_metrics_check(df: DataFrame) -> DataFrame:
    model, test = _scaled(df, "logistic_regression")
    predictions = models.prediction_table(models.score(model, test))
    area = evaluate.roc_auc(predictions)
    metrics = evaluate.positive_metrics(evaluate.confusion_pairs(predictions))
    return _difference(metrics.withColumn("auc", F.lit(area)), predictions, _AGAIN)


def _training_metrics_check(df: DataFrame) -> DataFrame:
    run = training.run_training(df, "logistic_regression")
    predictions = models.prediction_table(run.predictions)
    weighted = {
        m: " + ".join(
            f"count_if(y_true = {c}) / count(*) * ({e})"
            for c in (0, 1)
            for e in [_AGAIN[m].replace("= 1", f"= {c}")]
        )
        for m in ("precision", "recall", "f1")
    }
    again = {"accuracy": _AGAIN["accuracy"], **weighted}
    return _difference(run.metrics, predictions, again)


def _run_report_check(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    found = run_pipeline(spark, df, shared_folder(spark, "run"), "logistic_regression")
    names = [*_AGAIN, "auc"]
    report = found["evaluation_report"].filter("section = 'performance'")
    wide = report.groupBy().pivot("metric", names).agg(F.expr("max(CAST(value AS DOUBLE))"))
    return _difference(wide, found["predictions"], _AGAIN)


# Round trips through every way in and out.


def _awkward(df: DataFrame) -> DataFrame:
    """Windows with missing counts and with commas and quotes in the component's name."""
    return df.selectExpr(
        "IF(component = 'svc.1', 'svc,\"1\"', component) AS component",
        "time_window",
        "CAST(nullif(warn_count, 0) AS INT) AS warn_count",
        "CAST(log_volume AS INT) AS log_volume",
        "CAST(unique_event_count AS INT) AS unique_event_count",
        "incident",
    )


def _texts(df: DataFrame) -> DataFrame:
    """All cells as texts, NULL where they are missing, so that no type is lost in a comparison."""
    return df.selectExpr(*[f"CAST({c} AS STRING) AS {c}" for c in S.WINDOW_SCHEMA.names])


def _csv_round_trip(df: DataFrame) -> DataFrame:
    path = shared_folder(df.sparkSession, "csv")
    write_csv(_awkward(df), path)
    return _texts(read_delimited(df.sparkSession, path))


def _inferred_csv(df: DataFrame) -> DataFrame:
    path = shared_folder(df.sparkSession, "csv")
    write_csv(_awkward(df), path)
    return _texts(read_delimited(df.sparkSession, path, infer=True, null_markers=["svc.2"]))


def _export_round_trip(df: DataFrame) -> DataFrame:
    path = shared_folder(df.sparkSession, "export")
    export_delimited(_awkward(df), path, sep="|")
    rows = read_delimited(df.sparkSession, path, sep="|", header=False, null_markers=["\\N"])
    return _texts(rows)


def _json_round_trip(df: DataFrame) -> DataFrame:
    path = shared_folder(df.sparkSession, "json")
    write_json(_awkward(df), path)
    return _texts(df.sparkSession.read.schema(S.WINDOW_SCHEMA).json(path))


#: A day that is written twice, in the middle of the test tables' month.
_REWRITTEN = "240115"


def _dated_storage(df: DataFrame) -> DataFrame:
    """A table by date, stored in two writes; the last day of the first one is unfinished and written again."""
    spark = df.sparkSession
    path = shared_folder(spark, "dated")
    unfinished = f"date_of < '{_REWRITTEN}' OR (date_of = '{_REWRITTEN}' AND hour_of < 12)"
    dated = df.selectExpr("*", "substr(time_window, 1, 6) AS date_of", "CAST(substr(time_window, 8, 2) AS INT) AS hour_of")
    write_windows(dated.filter(unfinished).drop("date_of", "hour_of"), path)
    write_windows(dated.filter(f"date_of >= '{_REWRITTEN}'").drop("date_of", "hour_of"), path)
    return read_dated_windows(spark, path)


def _dated_range(df: DataFrame, first: str, last: str) -> DataFrame:
    """Some days of a table by date: only their folders are read."""
    path = shared_folder(df.sparkSession, "dated")
    write_windows(df, path)
    return read_dated_windows(df.sparkSession, path, first, last)


def _days(df: DataFrame, name: str = "partials", first: str | None = None, last: str | None = None) -> DataFrame:
    """What is stored for each date, from two runs: the second one adds dates and renews one."""
    path = shared_folder(df.sparkSession, "days")
    daily.store_days(df.filter(f"time_window < '{_REWRITTEN}_12'"), path)
    daily.store_days(df.filter(f"time_window >= '{_REWRITTEN}_00'"), path)
    return daily.read_days(df.sparkSession, path, name, first, last)


#: Ranges of dates that the sketches are asked about.
_RANGES_OF_DATES = (("240101", "240103"), ("240110", "240125"), ("240101", "240131"))


def _distinct_by_range(df: DataFrame) -> DataFrame:
    """Components with a high volume per range of dates; few enough for the sketch to be exact."""
    days = _days(df, "sketches")
    parts = [
        daily.distinct_components(days.filter(f"date_part BETWEEN '{a}' AND '{b}'")).selectExpr(
            f"'{a}' AS first", f"'{b}' AS last", "unique_components"
        )
        for a, b in _RANGES_OF_DATES
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _quantile_sketch_check(df: DataFrame) -> DataFrame:
    """Whether each quartile of the merged sketches has the rank that it should have, within 2 %."""
    found = daily.approximate_quantiles(_days(df, "sketches")).unpivot(
        ["feature", "count"], ["p25", "p50", "p75"], "quantile", "asked"
    )
    ranks = distribution.value_frequencies(df, S.MEASURES).join(F.broadcast(found), "feature")
    wanted = "any_value(CAST(substr(quantile, 2) AS DOUBLE)) / 100"
    return ranks.groupBy("feature", "quantile", "count").agg(
        F.expr(
            f"sum(IF(value < asked, n, 0)) <= ({wanted} + 0.02D) * sum(n)"
            f" AND sum(IF(value <= asked, n, 0)) >= ({wanted} - 0.02D) * sum(n) AS close"
        )
    )


def _in_database(build: Callable[[SparkSession, DataFrame], DataFrame]):
    """Runs in a database of its own below the shared folder; the result is stored before it goes."""

    def run(df: DataFrame) -> DataFrame:
        spark = df.sparkSession
        before, path = spark.catalog.currentDatabase(), shared_folder(spark, "database")
        name = "riskwindow_" + path.rsplit("-", 1)[-1]
        use_database(spark, name, path)
        try:
            out = shared_folder(spark, "loaded")
            build(spark, df).write.parquet(out)
        finally:
            spark.catalog.setCurrentDatabase(before)
            spark.sql(f"DROP DATABASE {name} CASCADE")
        return spark.read.parquet(out)

    return run


def _external_table(spark: SparkSession, df: DataFrame) -> DataFrame:
    path = shared_folder(spark, "external")
    write_csv(_awkward(df), path)
    return _texts(create_external_table(spark, "outside", path))


def _dropped_table(spark: SparkSession, df: DataFrame) -> DataFrame:
    save_table(_awkward(df), "kept")
    save_table(_awkward(df), "gone")
    drop_table(spark, "gone")
    drop_table(spark, "gone")
    return spark.table("kept").agg(
        F.expr("count(*) AS kept_rows"),
        F.lit(spark.catalog.tableExists("gone")).alias("still_there"),
    )


def _overwritten_table(spark: SparkSession, df: DataFrame) -> DataFrame:
    save_table(_awkward(df).limit(5), "loaded")
    columns = _awkward(df).columns
    overwrite_table(_awkward(df).select(*reversed(columns)), "loaded")  # another order of columns
    return _texts(spark.table("loaded"))


def _run_log(df: DataFrame) -> DataFrame:
    """One run is recorded for each component, in turn."""
    spark, path = df.sparkSession, shared_folder(df.sparkSession, "runs")
    for row in explore.value_counts(df, S.COMPONENT).collect():
        append_run(spark, path, f"{row[0]}: {row[1]}")
    return spark.read.parquet(path).select("results")


def _with_zero_divisors(df: DataFrame) -> DataFrame:
    """Some windows without distinct events, some where their number is missing."""
    return df.withColumn(
        S.UNIQUE_EVENT_COUNT,
        F.expr(
            "CASE WHEN log_volume % 3 = 0 THEN 0 WHEN log_volume % 5 = 0 THEN NULL"
            " ELSE unique_event_count END"
        ),
    )


def _ratio(policy: str):
    return lambda f: engineer_features(_with_zero_divisors(f), policy, **CUTS).select(
        S.COMPONENT, S.TIME_WINDOW, S.EVENT_RATIO
    )


def _with_nan(df: DataFrame) -> DataFrame:
    return df.selectExpr(
        "IF(log_volume % 4 = 0, double('NaN'), CAST(warn_count AS DOUBLE)) AS warn_share",
        "CAST(log_volume AS DOUBLE) AS log_volume",
        "incident",
    )


def _randomly_split(df: DataFrame) -> DataFrame:
    # Stored first: the draw depends on the layout, and a stored table keeps its layout.
    path = shared_folder(df.sparkSession, "split")
    df.write.parquet(path)
    train, test = split.random_split(df.sparkSession.read.parquet(path))
    return train.withColumn("split", F.lit("train")).unionByName(
        test.withColumn("split", F.lit("test"))
    )


def _summary_table(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    before = spark.catalog.currentDatabase()
    use_database(spark, "riskwindow_check", shared_folder(spark, "database"))
    try:
        return save_table(sql_suite.summary(df, **CUTS), "riskwindow_check.features_summary")
    finally:
        spark.catalog.setCurrentDatabase(before)


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sf_dir}/events.parquet"
    # A stream takes a folder or a pattern; this pattern fits a single file and a folder of parts.
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(
        path.removesuffix("t") + "[t]"
    )


def _stored_stream(stream: DataFrame, name: str) -> DataFrame:
    spark = stream.sparkSession
    path = shared_folder(spark, name)
    write_stream(stream, path, f"{path}-progress", available_now=True).awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def _streamed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = windows_from_event_stream(_event_stream(spark, sf_dir), **MAPPING)
    return _stored_stream(stream, "windows")


def _streamed_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, _ = _plain(windows(spark, sf_dir), "logistic_regression")
    stream = windows_from_event_stream(_event_stream(spark, sf_dir), **MAPPING)
    return _stored_stream(_scored_columns(score_stream(model, stream, **CUTS)), "scores")


def _closed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream merged into a table by date, and a closing batch for the hours that it has left open."""
    path = shared_folder(spark, "closed")
    stream = windows_from_event_stream(_event_stream(spark, sf_dir), **MAPPING)
    merge_stream(stream, path, f"{path}-progress", available_now=True).awaitTermination()
    close_windows(spark.read.parquet(f"{sf_dir}/events.parquet"), path, **MAPPING)
    return read_dated_windows(spark, path)


def _late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with even ids come first, the others in a second run, when most of their hours are closed."""
    path = shared_folder(spark, "late")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    for half in (0, 1):
        events.filter(f"event_id % 2 = {half}").write.mode("append").parquet(f"{path}-events")
        found = spark.readStream.schema(events.schema).parquet(f"{path}-events")
        stream = windows_from_event_stream(found, **MAPPING)
        merge_stream(stream, path, f"{path}-progress", available_now=True).awaitTermination()
    return close_windows(events, path, **MAPPING)


def _batched_scores_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored batches of scores hold each window once."""
    model, _ = _plain(windows(spark, sf_dir), "logistic_regression")
    scores = _scored_columns(
        score_stream(model, windows_from_event_stream(_event_stream(spark, sf_dir), **MAPPING), **CUTS)
    )
    path = shared_folder(spark, "batches")
    write_batches(scores, path, f"{path}-progress", available_now=True).awaitTermination()
    return read_batches(spark, path).selectExpr(
        S.COMPONENT, S.TIME_WINDOW, S.INCIDENT, "y_proba BETWEEN 0 AND 1 AS sound"
    )


def _described(df: DataFrame) -> DataFrame:
    columns = [*S.MEASURES, S.INCIDENT, S.HOUR]
    return _rounded(
        distribution.describe_columns(with_date_hour(df), columns), "mean", "std"
    )


def _over_windows(build: Callable[[DataFrame], DataFrame]):
    return lambda spark, sf_dir: build(windows(spark, sf_dir))


def _over_scores(build: Callable[[DataFrame], DataFrame]):
    return lambda spark, sf_dir: build(_rule_scores(windows(spark, sf_dir)))


def _over_pairs(build: Callable[[DataFrame], DataFrame]):
    return _over_scores(lambda scored: build(evaluate.confusion_pairs(scored)))


def entry(spark: SparkSession) -> DataFrame:
    """Which component fails most?"""
    return analysis.incident_rate_by_component(windows(spark, SMOKE_DIR))


def _text_operators() -> tuple[dict, dict]:
    """Queries and SQL of the text operators, where they are installed."""
    try:
        import corpus_pipeline  # noqa: F401
        from riskwindow.llm import registry
    except ModuleNotFoundError as missing:
        if missing.name not in ("corpus_pipeline", "riskwindow.llm"):
            raise
        return {}, {}
    return registry.queries(), registry.oracle_sql()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _window_queries() | _text_operators()[0]


def _window_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    measures = list(S.MEASURES)
    matrix = [*measures, S.INCIDENT]
    frequencies, profile = distribution.value_frequencies, explore.group_profile
    over_windows = {
        "derive_features": lambda f: f,
        # Projections
        "features_null_ratio": lambda f: engineer_features(f, "null", with_hour=False, **CUTS),
        "features_zero_ratio": lambda f: engineer_features(f, "zero", **CUTS),
        "features_plus_one_ratio": lambda f: engineer_features(f, "plus_one", **CUTS),
        "window_date_hour": lambda f: with_date_hour(f).select(
            S.COMPONENT, S.TIME_WINDOW, S.DATE, S.HOUR
        ),
        "summary_table": _summary_table,
        "preview_rows": lambda f: preview(f, 10),
        # Quality and profile
        "dataset_shape": quality.shape,
        "schema_table": quality.schema_table,
        "missing_per_column": lambda f: quality.missing_by_column(_gappy(f)),
        "missing_present": lambda f: quality.missing_by_column(_gappy(f), only_present=True),
        "missing_total": lambda f: quality.missing_total(_gappy(f)),
        "dataset_stats": lambda f: quality.dataset_stats(f, windows=True),
        "describe_numeric": _described,
        # SQL suite
        "basic_statistics": analysis.basic_statistics,
        "incident_rate_by_component": analysis.incident_rate_by_component,
        "incidents_by_date": analysis.incidents_by_date,
        "component_feature_ranges": analysis.component_feature_ranges,
        "high_risk_windows": analysis.high_risk_windows,
        "component_warning_category": lambda f: analysis.component_warning_category(
            f, HIGH, MEDIUM
        ),
        # Exploration
        "value_counts_component": lambda f: explore.value_counts(f, S.COMPONENT),
        "value_counts_incident": lambda f: explore.value_counts(f, S.INCIDENT),
        "target_rate": explore.target_rate,
        "component_card": lambda f: explore.component_card(profile(f, [S.COMPONENT])),
        "date_stats": lambda f: explore.date_stats(profile(f, [S.DATE])),
        "hour_stats": lambda f: explore.hour_stats(profile(f, [S.HOUR])),
        "stats_by_incident": lambda f: _rounded(explore.stats_by_incident(f), "mean", "std"),
        "correlation_matrix": lambda f: _rounded(correlation.correlation_matrix(f, matrix), "r"),
        "correlation_heatmap": lambda f: correlation.correlation_heatmap(f, matrix),
        "correlation_with_target": lambda f: _rounded(
            correlation.correlation_with_target(with_date_hour(f), [*matrix, S.HOUR]), "r"
        ),
        "class_share": lambda f: explore.class_share(explore.value_counts(f, S.INCIDENT)),
        "component_series": lambda f: explore.component_series(profile(f, [S.COMPONENT])),
        "histogram_30": lambda f: _rounded(
            distribution.histogram(frequencies(f, measures)), "bin_start", "bin_end"
        ),
        "box_stats": lambda f: distribution.box_statistics(frequencies(f, measures)),
        "box_stats_by_incident": lambda f: distribution.box_statistics(
            frequencies(f, measures, [S.INCIDENT]), [S.INCIDENT]
        ),
        "box_outliers": lambda f: distribution.outlier_values(frequencies(f, measures)),
        "scatter_density": explore.scatter_density,
        "date_hour_series": lambda f: explore.date_hour_series(profile(f, [S.DATE, S.HOUR])),
        "eda_report": lambda f: _rounded(exploration.eda_report(f), "value"),
        "top10_windows": explore.top_windows,
        # Preparation for models
        "component_frequency_index": lambda f: _indexed(f, "frequencyDesc"),
        "component_alpha_index": lambda f: _indexed(f, "alphabetAsc"),
        "stratified_split": split.stratified_split,
        "standardized_train": _standardized,
        "class_weights": _class_weights,
        "random_split": _randomly_split,
        "assembled_features": _assembled,
        "assembled_features_strict": lambda f: _assembled(f, "error"),
        "ratio_null_divisors": _ratio("null"),
        "ratio_zero_divisors": _ratio("zero"),
        "ratio_plus_one_divisors": _ratio("plus_one"),
        "correlation_with_nan": lambda f: _rounded(
            correlation.correlation_matrix(_with_nan(f)), "r"
        ),
        # Ways in and out
        "csv_round_trip": _csv_round_trip,
        "csv_inferred": _inferred_csv,
        "export_round_trip": _export_round_trip,
        "json_round_trip": _json_round_trip,
        "dated_storage": _dated_storage,
        "dated_range": lambda f: _dated_range(f, "240110", "240119"),
        # Tables stored for each date
        "daily_basic_statistics": lambda f: daily.basic_statistics(_days(f)),
        "daily_incident_rate": lambda f: daily.incident_rate_by_component(_days(f)),
        "daily_incidents_by_date": lambda f: daily.incidents_by_date(_days(f)),
        "daily_feature_ranges": lambda f: daily.component_feature_ranges(_days(f)),
        "daily_warning_category": lambda f: daily.component_warning_category(_days(f), HIGH, MEDIUM),
        "daily_component_card": lambda f: explore.component_card(daily.group_profile(_days(f))),
        "daily_date_stats": lambda f: explore.date_stats(daily.group_profile(_days(f))),
        "daily_hour_stats": lambda f: explore.hour_stats(daily.group_profile(_days(f))),
        "daily_dataset_stats": lambda f: daily.dataset_stats(_days(f)),
        "daily_missing": lambda f: daily.missing_by_column(_days(_awkward(f))),
        "distinct_by_range": _distinct_by_range,
        "quantile_sketch_check": _quantile_sketch_check,
        "external_table": _in_database(_external_table),
        "dropped_table": _in_database(_dropped_table),
        "overwritten_table": _in_database(_overwritten_table),
        "run_log": _run_log,
        # Checks of fitted results
        "random_split_check": _random_split_check,
        "reloaded_predictions_check": _reload_check,
        "importances_check": _importance_check,
        "model_metrics_check": _model_metrics_check,
        "training_metrics_check": _training_metrics_check,
        "run_report_check": _run_report_check,
        **{f"{m}_scored_rows": lambda f, m=m: _scored_rows(f, m) for m in MODELS},
        # Models
        "rf_predictions": lambda f: _scored(*_plain(f, "random_forest")),
        "gbt_predictions": lambda f: _scored(*_plain(f, "gbt")),
        "lr_predictions": lambda f: _scored(*_plain(f, "logistic_regression")),
        "balanced_rf_predictions": lambda f: _scored(*_scaled(f, "random_forest")),
        "balanced_lr_predictions": lambda f: _scored(*_scaled(f, "logistic_regression")),
        "gb100_predictions": lambda f: _scored(*_scaled(f, "gradient_boosting")),
        "rf_importances": lambda f: models.feature_importances(_plain(f, "random_forest")[0]),
        "reloaded_predictions": _reloaded,
        "model_metrics": _model_metrics,
        "training_metrics": lambda f: training.run_training(f, "logistic_regression").metrics,
        "run_report": _run_report,
        "quality_gate": lambda f: evaluate.quality_gate(_gate_metrics(f)),
    }
    over_pairs = {
        "confusion_pairs": lambda pairs: pairs,
        "confusion_matrix": evaluate.confusion_matrix,
        "accuracy": evaluate.accuracy,
        "weighted_metrics": evaluate.weighted_metrics,
        "positive_metrics": evaluate.positive_metrics,
        "classification_report": evaluate.classification_report,
        "prediction_totals": evaluate.prediction_totals,
    }
    over_scores = {
        "rank_auc": lambda scored: _rounded(evaluate.rank_auc(scored), "auc"),
    }
    return {
        **{name: _over_windows(build) for name, build in over_windows.items()},
        **{name: _over_pairs(build) for name, build in over_pairs.items()},
        **{name: _over_scores(build) for name, build in over_scores.items()},
        "streamed_windows": _streamed_windows,
        "streamed_scores": _streamed_scores,
        "closed_windows": _closed_windows,
        "late_events": _late_events,
        "batched_scores_check": _batched_scores_check,
        "streamed_scores_check": lambda spark, sf_dir: _streamed_scores(spark, sf_dir).selectExpr(
            S.COMPONENT, S.TIME_WINDOW, S.INCIDENT, "y_proba BETWEEN 0 AND 1 AS sound"
        ),
    }


# ---------------------------------------------------------------------------
# The same questions in SQL for DuckDB.

_WINDOWS = """
f AS (
  SELECT 'svc.' || CAST(user_id % 6 AS VARCHAR) AS component,
         strftime(ts, '%y%m%d_%H') AS time_window,
         CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS warn_count,
         count(*) AS log_volume,
         count(DISTINCT event_type) AS unique_event_count,
         max(CASE WHEN value >= 200 THEN 1 ELSE 0 END) AS incident
  FROM events GROUP BY 1, 2)"""

#: Events of the second run are late where the first one has closed their hour; windows that hold no
#: event that came in time, and those still open in the end, are not stored.
_LATE_SQL = """
WITH e AS (SELECT 'svc.' || CAST(user_id % 6 AS VARCHAR) AS component, ts, event_id,
                  strftime(ts, '%y%m%d_%H') AS time_window,
                  date_trunc('hour', ts) + INTERVAL 1 HOUR AS hour_end FROM events),
m AS (SELECT max(ts) FILTER (event_id % 2 = 0) - INTERVAL 2 HOUR AS first_mark, max(ts) - INTERVAL 2 HOUR AS last_mark
      FROM e),
w AS (SELECT component, time_window, substr(time_window, 1, 6) AS date_part, count(*) AS n,
             count(*) FILTER (hour_end <= last_mark AND (event_id % 2 = 0 OR hour_end > first_mark)) AS stored
      FROM e, m GROUP BY ALL)
SELECT date_part, count(*) FILTER (stored = 0) AS added_windows,
       CAST(coalesce(sum(n) FILTER (stored = 0), 0) AS BIGINT) AS added_events,
       count(*) FILTER (stored > 0) AS changed_windows,
       CAST(coalesce(sum(n - stored) FILTER (stored > 0), 0) AS BIGINT) AS late_events
FROM w WHERE stored < n GROUP BY date_part"""

_SCORES = """
s AS (
  SELECT incident AS y_true,
         CASE WHEN warn_count / log_volume >= 0.5 THEN 1 ELSE 0 END AS y_pred,
         warn_count / log_volume AS y_proba
  FROM f)"""

_GAPPY = """
g AS (
  SELECT component, time_window, nullif(warn_count, 0) AS warn_count, log_volume,
         CASE WHEN warn_count = 0 THEN CAST('NaN' AS DOUBLE)
              ELSE warn_count / log_volume END AS warn_share,
         incident
  FROM f)"""

_AWKWARD = """
k AS (
  SELECT CASE WHEN component = 'svc.1' THEN 'svc,"1"' ELSE component END AS component, time_window,
         CAST(nullif(warn_count, 0) AS INTEGER) AS warn_count,
         CAST(log_volume AS INTEGER) AS log_volume,
         CAST(unique_event_count AS INTEGER) AS unique_event_count, incident
  FROM f)"""

_LONG = """
m AS (
  SELECT incident, 'warn_count' AS feature, warn_count AS value FROM f
  UNION ALL SELECT incident, 'log_volume', log_volume FROM f
  UNION ALL SELECT incident, 'unique_event_count', unique_event_count FROM f)"""

_ENGINEERED = f"""component, time_window, warn_count, log_volume, unique_event_count, incident,
  CAST(warn_count AS BIGINT) * log_volume AS warn_log_interaction,
  {{ratio}} AS log_per_event_ratio,
  CASE WHEN warn_count > {WARN} THEN 1 ELSE 0 END AS high_warn_flag,
  CASE WHEN log_volume > {VOLUME} THEN 1 ELSE 0 END AS high_log_volume_flag"""

_HOUR = "CAST(substr(time_window, 8, 2) AS INTEGER)"

_REPORT_FEATURES = {
    "warn_count": "warn_count",
    "log_volume": "log_volume",
    "unique_event_count": "unique_event_count",
    "incident": "incident",
    "hour": _HOUR,
}


_NAN_COLUMNS = {
    "warn_share": "CASE WHEN log_volume % 4 <> 0 THEN CAST(warn_count AS DOUBLE) END",
    "log_volume": "CAST(log_volume AS DOUBLE)",
    "incident": "incident",
}


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


def _split_sql(columns: list[str], source: str) -> str:
    """The exact stratified split as one ranking per class."""
    text = " || '|' || ".join(["'42'", *[f"CAST({c} AS VARCHAR)" for c in columns]])
    return f"""
h AS (SELECT *, md5({text}) AS h FROM {source}),
r AS (SELECT *, row_number() OVER (PARTITION BY incident ORDER BY h) AS place FROM h),
c AS (SELECT incident, count(*) AS n FROM f GROUP BY 1),
t AS (SELECT sum(n) AS total, sum(n) - ceil(0.2 * sum(n)) AS n_train FROM c),
w AS (SELECT incident, n, floor(n * n_train / total) AS low,
             n * n_train / total - floor(n * n_train / total) AS rest, n_train
      FROM c, t),
a AS (SELECT incident, n - low - CASE WHEN row_number() OVER (ORDER BY rest DESC, incident)
                 <= n_train - sum(low) OVER () THEN 1 ELSE 0 END AS n_test FROM w),
p AS (SELECT r.*, CASE WHEN place <= n_test THEN 'test' ELSE 'train' END AS split
      FROM r JOIN a USING (incident))"""


def _describe_sql(feature: str, expression: str) -> str:
    return f"""
  SELECT '{feature}' AS feature, count({expression}) AS count,
         round(avg({expression}), 9) AS mean, round(stddev_samp({expression}), 9) AS std,
         CAST(min({expression}) AS DOUBLE) AS min,
         quantile_cont({expression}, 0.25) AS p25, quantile_cont({expression}, 0.5) AS p50,
         quantile_cont({expression}, 0.75) AS p75, CAST(max({expression}) AS DOUBLE) AS max
  FROM f"""


def _correlation_sql(columns: list[str], digits: int) -> str:
    rows = [
        f"SELECT '{x}' AS x, '{y}' AS y, round(corr({x}, {y}), {digits}) AS r FROM f"
        for x in columns
        for y in columns
    ]
    return _with(_WINDOWS) + " " + " UNION ALL ".join(rows)


def _nan_correlation() -> str:
    rows = [
        f"SELECT '{x}' AS x, '{y}' AS y, round(corr({a}, {b}), 9) AS r FROM f"
        for x, a in _NAN_COLUMNS.items()
        for y, b in _NAN_COLUMNS.items()
    ]
    return _with(_WINDOWS) + " " + " UNION ALL ".join(rows)


def _box_sql(by: str) -> str:
    keys = f"{by}feature"
    return (
        _with(_WINDOWS, _LONG)
        + f""",
q AS (SELECT {keys}, quantile_cont(value, 0.25) AS q1, median(value) AS median,
             quantile_cont(value, 0.75) AS q3 FROM m GROUP BY ALL),
v AS (SELECT m.*, q1, median, q3,
             value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
      FROM m JOIN q USING ({keys}))"""
    )


def _box_result(by: str) -> str:
    return (
        _box_sql(by)
        + f"""
SELECT {by}feature, q1, median, q3,
       CAST(least(min(value) FILTER (inside), q1) AS DOUBLE) AS whisker_low,
       CAST(greatest(max(value) FILTER (inside), q3) AS DOUBLE) AS whisker_high,
       CAST(count(*) FILTER (NOT inside) AS BIGINT) AS outliers
FROM v GROUP BY {by}feature, q1, median, q3"""
    )


def _missing_sql() -> str:
    parts = []
    for c in ("component", "time_window", "warn_count", "log_volume", "warn_share", "incident"):
        test = f"{c} IS NULL OR isnan({c})" if c == "warn_share" else f"{c} IS NULL"
        parts.append(f"SELECT '{c}' AS \"column\", count(*) FILTER ({test}) AS missing FROM g")
    return " UNION ALL ".join(parts)


_CLASSES = (
    _with(_WINDOWS, _SCORES)
    + """,
k AS (SELECT y_true AS class FROM s UNION SELECT y_pred FROM s),
n AS (SELECT class,
             count(*) FILTER (y_true = class) AS support,
             count(*) FILTER (y_pred = class) AS predicted,
             count(*) FILTER (y_true = class AND y_pred = class) AS tp
      FROM k CROSS JOIN s GROUP BY class),
e AS (SELECT class, support, tp,
             coalesce(CAST(tp AS DOUBLE) / nullif(predicted, 0), 0) AS p,
             coalesce(CAST(tp AS DOUBLE) / nullif(support, 0), 0) AS r,
             coalesce(2.0e0 * tp / nullif(support + predicted, 0), 0) AS f1
      FROM n)"""
)

_POSITIVE = """
c AS (SELECT count(*) FILTER (y_true = 1 AND y_pred = 1) AS tp,
             count(*) FILTER (y_true = 1) AS actual,
             count(*) FILTER (y_pred = 1) AS predicted,
             count(*) FILTER (y_true = y_pred) AS hits, count(*) AS n FROM s),
metrics AS (SELECT CAST(hits AS DOUBLE) / n AS accuracy,
                   coalesce(CAST(tp AS DOUBLE) / nullif(predicted, 0), 0) AS precision,
                   coalesce(CAST(tp AS DOUBLE) / nullif(actual, 0), 0) AS recall,
                   coalesce(2.0e0 * tp / nullif(actual + predicted, 0), 0) AS f1 FROM c)"""

_AUC = """
ranked AS (SELECT y_true, rank() OVER (ORDER BY y_proba)
                  + (count(*) OVER (PARTITION BY y_proba) - 1) / 2.0e0 AS place FROM s),
area AS (SELECT (sum(place) FILTER (y_true = 1)
                 - CAST(count(*) FILTER (y_true = 1) AS DOUBLE)
                   * (count(*) FILTER (y_true = 1) + 1) / 2)
                / (CAST(count(*) FILTER (y_true = 1) AS DOUBLE)
                   * count(*) FILTER (y_true = 0)) AS auc FROM ranked)"""


def _report_sql() -> str:
    parts = [
        "SELECT 'shape' AS section, 'dataset' AS key, 'row_count' AS metric, "
        "CAST(count(*) AS DOUBLE) AS value FROM f",
        "SELECT 'shape', 'dataset', 'column_count', 8.0",
    ]
    for column in ("incident", "component"):
        parts.append(
            f"SELECT '{column}_distribution', CAST({column} AS VARCHAR), 'count', "
            f"CAST(count(*) AS DOUBLE) FROM f GROUP BY {column}"
        )
    statistics = {
        "count": "count({0})",
        "mean": "avg({0})",
        "std": "stddev_samp({0})",
        "min": "min({0})",
        "p25": "quantile_cont({0}, 0.25)",
        "p50": "quantile_cont({0}, 0.5)",
        "p75": "quantile_cont({0}, 0.75)",
        "max": "max({0})",
    }
    for feature, expression in _REPORT_FEATURES.items():
        for metric, sql in statistics.items():
            parts.append(
                f"SELECT 'summary', '{feature}', '{metric}', "
                f"round(CAST({sql.format(expression)} AS DOUBLE), 9) FROM f"
            )
        parts.append(
            f"SELECT 'correlation_with_incident', '{feature}', 'r', "
            f"round(corr({expression}, incident), 9) FROM f"
        )
    return _with(_WINDOWS) + " " + " UNION ALL ".join(parts)


def _incident_stats_sql(key: str, name: str) -> str:
    return (
        _with(_WINDOWS)
        + f"""
SELECT {key} AS {name}, count(incident) AS total_records,
       CAST(sum(incident) AS BIGINT) AS incident_count, avg(incident) AS incident_rate,
       avg(warn_count) AS avg_warn_count
FROM f GROUP BY 1"""
    )


def oracle_sql() -> dict[str, str]:
    return _window_sql() | _text_operators()[1]


def _window_sql() -> dict[str, str]:
    f = _with(_WINDOWS)
    scores = _with(_WINDOWS, _SCORES)
    gappy = _with(_WINDOWS, _GAPPY)
    long = _with(_WINDOWS, _LONG)
    ratios = {
        "null": "log_volume / nullif(unique_event_count, 0)",
        "zero": "CASE WHEN unique_event_count <> 0 THEN log_volume / unique_event_count "
        "ELSE 0.0 END",
        "plus_one": "log_volume / (unique_event_count + 1)",
    }
    engineered = {name: _ENGINEERED.format(ratio=ratio) for name, ratio in ratios.items()}
    window_columns = [
        "component", "time_window", "warn_count", "log_volume", "unique_event_count", "incident",
    ]
    matrix = window_columns[2:]
    closed = """WHERE strptime(time_window, '%y%m%d_%H') + INTERVAL 3 HOUR
                  <= (SELECT max(ts) FROM events)"""
    test_side = f"""{f}, {_split_sql(window_columns, 'f')}
            SELECT component, time_window, incident, true AS sound FROM p WHERE split = 'test'"""
    tested = "(SELECT count(*) FROM p WHERE split = 'test')"
    awkward = f"""{f}, {_AWKWARD}
        SELECT {', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in window_columns)} FROM k"""
    equal = lambda *names: "SELECT " + ", ".join(f"true AS {n}_equal" for n in names)
    with_zeros = f"""{f}, x AS (SELECT component, time_window, log_volume,
            CASE WHEN log_volume % 3 = 0 THEN 0 WHEN log_volume % 5 = 0 THEN NULL
                 ELSE unique_event_count END AS unique_event_count FROM f)"""
    summary = f"{f} SELECT {engineered['null']} FROM f"
    ranges = " UNION ALL ".join(
        f"""SELECT '{a}' AS first, '{b}' AS last, count(DISTINCT component) AS unique_components FROM f
            WHERE substr(time_window, 1, 6) BETWEEN '{a}' AND '{b}'"""
        for a, b in _RANGES_OF_DATES
    )
    awkward_missing = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing FROM k" for c in window_columns
    )
    known = {
        "derive_features": f"{f} SELECT * FROM f",
        # Hours that end before the stream's watermark, two hours behind the last event.
        "streamed_windows": f"{f} SELECT * FROM f {closed}",
        "batched_scores_check": f"""{f} SELECT component, time_window, incident, true AS sound
            FROM f {closed}""",
        "closed_windows": f"{f} SELECT * FROM f",
        "late_events": f"{_LATE_SQL}",
        "streamed_scores_check": f"""{f} SELECT component, time_window, incident, true AS sound
            FROM f {closed}""",
        **{f"{m}_scored_rows": test_side for m in MODELS},
        "random_split_check": f"""{f} SELECT count(*) AS row_count, CAST(0 AS BIGINT) AS lost,
            CAST(0 AS BIGINT) AS on_both_sides FROM f""",
        "reloaded_predictions_check": f"""{f}, {_split_sql(window_columns, 'f')}
            SELECT {tested} AS row_count, 0.0e0 AS difference""",
        "importances_check": f"""{f} SELECT 8 + count(DISTINCT component) AS slots,
            1.0e0 AS total FROM f""",
        "model_metrics_check": equal("accuracy", "precision", "recall", "f1", "auc"),
        "training_metrics_check": equal("accuracy", "precision", "recall", "f1", "auc"),
        "run_report_check": equal("accuracy", "precision", "recall", "f1", "auc"),
        "csv_round_trip": awkward,
        "csv_inferred": f"""SELECT * REPLACE (nullif(component, 'svc.2') AS component)
            FROM ({awkward})""",
        "export_round_trip": awkward,
        "json_round_trip": awkward,
        "dated_storage": f"{f} SELECT * FROM f",
        "dated_range": f"""{f} SELECT * FROM f
            WHERE substr(time_window, 1, 6) BETWEEN '240110' AND '240119'""",
        "external_table": awkward,
        "overwritten_table": awkward,
        "dropped_table": f"{f} SELECT count(*) AS kept_rows, false AS still_there FROM f",
        "run_log": f"""{f} SELECT component || ': ' || CAST(count(*) AS VARCHAR) AS results FROM f
            GROUP BY component""",
        "ratio_null_divisors": f"""{with_zeros} SELECT component, time_window,
            log_volume / nullif(unique_event_count, 0) AS log_per_event_ratio FROM x""",
        "ratio_zero_divisors": f"""{with_zeros} SELECT component, time_window,
            coalesce(log_volume / nullif(unique_event_count, 0), 0) AS log_per_event_ratio FROM x""",
        "ratio_plus_one_divisors": f"""{with_zeros} SELECT component, time_window,
            log_volume / (unique_event_count + 1) AS log_per_event_ratio FROM x""",
        "correlation_with_nan": _nan_correlation(),
        "features_null_ratio": summary,
        "features_zero_ratio": f"{f} SELECT {engineered['zero']}, {_HOUR} AS hour FROM f",
        "features_plus_one_ratio": f"{f} SELECT {engineered['plus_one']}, {_HOUR} AS hour FROM f",
        "window_date_hour": f"""{f} SELECT component, time_window,
            substr(time_window, 1, 6) AS date, {_HOUR} AS hour FROM f""",
        "summary_table": summary,
        "preview_rows": f"{f} SELECT * FROM f ORDER BY component, time_window LIMIT 10",
        "dataset_shape": f"""{f} SELECT count(*) AS row_count,
            CAST(6 AS BIGINT) AS column_count FROM f""",
        "missing_per_column": f"{gappy} {_missing_sql()}",
        "missing_present": f"{gappy} SELECT * FROM ({_missing_sql()}) WHERE missing > 0",
        "missing_total": f"""{gappy} SELECT CAST(sum(missing) AS BIGINT) AS missing_values
            FROM ({_missing_sql()})""",
        "dataset_stats": f"""{f} SELECT count(*) AS total_records,
            CAST(6 AS BIGINT) AS total_features,
            CAST(sum(incident) AS BIGINT) AS incident_count, avg(incident) AS incident_rate,
            CAST(sum(CASE WHEN component IS NULL THEN 1 ELSE 0 END
              + CASE WHEN time_window IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_values,
            count(*) FILTER (NOT regexp_full_match(time_window, '[0-9]{{6}}_[0-9]{{2}}'))
              AS malformed_windows
            FROM f""",
        "describe_numeric": f
        + " UNION ALL ".join(_describe_sql(n, e) for n, e in _REPORT_FEATURES.items()),
        "basic_statistics": f"""{f} SELECT count(*) AS total_records,
            count(DISTINCT component) AS unique_components,
            CAST(sum(incident) AS BIGINT) AS total_incidents, avg(warn_count) AS avg_warn_count,
            avg(log_volume) AS avg_log_volume, avg(unique_event_count) AS avg_unique_events
            FROM f""",
        "incident_rate_by_component": f"""{f} SELECT component, count(*) AS total_records,
            CAST(sum(incident) AS BIGINT) AS incident_count,
            round(CAST(sum(incident) * 100 AS DOUBLE) / count(*), 2) AS incident_rate_percent,
            avg(warn_count) AS avg_warn_count, avg(log_volume) AS avg_log_volume
            FROM f GROUP BY component ORDER BY incident_rate_percent DESC, component""",
        "incidents_by_date": f"""{f} SELECT substr(time_window, 1, 6) AS date_part,
            count(*) AS records_per_date, CAST(sum(incident) AS BIGINT) AS incidents_per_date,
            avg(warn_count) AS avg_warn_count FROM f GROUP BY 1 ORDER BY 1""",
        "component_feature_ranges": f"""{f} SELECT component,
            min(warn_count) AS min_warn, max(warn_count) AS max_warn, avg(warn_count) AS avg_warn,
            min(log_volume) AS min_log_volume, max(log_volume) AS max_log_volume,
            avg(log_volume) AS avg_log_volume, min(unique_event_count) AS min_unique_events,
            max(unique_event_count) AS max_unique_events,
            avg(unique_event_count) AS avg_unique_events FROM f GROUP BY component""",
        "high_risk_windows": f"""{f} SELECT time_window, component, warn_count, log_volume,
            unique_event_count, incident FROM f WHERE incident = 1 ORDER BY time_window""",
        "component_warning_category": f"""{f} SELECT component, avg(warn_count) AS avg_warn,
            avg(log_volume) AS avg_log_volume, avg(unique_event_count) AS avg_unique_events,
            CAST(sum(incident) AS BIGINT) AS total_incidents,
            CASE WHEN avg(warn_count) > {HIGH} THEN 'High Warning'
                 WHEN avg(warn_count) > {MEDIUM} THEN 'Medium Warning'
                 ELSE 'Low Warning' END AS warning_category FROM f GROUP BY component""",
        "value_counts_component": f"""{f} SELECT component, count(*) AS count FROM f
            GROUP BY component""",
        "value_counts_incident": f"{f} SELECT incident, count(*) AS count FROM f GROUP BY incident",
        "target_rate": f"{f} SELECT avg(incident) AS incident_rate FROM f",
        "component_card": f"""{f} SELECT component, count(incident) AS total_records,
            CAST(sum(incident) AS BIGINT) AS incident_count,
            round_even(avg(incident), 2) AS incident_rate,
            round_even(avg(warn_count), 2) AS avg_warn_count, max(warn_count) AS max_warn_count,
            round_even(avg(log_volume), 2) AS avg_log_volume, max(log_volume) AS max_log_volume,
            round_even(avg(unique_event_count), 2) AS avg_unique_events,
            max(unique_event_count) AS max_unique_events FROM f GROUP BY component""",
        "date_stats": _incident_stats_sql("substr(time_window, 1, 6)", "date"),
        "hour_stats": _incident_stats_sql(_HOUR, "hour"),
        "stats_by_incident": f"""{long} SELECT incident, feature, round(avg(value), 9) AS mean,
            round(stddev_samp(value), 9) AS std, median(value) AS median
            FROM m GROUP BY incident, feature""",
        "correlation_matrix": _correlation_sql(matrix, 9),
        "correlation_heatmap": _correlation_sql(matrix, 2),
        "correlation_with_target": f
        + " "
        + " UNION ALL ".join(
            f"SELECT '{n}' AS feature, round(corr({e}, incident), 9) AS r FROM f"
            for n, e in _REPORT_FEATURES.items()
        ),
        "class_share": f"""{f} SELECT incident, count(*) AS count,
            round(CAST(count(*) * 100 AS DOUBLE) / sum(count(*)) OVER (), 1) AS share_percent
            FROM f GROUP BY incident""",
        "component_series": f"""{f},
            c AS (SELECT component, CAST(count(*) AS DOUBLE) AS n, avg(incident) AS rate,
                         avg(warn_count) AS warn, avg(log_volume) AS volume
                  FROM f GROUP BY component)
            SELECT component, 'record_count' AS series, n AS value FROM c
            UNION ALL SELECT component, 'incident_rate', rate FROM c
            UNION ALL SELECT component, 'avg_warn_count', warn FROM c
            UNION ALL SELECT component, 'avg_log_volume', volume FROM c""",
        "histogram_30": f"""{long},
            x AS (SELECT feature, CAST(min(value) AS DOUBLE) AS lo, CAST(max(value) AS DOUBLE) AS hi
                  FROM m GROUP BY feature),
            y AS (SELECT feature,
                         CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS lo,
                         CASE WHEN lo = hi THEN hi + 0.5 ELSE hi END AS hi FROM x),
            b AS (SELECT feature, CAST(least(floor((value - lo) * 30 / (hi - lo)), 29) AS INTEGER)
                         AS bin, count(*) AS n
                  FROM m JOIN y USING (feature) GROUP BY 1, 2),
            z AS (SELECT y.*, CAST(i AS INTEGER) AS bin FROM y, range(30) AS r(i))
            SELECT feature, bin, round(lo + (hi - lo) / 30 * bin, 9) AS bin_start,
                   round(lo + (hi - lo) / 30 * (bin + 1), 9) AS bin_end,
                   coalesce(n, 0) AS count
            FROM z LEFT JOIN b USING (feature, bin)""",
        "box_stats": _box_result(""),
        "box_stats_by_incident": _box_result("incident, "),
        "box_outliers": _box_sql("")
        + " SELECT feature, value, count(*) AS n FROM v WHERE NOT inside GROUP BY ALL",
        "scatter_density": f"""{f} SELECT warn_count, log_volume, incident, count(*) AS points
            FROM f GROUP BY ALL""",
        "date_hour_series": f"""{f}
            SELECT 'incident_count_by_date' AS series, substr(time_window, 1, 6) AS key,
                   CAST(sum(incident) AS DOUBLE) AS value FROM f GROUP BY 2
            UNION ALL SELECT 'incident_rate_by_hour', substr(time_window, 8, 2), avg(incident)
                      FROM f GROUP BY 2
            UNION ALL SELECT 'avg_warn_count_by_hour', substr(time_window, 8, 2), avg(warn_count)
                      FROM f GROUP BY 2
            UNION ALL SELECT 'records_by_hour', substr(time_window, 8, 2),
                             CAST(count(*) AS DOUBLE) FROM f GROUP BY 2""",
        "eda_report": _report_sql(),
        "top10_windows": f"""{f} SELECT * FROM f
            ORDER BY log_volume DESC, time_window, component LIMIT 10""",
        "component_frequency_index": f"""{f},
            c AS (SELECT component, row_number() OVER (ORDER BY count(*) DESC, component) - 1 AS i
                  FROM f GROUP BY component)
            SELECT component, time_window, CAST(i AS DOUBLE) AS component_index
            FROM f JOIN c USING (component)""",
        "component_alpha_index": f"""{f} SELECT component, time_window,
            CAST(dense_rank() OVER (ORDER BY component) - 1 AS DOUBLE) AS component_index FROM f""",
        "stratified_split": f"""{f}, {_split_sql(window_columns, 'f')}
            SELECT {', '.join(window_columns)}, split FROM p""",
        "class_weights": f"""{f} SELECT incident, count(*) AS n,
            CAST(sum(count(*)) OVER () AS DOUBLE) / (count(*) OVER () * count(*)) AS weight
            FROM f GROUP BY incident""",
        "confusion_pairs": f"{scores} SELECT y_true, y_pred, count(*) AS count FROM s GROUP BY 1, 2",
        "confusion_matrix": f"""{scores}
            SELECT 'No Incident' AS actual, count(*) FILTER (y_true = 0 AND y_pred = 0)
                   AS no_incident, count(*) FILTER (y_true = 0 AND y_pred = 1) AS incident FROM s
            UNION ALL SELECT 'Incident', count(*) FILTER (y_true = 1 AND y_pred = 0),
                   count(*) FILTER (y_true = 1 AND y_pred = 1) FROM s""",
        "accuracy": f"""{scores} SELECT avg(CASE WHEN y_true = y_pred THEN 1 ELSE 0 END)
            AS accuracy FROM s""",
        "weighted_metrics": f"""{_CLASSES} SELECT
            CAST(sum(tp) AS DOUBLE) / sum(support) AS accuracy,
            sum(p * support) / sum(support) AS weighted_precision,
            sum(r * support) / sum(support) AS weighted_recall,
            sum(f1 * support) / sum(support) AS weighted_f1 FROM e""",
        "positive_metrics": f"{scores}, {_POSITIVE} SELECT * FROM metrics",
        "classification_report": f"""{_CLASSES},
            rows_ AS (
              SELECT CAST(class AS VARCHAR) AS label, p, r, f1, CAST(support AS DOUBLE) AS n FROM e
              UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f1), sum(support) FROM e
              UNION ALL SELECT 'weighted avg', sum(p * support) / sum(support),
                sum(r * support) / sum(support), sum(f1 * support) / sum(support), sum(support)
                FROM e)
            SELECT label, 'precision' AS metric, p AS value FROM rows_
            UNION ALL SELECT label, 'recall', r FROM rows_
            UNION ALL SELECT label, 'f1-score', f1 FROM rows_
            UNION ALL SELECT label, 'support', n FROM rows_
            UNION ALL SELECT 'accuracy', 'accuracy', CAST(sum(tp) AS DOUBLE) / sum(support)
                      FROM e""",
        "rank_auc": f"{scores}, {_AUC} SELECT round(auc, 9) AS auc FROM area",
        "prediction_totals": f"""{scores} SELECT count(*) AS total_predictions,
            CAST(sum(y_true) AS BIGINT) AS actual_incidents,
            CAST(sum(y_pred) AS BIGINT) AS predicted_incidents FROM s""",
        "quality_gate": f"""{scores}, {_POSITIVE}, {_AUC}
            SELECT accuracy >= {S.MIN_ACCURACY} AS accuracy_check, f1 >= {S.MIN_F1} AS f1_check,
                   auc >= {S.MIN_AUC} AS auc_check,
                   accuracy >= {S.MIN_ACCURACY} AND f1 >= {S.MIN_F1} AND auc >= {S.MIN_AUC}
                     AS all_checks_passed FROM metrics, area""",
        "assembled_features": _assembled_sql(f, engineered["zero"], 6),
        "assembled_features_strict": _assembled_sql(f, engineered["zero"], 5),
        "standardized_train": _standardized_sql(f, engineered["plus_one"]),
        "schema_table": f + " UNION ALL ".join(
            f"""
            SELECT CAST({i} AS INTEGER) AS position, '{c}' AS "column",
                   '{('string', 'bigint', 'int')[(i > 1) + (i > 4)]}' AS type,
                   count({c}) AS non_null FROM f"""
            for i, c in enumerate(window_columns)
        ),
        "daily_missing": f"{f}, {_AWKWARD} {awkward_missing}",
        "distinct_by_range": f"{f} {ranges}",
        "quantile_sketch_check": f"""{f} SELECT feature, quantile, (SELECT count(*) FROM f) AS count, true AS close
            FROM (VALUES ('warn_count'), ('log_volume'), ('unique_event_count')) AS a(feature),
                 (VALUES ('p25'), ('p50'), ('p75')) AS b(quantile)""",
    }
    # From what is stored for each date come the same tables as from the rows.
    stored_by_date = {
        "daily_basic_statistics": "basic_statistics",
        "daily_incident_rate": "incident_rate_by_component",
        "daily_incidents_by_date": "incidents_by_date",
        "daily_feature_ranges": "component_feature_ranges",
        "daily_warning_category": "component_warning_category",
        "daily_component_card": "component_card",
        "daily_date_stats": "date_stats",
        "daily_hour_stats": "hour_stats",
        "daily_dataset_stats": "dataset_stats",
    }
    return known | {name: known[same] for name, same in stored_by_date.items()}


def _assembled_sql(f: str, engineered: str, components: int) -> str:
    """Eight numbers, then 0/1 slots of the most frequent components."""
    numbers = [f"CAST({c} AS DOUBLE) AS slot_{i:02d}" for i, c in enumerate(S.NUMERIC_FEATURES)]
    slots = [
        f"CASE WHEN place = {i} THEN 1.0e0 ELSE 0.0e0 END AS slot_{i + 8:02d}" for i in range(components)
    ]
    return f"""{f}, x AS (SELECT {engineered}, {_HOUR} AS hour FROM f),
c AS (SELECT component, row_number() OVER (ORDER BY count(*) DESC, component) - 1 AS place
      FROM f GROUP BY component)
SELECT component, time_window, {", ".join(numbers + slots)} FROM x JOIN c USING (component)"""


def _standardized_sql(f: str, engineered: str) -> str:
    """The raw columns decide the split; nine columns are scaled by the training rows."""
    columns = [
        "component", "time_window", "warn_count", "log_volume", "unique_event_count", "incident",
    ]
    scaled = models.SCALED_FEATURES
    fits = ", ".join(
        f"(SELECT avg({c}) FROM p WHERE split = 'train') AS m_{c}, "
        f"(SELECT stddev_pop({c}) FROM p WHERE split = 'train') AS s_{c}"
        for c in scaled
    )
    values = ", ".join(
        f"round((p.{c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END, 9) AS scaled_{c}"
        for c in scaled
    )
    return f"""{f}, x AS (SELECT {engineered}, {_HOUR} AS hour,
  dense_rank() OVER (ORDER BY component) - 1 AS {models.COMPONENT_ENCODED} FROM f),
{_split_sql(columns, 'x')},
fit AS (SELECT {fits})
SELECT component, time_window, split, {values} FROM p, fit"""
