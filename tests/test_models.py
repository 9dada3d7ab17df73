import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier

from riskwindow import schema as S
from riskwindow.__main__ import main
from riskwindow.operators import models
from riskwindow.operators.features import engineer_features
from riskwindow.plans import training
from riskwindow.plans.incident_pipeline import run_pipeline
from riskwindow.sources import write_csv
from riskwindow.streaming import score_stream, write_stream


def small_forest(**params):
    return RandomForestClassifier(
        labelCol=S.INCIDENT, featuresCol="features", numTrees=3, maxDepth=3, seed=S.SEED, **params
    )


def test_preset_parameters(spark):
    forest = models.plain_model("RANDOM_FOREST")
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getSeed()) == (100, 10, 42)
    boosting = models.plain_model("gbt")
    assert (boosting.getMaxIter(), boosting.getMaxDepth(), boosting.getSeed()) == (50, 5, 42)
    regression = models.plain_model("logistic_regression")
    assert (regression.getMaxIter(), regression.getRegParam()) == (100, 0.01)
    with pytest.raises(ValueError):
        models.plain_model("other")


def test_scaled_preset_parameters(spark):
    forest = models.scaled_model("random_forest", 92)
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getWeightCol()) == (100, 10, "weight")
    boosting = models.scaled_model("gradient_boosting", 92)
    assert (boosting.getMaxIter(), boosting.getMaxDepth(), boosting.getStepSize()) == (100, 5, 0.1)
    regression = models.scaled_model("logistic_regression", 92)
    assert (regression.getMaxIter(), regression.getRegParam()) == (1000, 1 / 92)
    assert not regression.getStandardization()
    fallback = models.scaled_model("other", 92)
    assert (fallback.getNumTrees(), fallback.getMaxDepth()) == (100, 30)
    assert not fallback.isDefined("weightCol")


def test_index_orders(make):
    df = make([(c, "240101_00", 1, 1, 1, 0) for c in "bbbccaad"])
    by_count = models.component_indexer().fit(df)
    assert by_count.labels == ["b", "a", "c", "d"]
    assert models.component_indexer("alphabetAsc").fit(df).labels == ["a", "b", "c", "d"]


@pytest.mark.parametrize("unseen, slots", [("keep", 8 + 3), ("error", 8 + 2)])
def test_assembled_slots(sample, unseen, slots):
    engineered = engineer_features(sample)
    model = Pipeline(stages=models.feature_stages(unseen)).fit(engineered)
    row = model.transform(engineered).filter("component = 'svc.1'").first()
    assert row.features.size == slots
    assert list(row.features)[:2] == [row.warn_count, row.log_volume]


def test_scaler_has_population_deviation(sample):
    engineered = engineer_features(sample, "plus_one")
    indexer = models.component_indexer("alphabetAsc").fit(engineered)
    stages = models.scaled_feature_stages(indexer, 200)
    scaled = Pipeline(stages=stages).fit(engineered).transform(engineered)
    columns = [list(r.features) for r in scaled.select("features").collect()]
    for slot in zip(*columns):
        mean = sum(slot) / 200
        assert mean == pytest.approx(0, abs=1e-9)
        assert sum(v * v for v in slot) / 200 == pytest.approx(1)
    with pytest.raises(ValueError):
        models.scaled_feature_stages(indexer, 1)


def test_the_same_stored_split_gives_the_same_model(sample, tmp_path):
    engineered = engineer_features(sample)
    train, _ = training.train_and_test(engineered.repartition(3), folder=str(tmp_path / "split"))
    fits = [models.fit_plain(train, small_forest(subsamplingRate=0.5)) for _ in range(2)]
    first, second = (fit.stages[-1].toDebugString.split("\n", 1)[1] for fit in fits)
    assert first == second


def test_partitions_are_merged_on_demand_only(spark):
    rows = spark.range(100).repartition(4)
    assert models._parted(rows, None).rdd.getNumPartitions() == 4
    assert models._parted(rows, 1).rdd.getNumPartitions() == 1


def test_memory_for_trees_is_a_parameter(spark):
    assert models.plain_model("gbt", 64).getMaxMemoryInMB() == 64
    assert models.scaled_model("random_forest", 9).getMaxMemoryInMB() == 256


def test_malformed_rows_are_kept_without_a_score(make, sample):
    model = models.fit_plain(engineer_features(sample), small_forest())
    rows = make(
        [("svc.1", "bad", 1, 2, 1, 0), ("svc.1", "240101_05", None, 2, 1, 0), (None, "240101_05", 1, 2, 1, 0),
         ("svc.1", "240101_05", 1, 2, 1, 0)]
    )
    scored = models.score_windows(model, rows)
    assert scored.columns[: len(engineer_features(rows).columns)] == engineer_features(rows).columns
    found = [(r.time_window, r.warn_count, r.hour, r.prediction is None) for r in scored.collect()]
    assert found == [("bad", 1, None, True), ("240101_05", None, 5, True), ("240101_05", 1, 5, False), ("240101_05", 1, 5, False)]
    assert [r.y_proba is None for r in models.positive_probability(scored).collect()] == [True, True, False, False]


@pytest.mark.parametrize("method", training.SPLITS)
def test_training_run(spark, sample, tmp_path, method):
    path = str(tmp_path / "model")
    run = training.run_training(
        sample, model_path=path, split_method=method, classifier=small_forest()
    )
    metrics = run.metrics.first()
    assert set(metrics.asDict()) == {"auc", "f1", "accuracy", "precision", "recall"}
    assert all(0 <= value <= 1 for value in metrics)
    n = run.predictions.count()
    assert run.confusion.selectExpr("sum(count)").first()[0] == n
    if method == "stratified":
        assert n == 40 and run.predictions.filter("incident = 1").count() == 4
    top = run.importances.collect()
    assert len(top) == 10 and [r.importance for r in top] == sorted(
        (r.importance for r in top), reverse=True
    )
    engineered = [c for c in S.NUMERIC_FEATURES if c not in S.MEASURES]
    rows = run.predictions.select(*S.WINDOW_SCHEMA.names, *engineered)
    again = models.score(models.load_model(path), rows)
    assert sorted(r.probability.toArray().tolist() for r in again.collect()) == sorted(
        r.probability.toArray().tolist() for r in run.predictions.collect()
    )


def test_unknown_names_fail_before_any_work(sample):
    with pytest.raises(ValueError):
        training.run_training(sample, "other")
    with pytest.raises(ValueError):
        training.train_and_test(sample, "other")
    with pytest.raises(ValueError):
        models.score(None, sample)


def test_importances_names_and_regression_has_none(sample):
    engineered = engineer_features(sample)
    forest = models.fit_plain(engineered, small_forest())
    names = {r.feature for r in models.feature_importances(forest, top=None).collect()}
    assert names == {*S.NUMERIC_FEATURES, *[f"component_{i}" for i in range(3)]}
    regression = LogisticRegression(labelCol=S.INCIDENT, maxIter=3)
    fitted = models.fit_plain(engineered, regression)
    assert models.feature_importances(fitted).isEmpty()


def test_unseen_component(make, sample):
    new = engineer_features(make([("new", "240101_05", 1, 1, 1, 0)]).drop(S.INCIDENT))
    regression = LogisticRegression(labelCol=S.INCIDENT, maxIter=3)
    engineered = engineer_features(sample)
    scored = models.positive_probability(models.score(models.fit_plain(engineered, regression), new))
    assert 0 <= scored.first().y_proba <= 1
    strict = models.fit_plain(engineered, regression, unseen="error")
    with pytest.raises(Exception):
        models.score(strict, new).collect()


def test_stream_scores_equal_batch_scores(spark, sample, tmp_path):
    model = models.fit_plain(engineer_features(sample), small_forest())
    bad = spark.createDataFrame([("svc.1", "bad", 1, 2, 1, 0)], S.WINDOW_SCHEMA)
    sample = sample.unionByName(bad)
    write_csv(sample, str(tmp_path / "in"))
    stream = spark.readStream.schema(S.WINDOW_SCHEMA).option("header", True).csv(str(tmp_path / "in"))
    scored = score_stream(model, stream).select(S.COMPONENT, S.TIME_WINDOW, "prediction")
    write_stream(scored, str(tmp_path / "out"), str(tmp_path / "progress"), True).awaitTermination()
    batch = models.score(model, engineer_features(sample)).select(*scored.columns)
    streamed = spark.read.parquet(str(tmp_path / "out"))
    assert streamed.count() == 201 and streamed.exceptAll(batch).isEmpty()
    assert streamed.filter("prediction IS NULL").count() == 1


def test_pipeline(spark, sample, tmp_path):
    output = str(tmp_path)
    tables = run_pipeline(spark, sample, output, classifier=small_forest(weightCol=models.WEIGHT))
    stats = tables["data_stats"].first()
    assert (stats.total_records, stats.total_features, stats.incident_count) == (200, 6, 20)
    assert tables["samples"].filter("split = 'test'").count() == 40
    assert tables["predictions"].columns == ["y_true", "y_pred", "y_proba"]
    assert tables["predictions"].filter("y_true = 1").count() == 4
    assert tables["predictions"].filter("y_proba BETWEEN 0 AND 1").count() == 40
    assert tables["confusion_matrix"].selectExpr("sum(no_incident + incident)").first()[0] == 40
    assert tables["classification_report"].filter("label = 'macro avg'").count() == 4
    report = {(r.section, r.metric): r.value for r in tables["evaluation_report"].collect()}
    assert report["model", "model_type"] == "random_forest"
    assert report["dataset", "total_predictions"] == "40"
    assert report["dataset", "actual_incidents"] == "4"
    metrics = tables["metrics"].first()
    assert float(report["performance", "accuracy"]) == metrics.accuracy
    assert 0 <= metrics.train_accuracy <= 1
    assert set(tables["gate"].columns) == {
        "accuracy_check", "f1_check", "auc_check", "all_checks_passed",
    }
    assert tables["runs"].count() == 1
    assert models.load_model(f"{output}/model").stages


def test_strict_pipeline_stops_at_the_gate(spark, make, tmp_path):
    # Labels that no feature explains cannot pass.
    rows = [("a", "240101_00", 1, 1, 1, int(i % 25 == 0)) for i in range(200)]
    with pytest.raises(ValueError, match="threshold"):
        run_pipeline(spark, make(rows), str(tmp_path), "logistic_regression", strict=True)


def test_pipeline_validates(spark, make, sample, tmp_path):
    with pytest.raises(ValueError):
        run_pipeline(spark, sample.drop("incident"), str(tmp_path))
    with pytest.raises(ValueError):
        run_pipeline(spark, make([]), str(tmp_path))


def test_command_line(spark, sample, tmp_path, capsys):
    write_csv(sample, str(tmp_path / "in"))
    source = str(tmp_path / "in")
    main(["explore", source, str(tmp_path / "explored")])
    main(["train", source, str(tmp_path / "model"), "--model", "logistic_regression"])
    main(["pipeline", source, str(tmp_path / "run"), "--model", "logistic_regression"])
    try:
        main(["sql", source, str(tmp_path / "exported"), "--database", "cli_test"])
    finally:
        spark.catalog.setCurrentDatabase("default")
    main(["score", source, str(tmp_path / "scored"), "--model", str(tmp_path / "model")])
    assert spark.read.parquet(str(tmp_path / "scored")).filter("y_proba BETWEEN 0 AND 1").count() == 200
    shown = capsys.readouterr().out
    assert "not_scored" in shown
    assert "all_checks_passed" in shown and "incident_rate_percent" in shown
    assert spark.read.parquet(str(tmp_path / "run" / "runs")).count() == 1


def test_command_line_for_raw_events(spark, sample, tmp_path):
    events = spark.range(400).selectExpr(
        "id % 3 AS part", "concat('e', id % 5) AS kind", "id",
        "CAST(timestamp_seconds(1704067200 + id * 420) AS TIMESTAMP_NTZ) AS ts",
    )
    source = str(tmp_path / "events")
    events.repartition(3).write.parquet(source)
    mapping = ["--component", "concat('svc.', part)", "--event", "kind", "--warning", "id % 5 = 0", "--incident", "id % 50 = 7"]
    main(["rollup", source, str(tmp_path / "windows"), *mapping])
    dates = sorted(r[0] for r in spark.read.parquet(str(tmp_path / "windows")).select("time_window").distinct().collect())
    main(["explore", str(tmp_path / "windows"), str(tmp_path / "day"), "--from", "240102", "--to", "240102"])
    shape = spark.read.parquet(str(tmp_path / "day" / "date_stats")).collect()
    assert dates[0] == "240101_00" and [r.date for r in shape] == ["240102"]
    models.save_model(models.fit_plain(engineer_features(sample), small_forest()), str(tmp_path / "model"))
    for job, more in (("stream-rollup", []), ("stream-score", ["--model", str(tmp_path / "model")])):
        out = str(tmp_path / job)
        main([job, source, out, "--progress", out + "-progress", "--once", *mapping, *more])
        closed = [d for d in dates if d < dates[-1]]
        assert spark.read.parquet(out).select("time_window").distinct().count() in (len(closed) - 1, len(closed) - 2)


def test_training_leaves_nothing_behind_on_demand(spark, sample, tmp_path):
    run = training.run_training(sample, classifier=small_forest(), folder=str(tmp_path / "run"))
    assert (tmp_path / "run" / "split").exists() and run.metrics.count() == 1
    run.discard()
    assert not any((tmp_path / "run").iterdir())


class _HalfSaved:
    """A model whose save writes something and fails."""

    def __init__(self, model):
        self.model = model

    def write(self):
        return self

    def save(self, path):
        self.model.stages[0].write().save(f"{path}/stages/0")
        raise OSError("disk full")


def test_failed_save_leaves_the_old_model(sample, tmp_path, monkeypatch):
    path = str(tmp_path / "model")
    train = engineer_features(sample)
    first = models.fit_plain(train, small_forest())
    models.save_model(first, path)

    def scores():
        rows = models.positive_probability(models.score(models.load_model(path), train))
        return sorted(map(tuple, rows.select("component", "time_window", "y_proba").collect()))

    before = scores()
    with pytest.raises(OSError):
        models.save_model(_HalfSaved(first), path)
    assert scores() == before
    other = models.fit_plain(train, models.plain_model("logistic_regression"))
    with monkeypatch.context() as patched:
        patched.setattr(models, "_point_to", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            models.save_model(other, path)
    assert scores() == before
    models.save_model(other, path)
    assert scores() != before
    models.save_model(first, path)
    assert scores() == before
    # The last two versions stay, those of the failed saves went.
    versions = [p for p in (tmp_path / "model").iterdir() if p.name.startswith("version-")]
    assert len(versions) == 2


def test_models_saved_without_versions_are_loaded(sample, tmp_path):
    path = str(tmp_path / "plain")
    model = models.fit_plain(engineer_features(sample), small_forest())
    model.write().save(path)
    assert len(models.load_model(path).stages) == len(model.stages)
    models.save_model(model, path)
    assert len(models.load_model(path).stages) == len(model.stages)
