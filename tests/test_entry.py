import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(FOLDER):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{file}'")
    return connection


def _plain(value):
    if pd.isna(value):
        return "NULL"
    if isinstance(value, float):
        return f"{value:.9g}"
    return str(value)


def _sorted_rows(frame):
    columns = sorted(frame.columns)
    return columns, sorted(
        tuple(_plain(v) for v in row)
        for row in frame[columns].astype(object).itertuples(index=False)
    )


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    ours = entry.queries()[name](spark, FOLDER).toPandas()
    assert _sorted_rows(ours) == _sorted_rows(duck.execute(ORACLE[name]).df())


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 6


@pytest.mark.parametrize("name", ["random_split", "lr_predictions", "streamed_scores"])
def test_other_queries_give_rows(spark, name):
    assert not entry.queries()[name](spark, FOLDER).isEmpty()


def test_no_python_in_plans(spark):
    for name in ("derive_features", "describe_numeric", "stratified_split", "eda_report"):
        plan = entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert "EvalPython" not in plan and "InPandas" not in plan
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
