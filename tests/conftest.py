import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from frames import sample_rows
from riskwindow import schema as S
from riskwindow.session import session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session(
        "tests",
        **{
            "spark.master": "local[4]",
            "spark.driver.memory": "4g",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def make(spark):
    """Feature table from tuples of the six columns."""

    def build(rows):
        return spark.createDataFrame(rows, S.WINDOW_SCHEMA)

    return build


@pytest.fixture
def sample(make):
    return make(sample_rows())
