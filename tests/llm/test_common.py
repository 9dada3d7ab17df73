import os

import pytest

from riskwindow.llm import common


def folder(frame):
    return os.path.dirname(frame.inputFiles()[0].removeprefix("file://"))


def test_tables_on_the_way_go_when_the_result_is_stored(spark):
    way = []

    def make():
        table = common.stored(spark.range(5), "way")
        way.append(folder(table))
        return table.selectExpr("id * 2 AS twice")

    kept = common.stored(spark.range(2), "kept")
    out = common.settled(spark, make, "out")
    assert sorted(r.twice for r in out.collect()) == [0, 2, 4, 6, 8]
    assert not os.path.exists(way[0]) and kept.count() == 2


def test_results_inside_results_and_failures(spark):
    paths = []

    def inner():
        paths.append(folder(way := common.stored(spark.range(3), "way")))
        return way

    def outer():
        paths.append(folder(found := common.settled(spark, inner, "inner")))
        assert not os.path.exists(paths[0]) and found.count() == 3
        return found

    result = common.settled(spark, outer, "outer")
    assert not os.path.exists(paths[1]) and result.count() == 3

    def failing():
        paths.append(folder(common.stored(spark.range(3), "way")))
        raise ValueError("broken")

    with pytest.raises(ValueError):
        common.settled(spark, failing, "failing")
    assert not os.path.exists(paths[2])
    after = common.stored(spark.range(1), "after")
    assert common._MADE.get() is None and after.count() == 1
