import pytest
from pyspark.sql import functions as F

from riskwindow import schema as S
from riskwindow.plans.rollup import close_windows
from riskwindow.sources import merge_windows, read_dated_windows, windows_from_events
from riskwindow.streaming import (
    merge_stream,
    read_batches,
    windows_from_event_stream,
    write_batches,
    write_stream,
)

MAPPING = {
    "component": "concat('c', id % 3)",
    "event": "concat('e', id % 5)",
    "warning": "id % 5 = 0",
    "incident": "id % 50 = 7",
}


def _events(spark, first, last):
    """One event every seven minutes."""
    return spark.range(first, last).selectExpr(
        "id", "CAST(timestamp_seconds(1704067200 + id * 420) AS TIMESTAMP_NTZ) AS ts"
    )


def _run(spark, folder, schema, out):
    stream = windows_from_event_stream(spark.readStream.schema(schema).parquet(folder), **MAPPING)
    write_stream(stream, f"{out}/windows", f"{out}/progress", True).awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/windows")


def test_closed_hours_equal_the_batch(spark, tmp_path):
    events = _events(spark, 0, 500)
    events.repartition(3).write.parquet(str(tmp_path / "events"))
    streamed = _run(spark, str(tmp_path / "events"), events.schema, str(tmp_path / "out"))
    batch = windows_from_events(events, **MAPPING)
    # The last event is at 58:13 hours; the watermark, two hours behind, closes 56 of them.
    closed = batch.filter("time_window < '240103_08'")
    assert streamed.count() == closed.count() > 100
    assert streamed.exceptAll(closed).isEmpty()
    assert streamed.schema.simpleString() == batch.schema.simpleString()
    assert streamed.columns == S.WINDOW_SCHEMA.names


@pytest.mark.parametrize("zone", ["Asia/Kolkata", "America/St_Johns", "UTC"])
@pytest.mark.parametrize("kind", ["TIMESTAMP", "TIMESTAMP_NTZ"])
def test_hours_are_those_of_the_batch_in_every_zone(spark, tmp_path, zone, kind):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        events = _events(spark, 0, 200).withColumn("ts", F.expr(f"CAST(ts AS {kind})"))
        events.repartition(2).write.parquet(str(tmp_path / "events"))
        events = spark.read.parquet(str(tmp_path / "events"))
        streamed = _run(spark, str(tmp_path / "events"), events.schema, str(tmp_path / "out"))
        batch = windows_from_events(events, **MAPPING)
        assert streamed.count() > 40 and streamed.exceptAll(batch).isEmpty()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_file_and_folder_of_events_give_the_same(spark, tmp_path):
    import __spark_entry__ as entry

    events = _events(spark, 0, 300)
    whole, parts = tmp_path / "whole", tmp_path / "parts"
    events.repartition(3).write.parquet(str(parts / "events.parquet"))
    events.coalesce(1).write.parquet(str(tmp_path / "one"))
    whole.mkdir()
    next((tmp_path / "one").glob("part-*.parquet")).rename(whole / "events.parquet")
    found = []
    for folder in (whole, parts):
        stream = windows_from_event_stream(entry._event_stream(spark, str(folder)), **MAPPING)
        out = str(folder / "out")
        write_stream(stream, f"{out}/windows", f"{out}/progress", True).awaitTermination()
        found.append(sorted(map(tuple, spark.read.parquet(f"{out}/windows").collect())))
    assert found[0] == found[1] and len(found[0]) > 60


def test_second_run_goes_on_where_the_first_stopped(spark, tmp_path):
    folder, out = str(tmp_path / "events"), str(tmp_path / "out")
    _events(spark, 0, 300).write.parquet(folder)
    first = _run(spark, folder, _events(spark, 0, 1).schema, out).count()
    _events(spark, 300, 600).write.mode("append").parquet(folder)
    both = _run(spark, folder, _events(spark, 0, 1).schema, out)
    batch = windows_from_events(_events(spark, 0, 600), **MAPPING)
    assert first < both.count() == both.distinct().count()
    assert both.exceptAll(batch).isEmpty()


def _merged(spark, folder, schema, out, start=merge_stream):
    stream = windows_from_event_stream(spark.readStream.schema(schema).parquet(folder), **MAPPING)
    start(stream, f"{out}/windows", f"{out}/progress", True).awaitTermination()


def _same(left, right):
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_stream_and_closing_batch_equal_the_batch(spark, tmp_path):
    folder, out = str(tmp_path / "events"), str(tmp_path / "out")
    events = _events(spark, 0, 500)
    events.repartition(3).write.parquet(folder)
    _merged(spark, folder, events.schema, out)
    batch = windows_from_events(events, **MAPPING)
    stored = read_dated_windows(spark, f"{out}/windows").count()
    assert stored < batch.count()
    report = [r.asDict() for r in close_windows(events, f"{out}/windows", **MAPPING).collect()]
    assert [(r["date_part"], r["late_events"], r["changed_windows"]) for r in report] == [("240103", 0, 0)]
    assert report[0]["added_windows"] == batch.count() - stored
    assert _same(read_dated_windows(spark, f"{out}/windows"), batch)
    # Again: nothing is left to do. The stream may go on over the closed table.
    assert close_windows(events, f"{out}/windows", **MAPPING).isEmpty()
    _events(spark, 500, 700).write.mode("append").parquet(folder)
    _merged(spark, folder, events.schema, out)
    more = _events(spark, 0, 700)
    close_windows(more, f"{out}/windows", **MAPPING, first="240103")
    assert _same(read_dated_windows(spark, f"{out}/windows"), windows_from_events(more, **MAPPING))


def test_late_events_are_counted_and_brought_in(spark, tmp_path):
    folder, out = str(tmp_path / "events"), str(tmp_path / "out")
    events = _events(spark, 0, 400)
    late = "id BETWEEN 20 AND 29"
    events.filter(f"NOT ({late})").write.parquet(folder)
    _merged(spark, folder, events.schema, out)
    events.filter(late).write.mode("append").parquet(folder)
    _merged(spark, folder, events.schema, out)
    stored = read_dated_windows(spark, f"{out}/windows").filter("time_window = '240101_02'")
    assert stored.agg(F.sum("log_volume")).first()[0] < 8
    nothing = close_windows(events, f"{out}/windows", **MAPPING, first="240102", last="240102")
    assert [r.late_events for r in nothing.collect()] in ([], [0])
    found = {r.date_part: r for r in close_windows(events, f"{out}/windows", **MAPPING).collect()}
    first = found["240101"]
    assert first.late_events + first.added_events == 10 and first.changed_windows > 0
    assert _same(read_dated_windows(spark, f"{out}/windows"), windows_from_events(events, **MAPPING))


def test_closing_an_empty_table_and_keeping_what_events_lack(spark, make, tmp_path):
    path = str(tmp_path / "windows")
    events = _events(spark, 0, 60)
    report = close_windows(events, path, **MAPPING).first()
    assert report.added_events == 60 and report.late_events == 0
    merge_windows(make([("gone", "240101_00", 1, 2, 3, 0), (None, None, 1, 1, 1, 0)]), path)
    assert close_windows(events, path, **MAPPING).isEmpty()
    rows = read_dated_windows(spark, path)
    assert rows.count() == windows_from_events(events, **MAPPING).count() + 2
    assert rows.filter("component = 'gone'").count() == 1
    assert close_windows(events.limit(0), path, **MAPPING).isEmpty() and rows.count() > 2


def test_merge_replaces_rows_of_the_same_key_only(spark, make, tmp_path):
    path = str(tmp_path / "windows")
    first = [("a", "240101_00", 1, 1, 1, 0), ("b", "240101_00", 1, 1, 1, 0), ("a", "240102_00", 1, 1, 1, 0), (None, "", 1, 1, 1, 0)]
    merge_windows(make(first), path)
    again = [("a", "240101_00", 9, 9, 9, 1), (None, None, 2, 2, 2, 0), ("c", "240103_00", 1, 1, 1, 0)]
    for _ in range(2):
        merge_windows(make(again), path)
        assert _same(read_dated_windows(spark, path), make(first[1:] + again))
    merge_windows(make([]), path)
    assert read_dated_windows(spark, path).count() == 6


@pytest.mark.parametrize("start, read", [(write_batches, read_batches), (merge_stream, read_dated_windows)])
def test_repeated_batch_leaves_no_duplicates(spark, tmp_path, start, read):
    """As after a kill between the write of a batch and its commit: the batch's commit is taken away."""
    folder, out = str(tmp_path / "events"), str(tmp_path / "out")
    events = _events(spark, 0, 300)
    events.write.parquet(folder)
    _merged(spark, folder, events.schema, out, start)
    before = read(spark, f"{out}/windows").collect()
    commits = sorted((tmp_path / "out" / "progress" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    commits[-1].unlink()
    (commits[-1].parent / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    _merged(spark, folder, events.schema, out, start)
    after = read(spark, f"{out}/windows").collect()
    assert len(before) > 60 and sorted(map(tuple, after)) == sorted(map(tuple, before))
    _events(spark, 300, 600).write.mode("append").parquet(folder)
    _merged(spark, folder, events.schema, out, start)
    more = read(spark, f"{out}/windows")
    assert more.count() == more.distinct().count() > len(before)
    assert more.exceptAll(windows_from_events(_events(spark, 0, 600), **MAPPING)).isEmpty()


def test_command_line_closes_a_streamed_table(spark, tmp_path, monkeypatch):
    from riskwindow import __main__ as command

    monkeypatch.setattr(command, "session", lambda: spark)
    folder, output = str(tmp_path / "events"), str(tmp_path / "windows")
    events = _events(spark, 0, 100)
    events.write.parquet(folder)
    mapping = [part for key, value in MAPPING.items() for part in (f"--{key}", value)]
    command.main(["stream-rollup", folder, output, *mapping, "--progress", f"{output}-progress", "--once", "--merge"])
    command.main(["close-windows", folder, output, *mapping, "--from", "240101", "--to", "240102"])
    assert _same(read_dated_windows(spark, output), windows_from_events(events, **MAPPING))
