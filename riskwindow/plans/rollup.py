"""Bring a feature table stored by date in line with the raw events.

A stream stores an hour once the watermark has passed it. Two kinds of events are then missing: those of
hours that are still open, and late ones, which the stream drops. Rolling the events up
again and merging the result closes both gaps, however often it is done.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskwindow import schema as S
from riskwindow.functions import date_of, literal
from riskwindow.session import discard, shared_folder
from riskwindow.sources import is_stored, merge_windows, read_dated_windows, windows_from_events

KEYS = (S.COMPONENT, S.TIME_WINDOW)


def close_windows(
    events: DataFrame,
    path: str,
    component: str,
    event: str,
    warning: str,
    incident: str,
    time: str = "ts",
    first: str | None = None,
    last: str | None = None,
) -> DataFrame:
    """Roll the events of some days up again and merge what differs into the table below ``path``.

    Gives one row per date that differed: windows and events that the table lacked, windows that late
    events changed, and these late events. Windows that the events do not give stay as they are, so
    events that were deleted since do not take their windows with them. Only dates with a difference are
    written, and a second run over the same events finds none.

    ``first`` and ``last`` (``YYMMDD``) restrict the days; the filter is on the time itself, so it
    reaches the scan of the events.
    """
    spark = events.sparkSession
    for bound, sign in ((first, ">="), (last, "<")):
        if bound is not None:
            day = f"to_date({literal(bound)}, 'yyMMdd')"
            events = events.filter(f"{time} {sign} {day if sign == '>=' else f'date_add({day}, 1)'}")
    folder = shared_folder(spark, "rolled-up")
    try:
        windows_from_events(events, component, event, warning, incident, time).write.parquet(folder)
        rolled_up = spark.read.parquet(folder)
        compared = _compared(rolled_up, _stored(rolled_up, path, first, last))
        report = compared.groupBy("date_part").agg(
            F.expr("count_if(was IS NULL) AS added_windows"),
            F.expr("coalesce(sum(IF(was IS NULL, now, 0)), 0L) AS added_events"),
            F.expr("count_if(was IS NOT NULL) AS changed_windows"),
            F.expr("coalesce(sum(IF(was IS NOT NULL, now - was, 0)), 0L) AS late_events"),
        )
        rows = report.collect()  # a row for each date that differs
        merge_windows(compared.select(*S.WINDOW_SCHEMA.names), path)
    finally:
        discard(spark, folder)
    return spark.createDataFrame(rows, report.schema)


def _stored(like: DataFrame, path: str, first: str | None, last: str | None) -> DataFrame:
    spark = like.sparkSession
    if not is_stored(spark, path):
        return spark.createDataFrame([], like.schema)
    return read_dated_windows(spark, path, first, last)


def _compared(rolled_up: DataFrame, stored: DataFrame) -> DataFrame:
    """Windows that the table lacks or holds with other values, with their volume now and as stored."""
    values = [*S.MEASURES, S.INCIDENT]
    same_key = " AND ".join(f"l.{k} <=> r.{k}" for k in KEYS)
    same = " AND ".join(f"l.{v} <=> r.{v}" for v in values)
    found = stored.withColumn("_there", F.lit(True))
    return (
        rolled_up.alias("l")
        .join(found.alias("r"), F.expr(same_key), "left")
        .filter(f"r._there IS NULL OR NOT ({same})")
        .selectExpr(
            *[f"l.{c}" for c in S.WINDOW_SCHEMA.names],
            f"{date_of(f'l.{S.TIME_WINDOW}')} AS date_part",
            f"CAST(l.{S.LOG_VOLUME} AS BIGINT) AS now",
            f"IF(r._there, CAST(coalesce(r.{S.LOG_VOLUME}, 0) AS BIGINT), NULL) AS was",
        )
    )
