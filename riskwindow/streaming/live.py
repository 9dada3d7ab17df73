"""The feature roll-up and the scoring on live logs."""

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskwindow import schema as S
from riskwindow.functions import window_label
from riskwindow.operators.models import score_windows
from riskwindow.sources import merge_windows

GRAIN = "1 hour"

# The instant whose UTC fields are the event's wall-clock time in the session's zone. Windows of an
# hour then begin where the batch roll-up's hours do, whatever the zone's offset.
_WALL_CLOCK = (
    "timestamp_seconds(unix_date(CAST(_wall AS DATE)) * 86400L"
    " + hour(_wall) * 3600 + minute(_wall) * 60 + second(_wall))"
)
_DAY_AND_HOUR = (
    "date_from_unix_date(CAST(floor(unix_seconds(_hour.start) / 86400) AS INT))",
    "CAST(pmod(unix_seconds(_hour.start), 86400L) DIV 3600 AS INT)",
)


def windows_from_event_stream(
    events: DataFrame,
    component: str,
    event: str,
    warning: str,
    incident: str,
    time: str = "ts",
    delay: str = "2 hours",
) -> DataFrame:
    """One row per component and closed hour, from a stream of raw events.

    The mapping is given as SQL expressions, as for the batch roll-up. The
    distinct events are counted exactly, by two chained aggregations: first
    per (hour, component, event), then per (hour, component). Events later than
    ``delay`` behind the newest one are dropped, and an hour is emitted once the
    watermark has passed its end. ``plans.rollup.close_windows`` adds the hours that are still open,
    brings in late events and counts them.
    """
    keyed = events.selectExpr(f"CAST({time} AS TIMESTAMP_NTZ) AS _wall", "*").selectExpr(
        f"{_WALL_CLOCK} AS _time",
        f"{component} AS {S.COMPONENT}",
        f"{event} AS _event",
        f"CASE WHEN {warning} THEN 1 ELSE 0 END AS _warning",
        f"CASE WHEN {incident} THEN 1 ELSE 0 END AS _incident",
    ).withWatermark("_time", delay)
    per_event = keyed.groupBy(F.window("_time", GRAIN).alias("_window"), S.COMPONENT, "_event").agg(
        F.expr("sum(_warning) AS _warning"),
        F.expr("count(*) AS _events"),
        F.expr("max(_incident) AS _incident"),
    )
    hourly = per_event.groupBy(
        F.window(F.window_time("_window"), GRAIN).alias("_hour"), S.COMPONENT
    ).agg(
        F.expr(f"sum(_warning) AS {S.WARN_COUNT}"),
        F.expr(f"sum(_events) AS {S.LOG_VOLUME}"),
        F.expr(f"count(_event) AS {S.UNIQUE_EVENT_COUNT}"),
        F.expr(f"max(_incident) AS {S.INCIDENT}"),
    )
    return hourly.selectExpr(
        S.COMPONENT,
        f"{window_label(*_DAY_AND_HOUR)} AS {S.TIME_WINDOW}",
        *S.MEASURES,
        S.INCIDENT,
    )


def score_stream(
    model: PipelineModel, windows: DataFrame, policy: str = "zero", **thresholds
) -> DataFrame:
    """Engineer and score raw six-column rows as they arrive.

    Rows that cannot be scored come out with a NULL prediction.
    """
    return score_windows(model, windows, policy, **thresholds)


def write_stream(df: DataFrame, path: str, checkpoint: str, available_now: bool = False):
    """Append a stream to parquet. ``checkpoint`` must be on shared storage."""
    return _start(df.writeStream.format("parquet").option("path", path), checkpoint, available_now)


#: Names the folders of :func:`write_batches`.
BATCH = "batch_part"


def write_batches(df: DataFrame, path: str, checkpoint: str, available_now: bool = False):
    """Store each batch of a stream in a folder of its own below ``path``, named by the batch's id.

    A batch that is repeated after a failure replaces what its first try has left, so no row comes twice,
    and other formats than files could be written the same way. One ``checkpoint`` belongs to one
    ``path``: a new one would count its batches from 0 again.
    """

    def store(batch: DataFrame, number: int) -> None:
        (
            batch.withColumn(BATCH, F.lit(number).cast("long"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(BATCH)
            .parquet(path)
        )

    return _start(df.writeStream.foreachBatch(store), checkpoint, available_now)


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all batches that :func:`write_batches` has stored."""
    return spark.read.parquet(path).drop(BATCH)


def merge_stream(df: DataFrame, path: str, checkpoint: str, available_now: bool = False):
    """Merge a stream of windows into a table stored by date.

    Windows of the same component and hour are replaced, so a repeated batch changes nothing, and the
    stream may go on with a table that a batch run has written or closed.
    """

    def merge(batch: DataFrame, number: int) -> None:
        merge_windows(batch, path)

    return _start(df.writeStream.foreachBatch(merge), checkpoint, available_now)


def _start(writer, checkpoint: str, available_now: bool):
    writer = writer.outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start() if available_now else writer.start()
