"""Ways in: delimited text, parquet, catalog tables and raw event logs."""

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskwindow import schema as S
from riskwindow.functions import literal, quoted, window_label

# The cell texts that pandas reads as missing by default.
PANDAS_NULL_MARKERS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def read_delimited(
    spark: SparkSession,
    path,
    schema=S.WINDOW_SCHEMA,
    sep: str = ",",
    header: bool = True,
    null_markers: Iterable[str] = (),
    infer: bool = False,
    mode: str = "PERMISSIVE",
) -> DataFrame:
    """Read a delimited file or folder.

    The fixed schema saves the extra pass that inference costs; with a header
    its names are checked against the schema, so swapped columns fail instead
    of being read under the wrong name. ``infer=True`` takes names and types
    from the file. Cells that do not parse become NULL, and so do string cells
    equal to one of ``null_markers``.
    """
    reader = spark.read.option("sep", sep).option("header", header).option("mode", mode)
    if infer:
        df = reader.option("inferSchema", True).csv(path)
    else:
        df = reader.schema(schema).option("enforceSchema", not header).csv(path)
    markers = ", ".join(literal(marker) for marker in null_markers)
    if not markers:
        return df
    return df.selectExpr(
        *[
            f"IF({quoted(name)} IN ({markers}), NULL, {quoted(name)}) AS {quoted(name)}"
            if kind == "string"
            else quoted(name)
            for name, kind in df.dtypes
        ]
    )


def read_windows(
    spark: SparkSession, source: str, format: str | None = None, **options
) -> DataFrame:
    """Feature table from a path, or from the catalog with ``format="table"``.

    Without a format, paths ending in ``.parquet`` are read as parquet and all
    others as delimited text. A missing path raises Spark's AnalysisException.
    """
    kind = format or ("parquet" if source.rstrip("/").endswith(".parquet") else "csv")
    if kind == "table":
        return spark.table(source)
    if kind == "parquet":
        return spark.read.parquet(source)
    if kind == "csv":
        return read_delimited(spark, source, **options)
    raise ValueError(f"unknown source format {kind!r}")


def read_dated_windows(
    spark: SparkSession,
    path: str,
    first: str | None = None,
    last: str | None = None,
    dates: Iterable[str | None] | None = None,
    keep_date: bool = False,
) -> DataFrame:
    """A feature table stored by date, from ``first`` to ``last`` (``YYMMDD``), or of some dates.

    Only the folders of these dates are listed and read. The folder names are
    taken as text, so that leading zeros stay; counts may be stored as INT or BIGINT. ``keep_date``
    keeps the date as ``date_part``.
    """
    stored = [f for f in spark.read.parquet(path).schema.fields if f.name != "date_part"]
    schema = T.StructType([*stored, T.StructField("date_part", T.StringType())])
    df = spark.read.schema(schema).parquet(path)
    if first is not None:
        df = df.filter(f"date_part >= {literal(first)}")
    if last is not None:
        df = df.filter(f"date_part <= {literal(last)}")
    if dates is not None:
        named = [literal(date) for date in dates if date is not None]
        # A date that does not parse lies in a folder of its own, whose name Spark reads as NULL.
        tests = ["date_part IS NULL"] * (None in set(dates)) + [f"date_part IN ({', '.join(named)})"] * bool(named)
        df = df.filter(" OR ".join(tests) or "false")
    return df if keep_date else df.drop("date_part")


def windows_from_events(
    events: DataFrame,
    component: str,
    event: str,
    warning: str,
    incident: str,
    time: str = "ts",
) -> DataFrame:
    """Roll raw log events up to one row per component and hour.

    The mapping is given as SQL expressions over the event columns; ``warning``
    and ``incident`` are conditions.

    The keys stay a date and an hour number until after the aggregation, so the
    label is formatted once per output row, not once per event. The distinct
    count makes Spark aggregate by (key, event) before it shuffles by key, so a
    component that holds a third of the log does not become one large task.
    Counts are BIGINT; tables that store them as INT are read as well.
    """
    keyed = events.selectExpr(
        f"{component} AS {S.COMPONENT}",
        f"to_date({time}) AS _day",
        f"hour({time}) AS _hour",
        f"{event} AS _event",
        f"CASE WHEN {warning} THEN 1 ELSE 0 END AS _warning",
        f"CASE WHEN {incident} THEN 1 ELSE 0 END AS _incident",
    )
    hourly = keyed.groupBy(S.COMPONENT, "_day", "_hour").agg(
        F.expr(f"sum(_warning) AS {S.WARN_COUNT}"),
        F.expr(f"count(*) AS {S.LOG_VOLUME}"),
        F.expr(f"count(DISTINCT _event) AS {S.UNIQUE_EVENT_COUNT}"),
        F.expr(f"max(_incident) AS {S.INCIDENT}"),
    )
    label = window_label("_day", "_hour")
    return hourly.selectExpr(
        S.COMPONENT, f"{label} AS {S.TIME_WINDOW}", *S.MEASURES, S.INCIDENT
    )
