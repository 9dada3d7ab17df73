"""Checks and profile counts. Every table here comes from a single aggregation."""

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskwindow import schema as S
from riskwindow.functions import is_missing, literal, quoted, rows_from


def require_columns(df: DataFrame, columns: Iterable[str] = (S.INCIDENT,)) -> None:
    """Raise ValueError before any job runs when a column is absent."""
    present = {name.lower() for name in df.columns}
    absent = [name for name in columns if name.lower() not in present]
    if absent:
        raise ValueError(f"required columns not found: {', '.join(absent)}")


def require_rows(df: DataFrame) -> None:
    if df.isEmpty():
        raise ValueError("the table has no rows; nothing can be computed from it")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def shape(df: DataFrame) -> DataFrame:
    return df.agg(
        F.expr("count(*) AS row_count"),
        F.expr(f"CAST({len(df.columns)} AS BIGINT) AS column_count"),
    )


def column_profile(df: DataFrame) -> DataFrame:
    """Position, name, type, non-null count and missing count of every column."""
    fields = df.schema.fields
    counted = df.agg(
        *[F.expr(f"count({quoted(f.name)}) AS c{i}") for i, f in enumerate(fields)],
        *[F.expr(f"count_if({is_missing(f)}) AS m{i}") for i, f in enumerate(fields)],
    )
    rows = [
        (str(i), literal(f.name), literal(f.dataType.simpleString()), f"c{i}", f"m{i}")
        for i, f in enumerate(fields)
    ]
    names = ["position", "column", "type", "non_null", "missing"]
    return counted.selectExpr(rows_from(names, rows))


def schema_table(df: DataFrame) -> DataFrame:
    return column_profile(df).drop("missing")


def missing_by_column(df: DataFrame, only_present: bool = False) -> DataFrame:
    """Missing cells per column; ``only_present`` keeps columns that have some."""
    long = column_profile(df).select("column", "missing")
    return long.filter("missing > 0") if only_present else long


def missing_total(df: DataFrame) -> DataFrame:
    return df.agg(F.expr(f"{_missing_cells(df)} AS missing_values"))


def dataset_stats(df: DataFrame, label: str = S.INCIDENT, windows: bool = False) -> DataFrame:
    """One row: records, columns (label included), incidents, rate, missing cells.

    ``windows=True`` adds how many window labels do not read ``YYMMDD_HH``.
    """
    return df.agg(
        F.expr("count(*) AS total_records"),
        F.expr(f"CAST({len(df.columns)} AS BIGINT) AS total_features"),
        F.expr(f"sum({label}) AS incident_count"),
        F.expr(f"avg({label}) AS incident_rate"),
        F.expr(f"{_missing_cells(df)} AS missing_values"),
        *([_malformed_windows()] if windows else []),
    )


def malformed_windows(df: DataFrame) -> DataFrame:
    return df.agg(_malformed_windows())


def _malformed_windows():
    return F.expr(
        f"count_if(NOT coalesce({S.TIME_WINDOW} RLIKE '^[0-9]{{6}}_[0-9]{{2}}$', false)) "
        "AS malformed_windows"
    )


def _missing_cells(df: DataFrame) -> str:
    return " + ".join(f"count_if({is_missing(f)})" for f in df.schema.fields)
