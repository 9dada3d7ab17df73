"""Expressions shared by the operators, as SQL text for ``expr`` and ``selectExpr``.

None of them shuffles and none needs Python on the executors.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import types as T

from riskwindow import schema as S

RATIO_POLICIES = ("null", "zero", "plus_one")


def quoted(name: str) -> str:
    """A column name that SQL text can hold whatever its characters."""
    return "`" + name.replace("`", "``") + "`"


def literal(value) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(value, float):
        return f"{value!r}D"
    return str(value)


def is_missing(field: T.StructField) -> str:
    """NULL, or NaN where the type can hold one."""
    name = quoted(field.name)
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        return f"({name} IS NULL OR isnan({name}))"
    return f"{name} IS NULL"


def interaction(left: str, right: str) -> str:
    """Product of two counts, widened first so that it cannot overflow an int."""
    return f"CAST({left} AS BIGINT) * CAST({right} AS BIGINT)"


def event_ratio(volume: str, events: str, policy: str) -> str:
    """Log lines per distinct event.

    ``null``: NULL for a zero divisor. ``zero``: 0 for a zero or NULL divisor.
    ``plus_one``: divide by the count plus one.
    """
    ratios = {
        "null": share(volume, events),
        "zero": f"CASE WHEN {events} <> 0 THEN {share(volume, events)} ELSE 0D END",
        "plus_one": share(volume, f"(CAST({events} AS BIGINT) + 1)"),
    }
    if policy not in ratios:
        raise ValueError(f"unknown ratio policy {policy!r}, expected one of {RATIO_POLICIES}")
    return ratios[policy]


def above(column: str, threshold: float) -> str:
    """1 where the value is strictly above the threshold, else 0 (also for NULL)."""
    return f"CASE WHEN {column} > {threshold} THEN 1 ELSE 0 END"


def date_of(window: str = S.TIME_WINDOW) -> str:
    """Date part of a ``YYMMDD_HH`` window label."""
    return f"substr({window}, 1, 6)"


def hour_of(window: str = S.TIME_WINDOW) -> str:
    """Hour of a ``YYMMDD_HH`` window label; NULL when it is not a number."""
    return f"try_cast(substr({window}, 8, 2) AS INT)"


def window_label(day: str, hour: str) -> str:
    """``YYMMDD_HH`` of a date and an hour number."""
    return f"concat(date_format({day}, 'yyMMdd'), '_', lpad(CAST({hour} AS STRING), 2, '0'))"


def warning_category(
    average: str,
    high: float = S.HIGH_WARNING_AVERAGE,
    medium: float = S.MEDIUM_WARNING_AVERAGE,
) -> str:
    return (
        f"CASE WHEN {average} > {high} THEN 'High Warning' "
        f"WHEN {average} > {medium} THEN 'Medium Warning' ELSE 'Low Warning' END"
    )


def share(part: str, whole: str) -> str:
    """part / whole as a double, NULL when the whole is zero."""
    return f"try_divide(CAST({part} AS DOUBLE), CAST({whole} AS DOUBLE))"


def share_or_zero(part: str, whole: str) -> str:
    return f"coalesce({share(part, whole)}, 0D)"


def lookup(column: str, values: Mapping) -> str:
    """CASE over a handful of values."""
    cases = [f"WHEN {literal(key)} THEN {literal(value)}" for key, value in values.items()]
    return f"CASE {column} {' '.join(cases)} END"


def rows_from(names: Sequence[str], rows: Sequence[Sequence[str]]) -> str:
    """One output row per tuple: turns a one-row wide result into a long table.

    To be used in ``selectExpr``; each tuple holds one expression per name.
    """
    cells = ", ".join(expression for row in rows for expression in row)
    return f"stack({len(rows)}, {cells}) AS ({', '.join(quoted(name) for name in names)})"
