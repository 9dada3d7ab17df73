"""Exploratory group statistics and the series behind the charts.

Rows with a missing group key are left out here, as a pandas ``groupby`` does;
the SQL suite in :mod:`riskwindow.operators.analysis` keeps them. The tables
per component, date and hour are computed from :func:`group_profile`, which a
run can compute for all three groupings in one pass and store.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskwindow import schema as S
from riskwindow.functions import date_of, hour_of, literal, quoted, rows_from, share
from riskwindow.operators.distribution import describe, value_frequencies


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return (
        df.filter(f"{quoted(column)} IS NOT NULL")
        .groupBy(quoted(column))
        .agg(F.expr("count(*) AS count"))
        .orderBy(F.desc("count"), quoted(column))
    )


def target_rate(df: DataFrame) -> DataFrame:
    return df.agg(F.expr(f"avg({S.INCIDENT}) AS incident_rate"))


GROUPINGS = {
    S.COMPONENT: S.COMPONENT,
    S.DATE: date_of(),
    S.HOUR: hour_of(),
}


def group_profile(df: DataFrame, groupings: Sequence[str] = tuple(GROUPINGS)) -> DataFrame:
    """Sums, counts and maxima per (grouping, key), for several groupings in one pass."""
    keys = rows_from(
        ["grouping", "key"],
        [(literal(g), f"CAST({GROUPINGS[g]} AS STRING)") for g in groupings],
    )
    columns = [*S.MEASURES, S.INCIDENT]
    return (
        df.selectExpr(keys, *columns)
        .filter("key IS NOT NULL")
        .groupBy("grouping", "key")
        .agg(
            F.expr("count(*) AS records"),
            *[
                F.expr(f"{function}({c}) AS {function}_{c}")
                for c in columns
                for function in ("count", "sum", "max")
            ],
        )
    )


def _mean(column: str) -> str:
    return share(f"sum_{column}", f"count_{column}")


def _rounded_mean(column: str) -> str:
    """The mean with two decimals, as numpy rounds: the scaled double, half to even."""
    return f"rint({_mean(column)} * 100) / 100"


def component_counts(profile: DataFrame) -> DataFrame:
    return (
        profile.filter(f"grouping = '{S.COMPONENT}'")
        .selectExpr(f"key AS {S.COMPONENT}", "records AS count")
        .orderBy(F.desc("count"), S.COMPONENT)
    )


def component_card(profile: DataFrame) -> DataFrame:
    """Counts, incident rate, means and maxima per component, rounded half-even.

    The rate is a fraction; the order follows the rounded rate.
    """
    names = {
        S.WARN_COUNT: "warn_count",
        S.LOG_VOLUME: "log_volume",
        S.UNIQUE_EVENT_COUNT: "unique_events",
    }
    measured = [
        sql
        for measure, name in names.items()
        for sql in (f"{_rounded_mean(measure)} AS avg_{name}", f"max_{measure} AS max_{name}")
    ]
    return (
        profile.filter(f"grouping = '{S.COMPONENT}'")
        .selectExpr(
            f"key AS {S.COMPONENT}",
            f"count_{S.INCIDENT} AS total_records",
            f"sum_{S.INCIDENT} AS incident_count",
            f"{_rounded_mean(S.INCIDENT)} AS incident_rate",
            *measured,
        )
        .orderBy(F.desc_nulls_last("incident_rate"), S.COMPONENT)
    )


def date_stats(profile: DataFrame) -> DataFrame:
    return _incident_stats(profile, S.DATE, "key")


def hour_stats(profile: DataFrame) -> DataFrame:
    return _incident_stats(profile, S.HOUR, "CAST(key AS INT)")


def _incident_stats(profile: DataFrame, grouping: str, key: str) -> DataFrame:
    return (
        profile.filter(f"grouping = '{grouping}'")
        .selectExpr(
            f"{key} AS {grouping}",
            f"count_{S.INCIDENT} AS total_records",
            f"sum_{S.INCIDENT} AS incident_count",
            f"{_mean(S.INCIDENT)} AS incident_rate",
            f"{_mean(S.WARN_COUNT)} AS avg_warn_count",
        )
        .orderBy(grouping)
    )


def stats_by_incident(df: DataFrame, columns=S.MEASURES) -> DataFrame:
    """Mean, sample deviation and median per label; one-row groups have no deviation."""
    return incident_statistics(value_frequencies(df, columns, by=[S.INCIDENT]))


def incident_statistics(frequencies: DataFrame) -> DataFrame:
    """The same from value frequencies per label."""
    return describe(frequencies, by=[S.INCIDENT], probabilities=[0.5]).selectExpr(
        S.INCIDENT, "feature", "mean", "std", "p50 AS median"
    )


def class_share(counts: DataFrame) -> DataFrame:
    """Rows per label and their percentage of all labelled rows, one decimal.

    Takes the value counts of the label.
    """
    total = counts.agg(F.expr("sum(count)")).scalar()
    percent = share("count * 100", "_total")
    return (
        counts.withColumn("_total", total)
        .selectExpr(S.INCIDENT, "count", f"round({percent}, 1) AS share_percent")
        .orderBy(F.desc("count"), S.INCIDENT)
    )


def component_series(profile: DataFrame) -> DataFrame:
    """The four ranked component series: records, incident rate, mean warnings, mean volume."""
    series = rows_from(
        ["series", "value"],
        [
            ("'record_count'", "CAST(records AS DOUBLE)"),
            ("'incident_rate'", _mean(S.INCIDENT)),
            ("'avg_warn_count'", _mean(S.WARN_COUNT)),
            ("'avg_log_volume'", _mean(S.LOG_VOLUME)),
        ],
    )
    return (
        profile.filter(f"grouping = '{S.COMPONENT}'")
        .selectExpr(f"key AS {S.COMPONENT}", series)
        .orderBy("series", F.desc_nulls_last("value"), S.COMPONENT)
    )


def scatter_density(df: DataFrame) -> DataFrame:
    """Points of the warnings/volume scatter with how often each occurs."""
    return df.groupBy(S.WARN_COUNT, S.LOG_VOLUME, S.INCIDENT).agg(F.expr("count(*) AS points"))


def date_hour_series(profile: DataFrame) -> DataFrame:
    """The four time series: incidents by date; rate, mean warnings and records by hour."""
    series = {
        "incident_count_by_date": (S.DATE, f"CAST(sum_{S.INCIDENT} AS DOUBLE)"),
        "incident_rate_by_hour": (S.HOUR, _mean(S.INCIDENT)),
        "avg_warn_count_by_hour": (S.HOUR, _mean(S.WARN_COUNT)),
        "records_by_hour": (S.HOUR, f"CAST(count_{S.INCIDENT} AS DOUBLE)"),
    }
    keys = {S.DATE: "key", S.HOUR: "lpad(key, 2, '0')"}
    rows = [
        (literal(name), f"IF(grouping = '{grouping}', {keys[grouping]}, NULL)", value)
        for name, (grouping, value) in series.items()
    ]
    return (
        profile.selectExpr(rows_from(["series", "key", "value"], rows))
        .filter("key IS NOT NULL")
        .orderBy("series", "key")
    )


def top_windows(df: DataFrame, measure: str = S.LOG_VOLUME, n: int = 10) -> DataFrame:
    """The n windows with the largest measure."""
    return df.orderBy(F.desc_nulls_last(measure), S.TIME_WINDOW, S.COMPONENT).limit(n)
