"""The SQL analysis suite: six aggregate questions over the feature table.

Each is one grouped aggregation with a map-side combine, so what is shuffled
grows with the number of groups and not with the rows of the largest one.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskwindow import schema as S
from riskwindow.functions import date_of, share, warning_category


def basic_statistics(df: DataFrame, approx_distinct: bool = False) -> DataFrame:
    distinct = (
        f"approx_count_distinct({S.COMPONENT})"
        if approx_distinct
        else f"count(DISTINCT {S.COMPONENT})"
    )
    return df.agg(
        F.expr("count(*) AS total_records"),
        F.expr(f"{distinct} AS unique_components"),
        F.expr(f"sum({S.INCIDENT}) AS total_incidents"),
        F.expr(f"avg({S.WARN_COUNT}) AS avg_warn_count"),
        F.expr(f"avg({S.LOG_VOLUME}) AS avg_log_volume"),
        F.expr(f"avg({S.UNIQUE_EVENT_COUNT}) AS avg_unique_events"),
    )


def incident_rate_by_component(df: DataFrame) -> DataFrame:
    """Incident percentage per component, highest first."""
    rate = share(f"sum({S.INCIDENT}) * 100", "count(*)")
    return (
        df.groupBy(S.COMPONENT)
        .agg(
            F.expr("count(*) AS total_records"),
            F.expr(f"sum({S.INCIDENT}) AS incident_count"),
            F.expr(f"round({rate}, 2) AS incident_rate_percent"),
            F.expr(f"avg({S.WARN_COUNT}) AS avg_warn_count"),
            F.expr(f"avg({S.LOG_VOLUME}) AS avg_log_volume"),
        )
        .orderBy(F.desc_nulls_last("incident_rate_percent"), S.COMPONENT)
    )


def incidents_by_date(df: DataFrame) -> DataFrame:
    return (
        df.groupBy(F.expr(f"{date_of()} AS date_part"))
        .agg(
            F.expr("count(*) AS records_per_date"),
            F.expr(f"sum({S.INCIDENT}) AS incidents_per_date"),
            F.expr(f"avg({S.WARN_COUNT}) AS avg_warn_count"),
        )
        .orderBy("date_part")
    )


def component_feature_ranges(df: DataFrame) -> DataFrame:
    """Minimum, maximum and average of the three measures per component."""
    short = dict(zip(S.MEASURES, ("warn", "log_volume", "unique_events")))
    return df.groupBy(S.COMPONENT).agg(
        *[
            F.expr(f"{function}({measure}) AS {function}_{name}")
            for measure, name in short.items()
            for function in ("min", "max", "avg")
        ]
    )


def high_risk_windows(df: DataFrame) -> DataFrame:
    """Windows with an incident, in time order.

    The later sort keys break ties and keep a crowded window from falling into
    one range of the sort.
    """
    return (
        df.filter(f"{S.INCIDENT} = 1")
        .select(S.TIME_WINDOW, S.COMPONENT, *S.MEASURES, S.INCIDENT)
        .orderBy(S.TIME_WINDOW, S.COMPONENT, *S.MEASURES)
    )


def component_warning_category(
    df: DataFrame,
    high: float = S.HIGH_WARNING_AVERAGE,
    medium: float = S.MEDIUM_WARNING_AVERAGE,
) -> DataFrame:
    """Component averages with a warning category from the average count."""
    category = warning_category(f"avg({S.WARN_COUNT})", high, medium)
    return df.groupBy(S.COMPONENT).agg(
        F.expr(f"avg({S.WARN_COUNT}) AS avg_warn"),
        F.expr(f"avg({S.LOG_VOLUME}) AS avg_log_volume"),
        F.expr(f"avg({S.UNIQUE_EVENT_COUNT}) AS avg_unique_events"),
        F.expr(f"sum({S.INCIDENT}) AS total_incidents"),
        F.expr(f"{category} AS warning_category"),
    )
