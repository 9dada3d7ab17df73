"""Answers over growing tables from what is stored for each date.

For every date of a feature table a small table holds the rows of each (component, hour) in sums, counts,
minima and maxima, and another one sketches of the distinct components and of the distribution of each
measure. A new day reads the rows of that day only; any range of dates is answered from the stored tables. Rows
without a date, an empty one included, are stored together under a missing date.

Sums and counts are exact: every table here equals the one of the same name over the rows. The sketches
are not: a distinct count of HyperLogLog with 2^``PRECISION`` registers has a standard error of 1.04 /
sqrt(2^``PRECISION``), 1.6 % at the default, and a quantile's rank of the KLL sketch is off by 1.33 % of the rows or less
with 99 % confidence at Spark's default size, whatever the number of merged dates.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskwindow import schema as S
from riskwindow.functions import date_of, hour_of, rows_from, share, warning_category
from riskwindow.operators import explore
from riskwindow.operators.distribution import QUARTILES, quantile_name
from riskwindow.sources import read_dated_windows

PRECISION = 12
_COLUMNS = (*S.MEASURES, S.INCIDENT)
#: How a stored column of the partial table goes on being combined.
_COMBINED = {"count": "sum", "sum": "sum", "min": "min", "max": "max"}
_WELL_FORMED = f"coalesce({S.TIME_WINDOW} RLIKE '^[0-9]{{6}}_[0-9]{{2}}$', false)"


def partials(windows: DataFrame) -> DataFrame:
    """One row per date, component and hour: rows, malformed labels and the parts of each column's statistics."""
    return windows.groupBy(
        F.expr(f"{date_of()} AS date_part"), F.expr(f"{hour_of()} AS hour_part"), S.COMPONENT
    ).agg(
        F.expr("count(*) AS records"),
        F.expr(f"count({S.TIME_WINDOW}) AS labelled"),
        F.expr(f"count_if(NOT {_WELL_FORMED}) AS malformed"),
        *[F.expr(f"{f}({c}) AS {f}_{c}") for c in _COLUMNS for f in _COMBINED],
    )


def sketches(windows: DataFrame) -> DataFrame:
    """One row per date: sketches of the distinct components and of each measure's distribution."""
    return windows.groupBy(F.expr(f"{date_of()} AS date_part")).agg(
        F.expr(f"hll_sketch_agg({S.COMPONENT}, {PRECISION}) AS components"),
        *[F.expr(f"kll_sketch_agg_bigint(CAST({m} AS BIGINT)) AS values_{m}") for m in S.MEASURES],
    )


def store_days(windows: DataFrame, path: str) -> None:
    """Store partials and sketches of the dates of ``windows``, in place of those stored before for them.

    To add or renew some days, pass these days, whole: ``read_dated_windows(spark, table, day, day)``.
    """
    for name, table in (("partials", partials(windows)), ("sketches", sketches(windows))):
        (
            table.hint("rebalance", "date_part")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("date_part")
            .parquet(f"{path}/{name}")
        )


def read_days(
    spark: SparkSession, path: str, name: str = "partials", first: str | None = None, last: str | None = None
) -> DataFrame:
    """The stored ``partials`` or ``sketches`` of a range of dates, with the date as ``date_part``."""
    return read_dated_windows(spark, f"{path}/{name}", first, last, keep_date=True)


def combined(days: DataFrame, *keys: str) -> DataFrame:
    """Partials summed up for each value of the keys, given as SQL with a name."""
    return days.groupBy(*[F.expr(key) for key in keys]).agg(
        *[F.expr(f"sum({c}) AS {c}") for c in ("records", "labelled", "malformed")],
        *[F.expr(f"{then}({f}_{c}) AS {f}_{c}") for c in _COLUMNS for f, then in _COMBINED.items()],
    )


def _mean(column: str) -> str:
    return share(f"sum_{column}", f"count_{column}")


def basic_statistics(days: DataFrame) -> DataFrame:
    """As :func:`analysis.basic_statistics`; the components are counted exactly."""
    different = days.select(S.COMPONENT).distinct().agg(F.expr(f"count({S.COMPONENT}) AS unique_components"))
    return combined(days).select(
        F.expr("coalesce(records, 0L) AS total_records"),
        different.scalar().alias("unique_components"),
        F.expr(f"sum_{S.INCIDENT} AS total_incidents"),
        F.expr(f"{_mean(S.WARN_COUNT)} AS avg_warn_count"),
        F.expr(f"{_mean(S.LOG_VOLUME)} AS avg_log_volume"),
        F.expr(f"{_mean(S.UNIQUE_EVENT_COUNT)} AS avg_unique_events"),
    )


def incident_rate_by_component(days: DataFrame) -> DataFrame:
    rate = share(f"sum_{S.INCIDENT} * 100", "records")
    return (
        combined(days, S.COMPONENT)
        .selectExpr(
            S.COMPONENT,
            "records AS total_records",
            f"sum_{S.INCIDENT} AS incident_count",
            f"round({rate}, 2) AS incident_rate_percent",
            f"{_mean(S.WARN_COUNT)} AS avg_warn_count",
            f"{_mean(S.LOG_VOLUME)} AS avg_log_volume",
        )
        .orderBy(F.desc_nulls_last("incident_rate_percent"), S.COMPONENT)
    )


def incidents_by_date(days: DataFrame) -> DataFrame:
    return (
        combined(days, "date_part")
        .selectExpr(
            "date_part",
            "records AS records_per_date",
            f"sum_{S.INCIDENT} AS incidents_per_date",
            f"{_mean(S.WARN_COUNT)} AS avg_warn_count",
        )
        .orderBy("date_part")
    )


def component_feature_ranges(days: DataFrame) -> DataFrame:
    short = dict(zip(S.MEASURES, ("warn", "log_volume", "unique_events")))
    columns = [
        f"{expression} AS {function}_{name}"
        for m, name in short.items()
        for function, expression in (("min", f"min_{m}"), ("max", f"max_{m}"), ("avg", _mean(m)))
    ]
    return combined(days, S.COMPONENT).selectExpr(S.COMPONENT, *columns)


def component_warning_category(
    days: DataFrame, high: float = S.HIGH_WARNING_AVERAGE, medium: float = S.MEDIUM_WARNING_AVERAGE
) -> DataFrame:
    return combined(days, S.COMPONENT).selectExpr(
        S.COMPONENT,
        f"{_mean(S.WARN_COUNT)} AS avg_warn",
        f"{_mean(S.LOG_VOLUME)} AS avg_log_volume",
        f"{_mean(S.UNIQUE_EVENT_COUNT)} AS avg_unique_events",
        f"sum_{S.INCIDENT} AS total_incidents",
        f"{warning_category(_mean(S.WARN_COUNT), high, medium)} AS warning_category",
    )


def group_profile(days: DataFrame, groupings: Sequence[str] = tuple(explore.GROUPINGS)) -> DataFrame:
    """As :func:`explore.group_profile`, for ``component_card``, ``date_stats`` and ``hour_stats``."""
    keys = {S.COMPONENT: S.COMPONENT, S.DATE: "date_part", S.HOUR: "hour_part"}
    long = days.selectExpr("*", rows_from(["grouping", "key"], [(f"'{g}'", f"CAST({keys[g]} AS STRING)") for g in groupings]))
    return combined(long.filter("key IS NOT NULL"), "grouping", "key").selectExpr(
        "grouping", "key", "records", *[f"{f}_{c}" for c in _COLUMNS for f in ("count", "sum", "max")]
    )


def missing_by_column(days: DataFrame) -> DataFrame:
    """Missing cells of the six columns."""
    missing = {
        S.COMPONENT: f"sum(IF({S.COMPONENT} IS NULL, records, 0))",
        S.TIME_WINDOW: "sum(records - labelled)",
        **{c: f"sum(records - count_{c})" for c in _COLUMNS},
    }
    counted = days.agg(*[F.expr(f"coalesce({e}, 0) AS m{i}") for i, e in enumerate(missing.values())])
    return counted.selectExpr(rows_from(["column", "missing"], [(f"'{c}'", f"m{i}") for i, c in enumerate(missing)]))


def dataset_stats(days: DataFrame) -> DataFrame:
    """As :func:`quality.dataset_stats` over windows."""
    cells = " + ".join(f"(records - count_{c})" for c in _COLUMNS)
    return days.agg(
        F.expr("coalesce(sum(records), 0L) AS total_records"),
        F.expr(f"CAST({len(S.WINDOW_SCHEMA)} AS BIGINT) AS total_features"),
        F.expr(f"sum(sum_{S.INCIDENT}) AS incident_count"),
        F.expr(f"{share(f'sum(sum_{S.INCIDENT})', f'sum(count_{S.INCIDENT})')} AS incident_rate"),
        F.expr(
            f"coalesce(sum(records - labelled + IF({S.COMPONENT} IS NULL, records, 0) + {cells}), 0L) AS missing_values"
        ),
        F.expr("coalesce(sum(malformed), 0L) AS malformed_windows"),
    )


def distinct_components(days: DataFrame) -> DataFrame:
    """About how many components a range of dates has, from its sketches."""
    merged = days.agg(F.expr("hll_union_agg(components) AS components"))
    return merged.selectExpr("coalesce(hll_sketch_estimate(components), 0L) AS unique_components")


def approximate_quantiles(days: DataFrame, probabilities: Sequence[float] = QUARTILES) -> DataFrame:
    """(feature, count, p…) of each measure over a range of dates, from its sketches."""
    wanted = f"array({', '.join(f'{float(p)!r}D' for p in probabilities)})"
    merged = days.agg(*[F.expr(f"kll_merge_agg_bigint(values_{m}) AS {m}") for m in S.MEASURES])
    long = merged.selectExpr(rows_from(["feature", "sketch"], [(f"'{m}'", m) for m in S.MEASURES]))
    return (
        long.selectExpr("feature", "kll_sketch_get_n_bigint(sketch) AS count", "sketch")
        .filter("count > 0")
        .selectExpr("feature", "count", f"kll_sketch_get_quantile_bigint(sketch, {wanted}) AS q")
        .selectExpr("feature", "count", *[f"q[{i}] AS {quantile_name(p)}" for i, p in enumerate(probabilities)])
    )
