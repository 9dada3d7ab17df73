"""The exploratory run: profile tables, group statistics, chart data, report."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskwindow import schema as S
from riskwindow.functions import literal
from riskwindow.operators import correlation, distribution, explore, quality
from riskwindow.operators.features import with_date_hour
from riskwindow.session import shared_folder
from riskwindow.sources import preview, write_parquet

# The correlation matrix covers the numbers of the raw table; the report adds the hour.
MATRIX_COLUMNS = (*S.MEASURES, S.INCIDENT)
REPORT_COLUMNS = (*MATRIX_COLUMNS, S.HOUR)


def basis(df: DataFrame) -> dict[str, DataFrame]:
    """Four small tables, one pass over the rows each, from which most others follow."""
    dated = with_date_hour(df)
    return {
        "value_frequencies": distribution.value_frequencies(
            dated, REPORT_COLUMNS, by=[S.INCIDENT], keep_missing_keys=True
        ),
        "group_profile": explore.group_profile(df),
        "column_profile": quality.column_profile(df),
        "pair_correlations": correlation.correlation_matrix(dated, REPORT_COLUMNS),
    }


def tables(df: DataFrame, basis: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Every exploratory table, in the order of the run."""
    per_label = basis["value_frequencies"]
    overall = distribution.combined(per_label)
    charted = overall.filter(_one_of("feature", S.MEASURES))
    by_label = per_label.filter(f"{_one_of('feature', S.MEASURES)} AND {S.INCIDENT} IS NOT NULL")
    profile, columns = basis["group_profile"], basis["column_profile"]
    labels = _label_counts(overall)
    matrix = basis["pair_correlations"].filter(
        f"{_one_of('x', MATRIX_COLUMNS)} AND {_one_of('y', MATRIX_COLUMNS)}"
    )
    return {
        "preview": preview(df, 10),
        "schema": columns.drop("missing"),
        "missing": columns.select("column", "missing"),
        "describe": distribution.describe(overall.filter(_one_of("feature", MATRIX_COLUMNS))),
        "incident_counts": labels,
        "incident_rate": labels.agg(
            F.expr(f"CAST(sum({S.INCIDENT} * count) AS DOUBLE) / sum(count) AS incident_rate")
        ),
        "class_share": explore.class_share(labels),
        "component_card": explore.component_card(profile),
        "component_series": explore.component_series(profile),
        "histograms": distribution.histogram(charted),
        "boxes": distribution.box_statistics(charted),
        "outliers": distribution.outlier_values(charted),
        "correlations": matrix,
        "heatmap": correlation.heatmap_cells(matrix),
        "boxes_by_incident": distribution.box_statistics(by_label, [S.INCIDENT]),
        "scatter": explore.scatter_density(df),
        "stats_by_incident": explore.incident_statistics(by_label),
        "date_stats": explore.date_stats(profile),
        "hour_stats": explore.hour_stats(profile),
        "date_hour_series": explore.date_hour_series(profile),
        "report": report(basis),
    }


def report(basis: dict[str, DataFrame]) -> DataFrame:
    """(section, key, metric, value): the printed report as one table, from the basis alone."""
    overall = distribution.combined(basis["value_frequencies"])
    shape = (
        basis["column_profile"]
        .agg(
            F.expr(f"max(IF(lower(column) = '{S.COMPONENT}', non_null + missing, NULL)) AS row_count"),
            F.expr(f"count(*) + {len((S.DATE, S.HOUR))} AS column_count"),
        )
        .unpivot([], ["row_count", "column_count"], "metric", "value")
        .selectExpr(*_report_columns("shape", "'dataset'", "metric", "value"))
    )
    counts = {
        S.INCIDENT: _label_counts(overall),
        S.COMPONENT: explore.component_counts(basis["group_profile"]),
    }
    described = distribution.describe(overall)
    statistics = [c for c in described.columns if c != "feature"]
    parts = [
        *[
            table.selectExpr(
                *_report_columns(f"{column}_distribution", column, "'count'", "count")
            )
            for column, table in counts.items()
        ],
        described.withColumn("count", F.expr("CAST(count AS DOUBLE)"))
        .unpivot("feature", statistics, "metric", "value")
        .selectExpr(*_report_columns("summary", "feature", "metric", "value")),
        basis["pair_correlations"]
        .filter(f"y = '{S.INCIDENT}'")
        .selectExpr(*_report_columns("correlation_with_incident", "x", "'r'", "r")),
    ]
    for part in parts:
        shape = shape.unionByName(part)
    return shape


def store_basis(df: DataFrame, folder: str) -> dict[str, DataFrame]:
    """The basis as parquet below ``folder``, from one reading of the rows.

    The rows are cached for the four tables; losing an executor only computes the lost part of
    them again from the source.
    """
    df.persist()
    try:
        return _stored(basis(df), folder)
    finally:
        df.unpersist()


def _stored(found: dict[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    for name, table in found.items():
        write_parquet(table, f"{folder}/{name}")
    return {name: table.sparkSession.read.schema(table.schema).parquet(f"{folder}/{name}") for name, table in found.items()}


def eda_report(df: DataFrame, folder: str | None = None) -> DataFrame:
    """The report alone, over a basis stored in ``folder``, by default a new one in the shared folder."""
    return report(store_basis(df, folder or shared_folder(df.sparkSession, "basis")))


def run_exploration(df: DataFrame, output: str) -> dict[str, DataFrame]:
    """Write every table as parquet under ``output`` and return what was written.

    The basis is stored first, so that what follows from it does not read the
    rows again; only the preview and the scatter table read them once more.
    """
    return _stored(tables(df, store_basis(df, output)), output)


def _label_counts(overall: DataFrame) -> DataFrame:
    return (
        overall.filter(f"feature = '{S.INCIDENT}'")
        .selectExpr(f"value AS {S.INCIDENT}", "n AS count")
        .orderBy(F.desc("count"), S.INCIDENT)
    )


def _one_of(column: str, names) -> str:
    return f"{column} IN ({', '.join(literal(name) for name in names)})"


def _report_columns(section: str, key: str, metric: str, value: str) -> list[str]:
    return [
        f"'{section}' AS section",
        f"CAST({key} AS STRING) AS key",
        f"{metric} AS metric",
        f"CAST({value} AS DOUBLE) AS value",
    ]
