"""The SQL analysis run: external table, six questions, summary table, export."""

from pyspark.sql import DataFrame, SparkSession

from riskwindow import schema as S
from riskwindow.operators import analysis
from riskwindow.operators.features import engineer_features
from riskwindow.sources import create_external_table, export_delimited, save_table, use_database

ANALYSES = {
    "basic_statistics": analysis.basic_statistics,
    "incident_rate_by_component": analysis.incident_rate_by_component,
    "incidents_by_date": analysis.incidents_by_date,
    "component_feature_ranges": analysis.component_feature_ranges,
    "high_risk_windows": analysis.high_risk_windows,
    "component_warning_category": analysis.component_warning_category,
}


def summary(df: DataFrame, **thresholds) -> DataFrame:
    """The ML summary: engineered features with NULL ratios for zero divisors."""
    return engineer_features(df, policy="null", with_hour=False, **thresholds)


def run_sql_suite(
    spark: SparkSession,
    source: str,
    export_path: str,
    database: str = "log_analysis",
    table: str = "window_features",
    location: str | None = None,
) -> dict[str, DataFrame]:
    """Run the whole suite over delimited files at ``source``.

    The text is parsed once, into the parquet summary table. It holds the six
    raw columns too, so the questions and the export read it instead.
    """
    use_database(spark, database, location)
    create_external_table(spark, table, source, S.WINDOW_SCHEMA)
    stored = save_table(summary(spark.table(table)), f"{table}_summary")
    export_delimited(stored, export_path)
    windows = stored.select(*S.WINDOW_SCHEMA.names)
    return {name: question(windows) for name, question in ANALYSES.items()} | {"summary": stored}
