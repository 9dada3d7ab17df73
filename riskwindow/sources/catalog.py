"""Databases and tables in Spark's catalog."""

from pyspark.sql import DataFrame, SparkSession

from riskwindow import schema as S
from riskwindow.functions import literal, quoted


def use_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create a database if need be and make it the current one.

    Without a location its tables go to the session's warehouse folder.
    """
    where = f" LOCATION {literal(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(name)}{where}")
    spark.catalog.setCurrentDatabase(name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def create_external_table(
    spark: SparkSession, name: str, path: str, schema=S.WINDOW_SCHEMA, sep: str = ","
) -> DataFrame:
    """(Re)create a table over delimited files that stay where they are."""
    drop_table(spark, name)
    return spark.catalog.createTable(name, path, "csv", schema, header="true", sep=sep)


def overwrite_table(df: DataFrame, name: str) -> None:
    """Bulk load: replace the rows of an existing table.

    Columns go by name, whatever their order; missing and unknown ones are an error.
    """
    wanted = df.sparkSession.table(name).columns
    given = {c.lower() for c in df.columns}
    if given != {c.lower() for c in wanted} or len(df.columns) != len(wanted):
        raise ValueError(f"{name} has the columns {wanted}, the new rows have {df.columns}")
    df.select(*map(quoted, wanted)).write.mode("overwrite").insertInto(name)


def save_table(df: DataFrame, name: str) -> DataFrame:
    """Create or replace a managed parquet table from a query."""
    df.write.mode("overwrite").format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)
