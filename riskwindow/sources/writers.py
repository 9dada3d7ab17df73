"""Ways out: parquet, delimited text, JSON, and the log of completed runs."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskwindow import schema as S
from riskwindow.functions import date_of
from riskwindow.session import discard, shared_folder
from riskwindow.sources.readers import read_dated_windows


def write_parquet(df: DataFrame, path: str, partition_by=()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_windows(df: DataFrame, path: str, whole: bool = False) -> None:
    """Store a feature table as parquet, one folder per date.

    Only the dates that ``df`` holds are replaced: a day can be added, or written again, and
    all others stay. With ``whole`` the stored table becomes ``df``, and its other dates go. The
    mode is an option of this one write, whatever the session's setting.

    The rebalance hint lets AQE gather each date into few files and still split
    a date that is much larger than the others.
    """
    dated = df.selectExpr("*", f"{date_of()} AS date_part").hint("rebalance", "date_part")
    (
        dated.write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if whole else "dynamic")
        .partitionBy("date_part")
        .parquet(path)
    )


def merge_windows(df: DataFrame, path: str, keys=(S.COMPONENT, S.TIME_WINDOW)) -> None:
    """Put rows into a table stored by date: rows of the same key are replaced, all others stay.

    Doing it again changes nothing, so a batch that is repeated after a failure leaves no duplicates. Only
    the dates of ``df`` are read and written; each date is replaced as a whole at the end of the write. Rows of
    ``df`` must not share a key. The merged rows are stored before the table is touched.
    """
    spark = df.sparkSession
    staged, merged = shared_folder(spark, "merge"), shared_folder(spark, "merged")
    try:
        df.write.parquet(staged)
        new = spark.read.schema(df.schema).parquet(staged)
        # An empty date shares the folder of missing ones.
        dates = [r[0] for r in new.selectExpr(f"nullif({date_of()}, '') AS d").distinct().collect()]
        if not dates:
            return
        rows = new
        if is_stored(spark, path):
            old = read_dated_windows(spark, path, dates=dates)
            same = " AND ".join(f"l.{key} <=> r.{key}" for key in keys)
            kept = old.alias("l").join(new.alias("r"), F.expr(same), "left_anti")
            rows = new.unionByName(kept, allowMissingColumns=True)
        rows.write.parquet(merged)
        write_windows(spark.read.schema(rows.schema).parquet(merged), path)
    finally:
        discard(spark, staged)
        discard(spark, merged)


def is_stored(spark: SparkSession, path: str) -> bool:
    """Whether a date is stored below the path."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.exists(folder) and any(
        status.getPath().getName().startswith("date_part=") for status in system.listStatus(folder)
    )


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def export_delimited(df: DataFrame, path: str, sep: str = ",", null_value: str = "\\N") -> None:
    """Headerless delimited export, with NULL written as ``\\N``."""
    (
        df.write.mode("overwrite")
        .option("header", False)
        .option("sep", sep)
        .option("nullValue", null_value)
        .csv(path)
    )


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def append_run(spark: SparkSession, path: str, results: str) -> None:
    """Add one completed run to the run table."""
    (
        spark.range(1)
        .select(F.current_timestamp().alias("completed_at"), F.lit(results).alias("results"))
        .write.mode("append")
        .parquet(path)
    )


def preview(df: DataFrame, n: int = 10, order_by=(S.COMPONENT, S.TIME_WINDOW)) -> DataFrame:
    """First rows; pass an empty order to take whatever comes first."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)
