"""Feature engineering: one narrow projection, no shuffle, batch or streaming."""

from pyspark.sql import DataFrame

from riskwindow import schema as S
from riskwindow.functions import above, date_of, event_ratio, hour_of, interaction


def engineer_features(
    df: DataFrame,
    policy: str = "zero",
    warn_threshold: int = S.WARN_THRESHOLD,
    volume_threshold: int = S.VOLUME_THRESHOLD,
    with_hour: bool = True,
) -> DataFrame:
    """Add interaction, ratio, flag and hour columns to a feature table.

    ``policy`` picks what the ratio does with a zero divisor, see
    :func:`riskwindow.functions.event_ratio`. Works without a label column, so
    that new windows can be scored.
    """
    labelled = S.INCIDENT in {name.lower() for name in df.columns}
    return df.selectExpr(
        S.COMPONENT,
        S.TIME_WINDOW,
        *S.MEASURES,
        *([f"try_cast({S.INCIDENT} AS INT) AS {S.INCIDENT}"] if labelled else []),
        f"{interaction(S.WARN_COUNT, S.LOG_VOLUME)} AS {S.INTERACTION}",
        f"{event_ratio(S.LOG_VOLUME, S.UNIQUE_EVENT_COUNT, policy)} AS {S.EVENT_RATIO}",
        f"{above(S.WARN_COUNT, warn_threshold)} AS {S.WARN_FLAG}",
        f"{above(S.LOG_VOLUME, volume_threshold)} AS {S.VOLUME_FLAG}",
        *([f"{hour_of()} AS {S.HOUR}"] if with_hour else []),
    )


def with_date_hour(df: DataFrame) -> DataFrame:
    return df.selectExpr("*", f"{date_of()} AS {S.DATE}", f"{hour_of()} AS {S.HOUR}")
