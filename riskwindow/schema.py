"""Column names, types and default cut-offs of the log-window feature table.

One row describes one component during one hour: how many warnings it logged,
how many lines, how many distinct events, and whether an incident happened.
"""

from pyspark.sql import types as T

COMPONENT = "component"
TIME_WINDOW = "time_window"
WARN_COUNT = "warn_count"
LOG_VOLUME = "log_volume"
UNIQUE_EVENT_COUNT = "unique_event_count"
INCIDENT = "incident"

WINDOW_SCHEMA = T.StructType(
    [
        T.StructField(COMPONENT, T.StringType()),
        T.StructField(TIME_WINDOW, T.StringType()),
        T.StructField(WARN_COUNT, T.IntegerType()),
        T.StructField(LOG_VOLUME, T.IntegerType()),
        T.StructField(UNIQUE_EVENT_COUNT, T.IntegerType()),
        T.StructField(INCIDENT, T.IntegerType()),
    ]
)

PREDICTION_SCHEMA = T.StructType(
    [
        T.StructField("y_true", T.IntegerType()),
        T.StructField("y_pred", T.IntegerType()),
        T.StructField("y_proba", T.DoubleType()),
    ]
)

MEASURES = (WARN_COUNT, LOG_VOLUME, UNIQUE_EVENT_COUNT)

# Columns engineered from the six above.
INTERACTION = "warn_log_interaction"
EVENT_RATIO = "log_per_event_ratio"
WARN_FLAG = "high_warn_flag"
VOLUME_FLAG = "high_log_volume_flag"
HOUR = "hour"
DATE = "date"

NUMERIC_FEATURES = (
    WARN_COUNT,
    LOG_VOLUME,
    UNIQUE_EVENT_COUNT,
    INTERACTION,
    EVENT_RATIO,
    WARN_FLAG,
    VOLUME_FLAG,
    HOUR,
)

# Cut-offs, split share, seed and gate thresholds.
WARN_THRESHOLD = 5
VOLUME_THRESHOLD = 20
HIGH_WARNING_AVERAGE = 5
MEDIUM_WARNING_AVERAGE = 2
TEST_SHARE = 0.2
SEED = 42
MIN_ACCURACY = 0.70
MIN_F1 = 0.60
MIN_AUC = 0.70
