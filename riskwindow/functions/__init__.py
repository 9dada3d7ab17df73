from riskwindow.functions.columns import (
    RATIO_POLICIES,
    above,
    date_of,
    event_ratio,
    hour_of,
    interaction,
    is_missing,
    literal,
    lookup,
    quoted,
    rows_from,
    share,
    share_or_zero,
    warning_category,
    window_label,
)

__all__ = [
    "RATIO_POLICIES",
    "above",
    "date_of",
    "event_ratio",
    "hour_of",
    "interaction",
    "is_missing",
    "literal",
    "lookup",
    "quoted",
    "rows_from",
    "share",
    "share_or_zero",
    "warning_category",
    "window_label",
]
