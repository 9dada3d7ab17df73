from riskwindow.streaming.live import (
    merge_stream,
    read_batches,
    score_stream,
    windows_from_event_stream,
    write_batches,
    write_stream,
)

__all__ = [
    "merge_stream",
    "read_batches",
    "score_stream",
    "windows_from_event_stream",
    "write_batches",
    "write_stream",
]
