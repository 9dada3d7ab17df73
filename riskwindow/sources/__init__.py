from riskwindow.sources.catalog import (
    create_external_table,
    drop_table,
    overwrite_table,
    save_table,
    use_database,
)
from riskwindow.sources.readers import (
    PANDAS_NULL_MARKERS,
    read_dated_windows,
    read_delimited,
    read_windows,
    windows_from_events,
)
from riskwindow.sources.writers import (
    append_run,
    export_delimited,
    is_stored,
    merge_windows,
    preview,
    write_csv,
    write_json,
    write_parquet,
    write_windows,
)

__all__ = [
    "PANDAS_NULL_MARKERS",
    "append_run",
    "create_external_table",
    "drop_table",
    "export_delimited",
    "is_stored",
    "merge_windows",
    "overwrite_table",
    "preview",
    "read_dated_windows",
    "read_delimited",
    "read_windows",
    "save_table",
    "use_database",
    "windows_from_events",
    "write_csv",
    "write_json",
    "write_parquet",
    "write_windows",
]
