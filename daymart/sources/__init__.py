"""Readers and writers."""

from daymart.sources.digests import table_digest
from daymart.sources.infer import find_types, time_formats, typed
from daymart.sources.readers import (
    TEMPORARY,
    list_tables,
    read_clean_events,
    read_raw_events,
    read_series,
    read_series_payload,
    read_table,
)
from daymart.sources.snapshots import (
    append_snapshot,
    drop_snapshots,
    read_snapshot,
    replace_snapshot,
    snapshot_versions,
)
from daymart.sources.writers import (
    check_export_names,
    export_name,
    export_parquet,
    export_relational,
    publish_model,
    save_series,
    save_table,
    write_csv,
)

__all__ = [
    "TEMPORARY",
    "append_snapshot",
    "check_export_names",
    "drop_snapshots",
    "export_name",
    "export_parquet",
    "export_relational",
    "find_types",
    "list_tables",
    "publish_model",
    "read_clean_events",
    "read_raw_events",
    "read_series",
    "read_series_payload",
    "read_snapshot",
    "read_table",
    "replace_snapshot",
    "save_series",
    "save_table",
    "snapshot_versions",
    "table_digest",
    "time_formats",
    "typed",
    "write_csv",
]
