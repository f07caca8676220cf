"""Writers: appends, overwrites, merges and idempotent file loads."""

from stratiform.sinks.copy_into import LoadConflict, copy_into, load_batch, loaded, loaded_files, schema_versions
from stratiform.sinks.quarantine import accepted, quarantined, write_checked
from stratiform.sinks.rewrite import compact_files, merge_files, recover, replace_files
from stratiform.sinks.tables import (
    append_or_create,
    append_results,
    create_or_merge,
    optimize_table,
    overwrite_table,
    write_gold,
)

__all__ = [
    "LoadConflict",
    "accepted",
    "append_or_create",
    "append_results",
    "compact_files",
    "copy_into",
    "create_or_merge",
    "load_batch",
    "loaded",
    "loaded_files",
    "merge_files",
    "optimize_table",
    "overwrite_table",
    "quarantined",
    "recover",
    "replace_files",
    "schema_versions",
    "write_checked",
    "write_gold",
]
