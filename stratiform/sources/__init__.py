"""Readers for files, file trees, lookup tables and file listings."""

from stratiform.sources.files import (
    file_formats,
    read_source,
    read_tree,
    reference_df,
    route_by_format,
    table,
)
from stratiform.sources.inventory import file_inventory, list_files
from stratiform.sources.star import star_table, trips

__all__ = [
    "file_formats",
    "file_inventory",
    "list_files",
    "read_source",
    "read_tree",
    "reference_df",
    "route_by_format",
    "star_table",
    "table",
    "trips",
]
