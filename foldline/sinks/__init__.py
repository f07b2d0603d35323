"""Sinks: K1 published files, K2-K7 guarded tables."""

from .files import output_name, publish_file, swap_in
from .tables import TableConflict, TableLoadError, column_type, save_table, table_location, table_schema, table_version

__all__ = [
    "TableConflict",
    "TableLoadError",
    "column_type",
    "output_name",
    "publish_file",
    "save_table",
    "swap_in",
    "table_location",
    "table_schema",
    "table_version",
]
