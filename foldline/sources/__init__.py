"""Sources: S1-S3, S5, S6 file scans; S4 and M1-M5 catalog reads."""

from .catalog import (
    attach_table,
    describe_extended,
    describe_table,
    list_databases,
    list_tables,
    preview_table,
    read_table,
    show_table,
)
from .files import (
    SourceName,
    checked_format,
    source_format,
    read_headerless_csv,
    read_source,
    require_nonempty,
)

__all__ = [
    "attach_table",
    "describe_extended",
    "describe_table",
    "SourceName",
    "checked_format",
    "list_databases",
    "list_tables",
    "source_format",
    "preview_table",
    "read_headerless_csv",
    "read_source",
    "read_table",
    "require_nonempty",
    "show_table",
]
