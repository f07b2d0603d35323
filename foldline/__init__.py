"""foldline: ingest, consolidate, publish and describe tabular data on Spark.

Every operator takes and returns Spark DataFrames and is built from
DataFrame/SQL operations that Catalyst plans; no Python runs per row.
"""

from .operators import (
    box_stats,
    cell_text,
    check_category_count,
    consolidate,
    drop_incomplete,
    filter_equals,
    histogram,
    limit_rows,
    multiplicity_name,
    numeric_columns,
    ordered_categories,
    outliers,
    project,
    quartiles,
    rename_columns,
    row_count,
    scatter_points,
)
from .plans import FlowResult, finish_flows, flow, land_source, print_file, print_rows, transform, transform_frame
from .session import build_session, checkpoint_root, scratch_dir
from .sinks import TableConflict, TableLoadError, publish_file, save_table, table_version
from .sources import (
    describe_extended,
    describe_table,
    SourceName,
    list_databases,
    list_tables,
    preview_table,
    read_headerless_csv,
    read_source,
    read_table,
    require_nonempty,
    show_table,
)
from .streaming import (
    ChangeListener,
    fingerprint,
    listen,
    read_ingested,
    refresh_if_changed,
    source_fingerprint,
    start_ingest,
    stop_ingest,
)

__all__ = [
    "ChangeListener",
    "FlowResult",
    "TableConflict",
    "TableLoadError",
    "box_stats",
    "build_session",
    "cell_text",
    "check_category_count",
    "checkpoint_root",
    "consolidate",
    "describe_extended",
    "describe_table",
    "drop_incomplete",
    "filter_equals",
    "fingerprint",
    "flow",
    "SourceName",
    "finish_flows",
    "histogram",
    "land_source",
    "limit_rows",
    "list_databases",
    "listen",
    "list_tables",
    "multiplicity_name",
    "numeric_columns",
    "ordered_categories",
    "outliers",
    "preview_table",
    "print_file",
    "print_rows",
    "project",
    "publish_file",
    "quartiles",
    "read_headerless_csv",
    "read_source",
    "read_ingested",
    "read_table",
    "refresh_if_changed",
    "rename_columns",
    "require_nonempty",
    "row_count",
    "save_table",
    "scatter_points",
    "scratch_dir",
    "show_table",
    "source_fingerprint",
    "start_ingest",
    "stop_ingest",
    "table_version",
    "transform",
    "transform_frame",
]
