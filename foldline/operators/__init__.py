"""DataFrame -> DataFrame operators."""

from .columns import (
    cell_text,
    drop_incomplete,
    filter_equals,
    numeric_columns,
    project,
    rename_columns,
)
from .consolidate import COUNT_COLUMN, consolidate, multiplicity_name, row_count
from .describe import (
    box_stats,
    category_count,
    check_category_count,
    histogram,
    limit_rows,
    ordered_categories,
    outliers,
    quartiles,
    scatter_points,
)

__all__ = [
    "COUNT_COLUMN",
    "box_stats",
    "category_count",
    "cell_text",
    "check_category_count",
    "consolidate",
    "drop_incomplete",
    "filter_equals",
    "histogram",
    "limit_rows",
    "multiplicity_name",
    "numeric_columns",
    "ordered_categories",
    "outliers",
    "project",
    "quartiles",
    "rename_columns",
    "row_count",
    "scatter_points",
]
