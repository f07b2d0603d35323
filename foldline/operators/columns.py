"""Renames, filters, projections and per-cell conversions.

All are narrow transformations: Catalyst pushes the equality filter and the
projection into the scan (``PushedFilters`` / ``ReadSchema``) and fuses the rest
into one whole-stage-codegen span.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import check_unique, col, drop_nulls, require_text, resolve
from ..functions.values import cell_text as _cell_text
from ..functions.values import finite_double


def rename_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Bind new names by position; the count must match."""
    if isinstance(names, str) or names is None:
        raise ValueError("column names must be a list of text")
    names = list(names)
    if len(names) != len(df.columns):
        raise ValueError(
            f"{len(names)} column names given for {len(df.columns)} columns"
        )
    for name in names:
        require_text(name, "column name")
    check_unique(names)
    return df.toDF(*names)


def filter_equals(df: DataFrame, column: str, value) -> DataFrame:
    """Keep rows whose ``column`` equals ``value``.

    Null never compares equal, so ``value=None`` keeps no rows and null cells
    never match. Under ANSI mode a text value that cannot become the column's
    type fails the job at run time.
    """
    name = resolve(df, column)
    return df.where(col(name) == F.lit(value))


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Select existing columns by name."""
    if isinstance(columns, str):
        columns = [columns]
    resolved = [resolve(df, c) for c in columns]
    return df.select(*[col(c) for c in resolved])


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with null or NaN in any of ``columns`` (all if None)."""
    return drop_nulls(df, [resolve(df, c) for c in (columns or df.columns)])


def numeric_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """P5: cast ``columns`` to double; non-finite or non-numeric values fail the job."""
    wanted = {resolve(df, c) for c in columns}
    return df.select(
        *[finite_double(c).alias(c) if c in wanted else col(c) for c in df.columns]
    )


def cell_text(df: DataFrame) -> DataFrame:
    """Every column as display text (null -> '', nested -> JSON)."""
    return df.select(
        *[_cell_text(f.name, f.dataType).alias(f.name) for f in df.schema.fields]
    )
