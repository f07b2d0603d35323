"""A1-A3: duplicate consolidation and row counts.

A1 stores a multiset as distinct rows plus a multiplicity. It is one
``groupBy(all columns).count()``: Spark runs a partial hash aggregate before the
shuffle, so a row repeated billions of times leaves every map task as one row
with a count, and a hot group cannot overload the reduce side. Nulls group
together; NaN groups with NaN and -0.0 with 0.0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import cols, free_name

# Fixed value: the multiplicity column (suffixed _2, _3, ... when taken).
COUNT_COLUMN = "occurrences"


def multiplicity_name(df: DataFrame, base: str = COUNT_COLUMN) -> str:
    """A2: ``occurrences``, or ``occurrences_2``, ``_3``... when taken."""
    return free_name(df.columns, base)


def consolidate(df: DataFrame, count_column: str | None = None) -> DataFrame:
    """A1: one row per distinct input row, multiplicity (bigint) appended last."""
    if not df.columns:
        raise ValueError("the frame has no columns")
    name = count_column or multiplicity_name(df)
    if count_column is not None and name.casefold() in {c.casefold() for c in df.columns}:
        raise ValueError(f"count column {name!r} collides with an input column")
    return df.groupBy(*cols(df.columns)).agg(F.count(F.lit(1)).alias(name))


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    """A3 as a one-row frame (partial counts per task, one tiny final merge)."""
    return df.agg(F.count(F.lit(1)).alias(name))
