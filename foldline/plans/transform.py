"""Scan -> positional rename -> equality filter -> consolidation.

One lazy chain; nothing runs until the caller acts on the result, and Catalyst
pushes the filter into the scan and fuses rename/filter into the partial
aggregate's code-generated stage.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.columns import filter_equals, rename_columns
from ..operators.consolidate import consolidate
from ..sources.files import read_source


def transform_frame(
    df: DataFrame,
    column_names: Sequence[str] | None = None,
    filter_column: str | None = None,
    filter_value=None,
    count_duplicates: bool = True,
) -> DataFrame:
    """The frame-to-frame part of W1 (also used on streaming frames)."""
    if column_names is not None:
        df = rename_columns(df, column_names)
    if filter_column is not None:
        df = filter_equals(df, filter_column, filter_value)
    if count_duplicates:
        df = consolidate(df)
    return df


def transform(
    spark: SparkSession,
    input_path: str,
    file_format: str | None = None,
    read_options: Mapping | None = None,
    column_names: Sequence[str] | None = None,
    filter_column: str | None = None,
    filter_value=None,
    count_duplicates: bool = True,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """W1 on a CSV/JSON source; ``count_duplicates=False`` keeps rows as they are."""
    data = read_source(spark, input_path, file_format, read_options, schema)
    return transform_frame(data, column_names, filter_column, filter_value, count_duplicates)
