"""CSV and JSON scans.

All reads are plain ``DataFrameReader`` scans, split by Spark into file
partitions and read in parallel. Giving ``schema`` skips the inference pass
(an extra full read of the input), which is what a large job should do.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.names import check_unique, quote

# The two supported formats and the accepted file-name pattern
# (a leading letter or digit, then letters, digits, dot, underscore or dash,
# ending in .csv or .json, case-insensitive).
SUPPORTED_FORMATS = ("csv", "json")
FILE_NAME_PATTERN = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*\.(?:csv|json)", re.IGNORECASE)


@dataclass(frozen=True)
class SourceName:
    """S3: what a location says about a source: its file name and the format of its content."""

    name: str
    format: str

    @classmethod
    def of(cls, location: str, file_format: str | None = None) -> "SourceName":
        """The decoded last segment of a URL or path; ``file_format`` overrides its ending."""
        segment = unquote(urlsplit(location).path.rstrip("/").rpartition("/")[2])
        if FILE_NAME_PATTERN.fullmatch(segment) is None:
            raise ValueError(f"not a CSV or JSON file name: {segment!r} in {location!r}")
        return cls(segment, checked_format(file_format or segment[segment.rindex("."):]))


def checked_format(file_format: str) -> str:
    """The format meant by ``csv``, ``.CSV``, ``json`` ..."""
    for known in SUPPORTED_FORMATS:
        if isinstance(file_format, str) and file_format.casefold() in (known, f".{known}"):
            return known
    raise ValueError(f"unknown file format {file_format!r}; use one of {SUPPORTED_FORMATS}")


def source_format(location: str, file_format: str | None = None) -> str:
    """The format alone: a given one needs no telling file name."""
    return checked_format(file_format) if file_format else SourceName.of(location).format


def read_source(
    spark: SparkSession,
    path: str,
    file_format: str | None = None,
    read_options: Mapping | None = None,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Read a CSV or JSON source.

    CSV defaults to ``header`` and ``inferSchema`` on; the caller's options win.
    JSON is read as JSON Lines unless the options say ``multiLine``.
    """
    fmt = source_format(path, file_format)
    options = {k: v for k, v in dict(read_options or {}).items()}
    if fmt == "csv":
        options.setdefault("header", True)
        if schema is None:
            options.setdefault("inferSchema", True)
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def _check_names(names: Sequence[str]) -> list[str]:
    if not names or isinstance(names, str):
        raise ValueError("column names must be a non-empty list of text")
    for name in names:
        if not isinstance(name, str) or not name.strip():
            raise ValueError("column names must be non-blank text")
    check_unique(names)
    return list(names)


def read_headerless_csv(
    spark: SparkSession,
    path: str,
    names: Sequence[str],
    types: Sequence[str] | None = None,
    read_options: Mapping | None = None,
) -> DataFrame:
    """A CSV file without header line, columns named by the caller.

    With ``types`` the schema is given as DDL and no inference pass runs;
    without, types are inferred and the names bound by position.
    """
    names = _check_names(names)
    options = dict(read_options or {})
    options["header"] = False
    reader = spark.read.format("csv").options(**options)
    if types is not None:
        if len(types) != len(names):
            raise ValueError("one type per column name is required")
        ddl = ", ".join(f"{quote(n)} {t}" for n, t in zip(names, types))
        return reader.schema(ddl).load(path)
    data = reader.option("inferSchema", True).load(path)
    if len(data.columns) != len(names):
        raise ValueError(
            f"the file has {len(data.columns)} columns but {len(names)} names were given"
        )
    return data.toDF(*names)


def require_nonempty(spark: SparkSession, path: str) -> None:
    """Fail when the source holds no data at all.

    Only the first line is looked at (``isEmpty`` is a ``limit(1)`` job), so
    the check costs one small task whatever the size of the input.
    """
    if spark.read.text(path).isEmpty():
        raise ValueError(f"the source holds no data: {path}")
