"""Run W1 once, publish to a table and a file (or a file alone), print a preview.

The consolidation is evaluated once: the table is written first, if one is wanted, and the file and
the preview are derived from it; otherwise the preview is read from the published file.

Table and file are one commit. Both are written where no reader looks, then an intent record says
what is to be published, then both are published, then the record goes. A flow that dies before the
record leaves both as they were; one that dies after it is finished by the next flow into the same
output folder (or ``finish_flows``), since publishing again changes nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..functions.names import positive_int
from ..operators.columns import cell_text
from ..sinks.files import file_system, publish_file, publish_staged, stage_file, swap_in
from ..sinks.tables import commit_table, prepare_table, prepared_rows
from ..sources.catalog import read_table
from ..sources.files import (
    SourceName,
    read_headerless_csv,
    read_source,
    require_nonempty,
    source_format,
)
from .transform import transform


def print_rows(df: DataFrame, max_rows: int) -> int:
    """L3: print the row count and up to ``max_rows`` rows, untruncated.

    Printing every row would pull a whole table to the driver, so the number
    of printed rows is required.
    """
    n = positive_int(max_rows, "max_rows")
    total = df.count()
    print(f"Data ({total} rows):")
    df.show(n, truncate=False)
    return total


def land_source(
    spark: SparkSession,
    source: str,
    input_dir: str,
    column_names: Sequence[str] | None = None,
    file_format: str | None = None,
    read_options: Mapping | None = None,
) -> str:
    """Copy a CSV/JSON source into ``input_dir`` under its own file name.

    Any path Spark can read works as a source (the surveyed program downloaded
    over HTTPS instead, which is not built). Everything is staged, then moved into place, so a
    failed landing leaves the previous copy intact. An empty source is refused (S6).

    Every value is kept. JSON Lines are copied line by line, in parallel; JSON that the options
    call ``multiLine`` is copied file by file. CSV is parsed as text with the caller's options,
    blanks kept, and written with the same separator, quote and escape and a header in every part
    (with ``column_names``, those names over a headerless source), so reading with the same options
    gives the same values. A CSV row with another number of values than the header fails the landing.
    """
    target = SourceName.of(source, file_format)
    fmt = target.format
    if column_names is not None and fmt != "csv":
        raise ValueError("column names can only be given for CSV sources")
    require_nonempty(spark, source)
    out = input_dir.rstrip("/")
    final, staged = f"{out}/{target.name}", f"{out}/._landing-{uuid.uuid4().hex}"
    options = dict(read_options or {})
    folded = {k.casefold(): v for k, v in options.items()}
    fs, staged_path, _ = file_system(spark, staged)
    try:
        if fmt == "csv":
            options |= {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "mode": "FAILFAST"}
            if column_names is not None:
                data = read_headerless_csv(spark, source, column_names, ["string"] * len(column_names), options)
            else:
                data = spark.read.options(**(options | {"header": True, "inferSchema": False})).csv(source)
            dialect = {k: v for k, v in folded.items() if k in ("sep", "delimiter", "quote", "escape", "nullvalue", "emptyvalue", "encoding")}
            dialect |= {"header": True, "ignoreleadingwhitespace": False, "ignoretrailingwhitespace": False}
            data.write.options(**dialect).csv(staged)
        elif str(folded.get("multiline", False)).casefold() == "true":
            whole = spark.read.text(source, wholetext=True)
            whole.write.option("maxRecordsPerFile", 1).text(staged)
        else:
            spark.read.text(source, lineSep="\n").write.option("lineSep", "\n").text(staged)
        swap_in(spark, staged, final)
    finally:
        if fs.exists(staged_path):
            fs.delete(staged_path, True)
    return final


def print_file(spark: SparkSession, path: str, max_rows: int, read_options: Mapping | None = None) -> int:
    """Print a published CSV/JSON dataset as text cells (P6 + L3)."""
    options = dict(read_options or {})
    if source_format(path) == "csv":
        options["inferSchema"] = False
    data = read_source(spark, path, read_options=options)
    return print_rows(cell_text(data), max_rows)


@dataclass
class FlowResult:
    table_location: str | None
    file_path: str
    rows: int


def table_wanted(database: str | None, table: str | None) -> bool:
    """Both names ask for a table, none for a file alone; one without the other is an error."""
    if bool(database) != bool(table):
        raise ValueError("give database and table, or neither")
    return bool(database)


INTENT = "._intent-"


def _write_intent(spark: SparkSession, output_dir: str, what: dict) -> str:
    """The record, whole or not at all: written aside, then renamed."""
    name = uuid.uuid4().hex
    fs, staged, jvm = file_system(spark, f"{output_dir.rstrip('/')}/._writing-{name}")
    out = fs.create(staged)
    out.write(bytearray(json.dumps(what), "utf-8"))
    out.close()
    intent = f"{output_dir.rstrip('/')}/{INTENT}{name}"
    if not fs.rename(staged, jvm.org.apache.hadoop.fs.Path(intent)):
        raise RuntimeError(f"could not write {intent}")
    return intent


def _publish_both(spark: SparkSession, intent: str, prepared: dict, staged: dict) -> tuple[str, str]:
    location = commit_table(spark, prepared)
    path = publish_staged(spark, staged)
    fs, record, _ = file_system(spark, intent)
    fs.delete(record, False)
    return location, path


def finish_flows(spark: SparkSession, output_dir: str) -> int:
    """Publish what flows into ``output_dir`` had announced when they died; the number of them."""
    fs, pattern, jvm = file_system(spark, f"{output_dir.rstrip('/')}/{INTENT}*")
    found = sorted((f.getModificationTime(), f.getPath().toString()) for f in fs.globStatus(pattern) or [])
    for _, intent in found:
        stream = fs.open(jvm.org.apache.hadoop.fs.Path(intent))
        try:
            what = json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        _publish_both(spark, intent, what["table"], what["file"])
    return len(found)


def flow(
    spark: SparkSession,
    input_path: str,
    source: str,
    output_dir: str,
    database: str | None = None,
    table: str | None = None,
    *,
    warehouse_dir: str | None = None,
    file_format: str | None = None,
    read_options: Mapping | None = None,
    write_options: Mapping | None = None,
    column_names: Sequence[str] | None = None,
    filter_column: str | None = None,
    filter_value=None,
    schema=None,
    preview_rows: int | None = 20,
    single_file: bool = False,
) -> FlowResult:
    """Transform -> table (K2), if named -> file (K1) -> preview.

    ``preview_rows=None`` skips the preview (the row count is then not taken, -1). ``single_file``
    publishes one file instead of a folder of parts.
    """
    with_table = table_wanted(database, table)
    finish_flows(spark, output_dir)
    result = transform(
        spark,
        input_path,
        file_format=file_format,
        read_options=read_options,
        column_names=column_names,
        filter_column=filter_column,
        filter_value=filter_value,
        schema=schema,
    )
    location, kind = None, result.schema
    if with_table:
        prepared = prepare_table(result, database, table, warehouse_dir=warehouse_dir)
        rows = prepared_rows(spark, prepared)
        staged = stage_file(rows, source, output_dir, file_format, write_options, single_file)
        intent = _write_intent(spark, output_dir, {"table": prepared, "file": staged})
        location, path = _publish_both(spark, intent, prepared, staged)
        result = read_table(spark, database, table)
    else:
        path = publish_file(result, source, output_dir, file_format, write_options, single_file)
    if preview_rows is None:
        return FlowResult(location, path, -1)
    shown = result if with_table else read_source(spark, path, file_format, write_options, kind)
    return FlowResult(location, path, print_rows(shown, preview_rows))
