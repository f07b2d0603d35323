"""K2-K7: schema-guarded external Parquet tables in the session catalog.

A table lives below ``<warehouse>/<database>.db/<table>``. Every overwrite writes a new version
folder there; only when it is complete does the table's pointer (``versions``) move to it, by
compare-and-swap, and the catalog entry follow. Readers and interrupted jobs see the old or the new
table, never an empty one, and the version before stays until the next overwrite. The pointer, not a
session's catalog, says which folder is current: reads, guards and writes bring the catalog entry up
to it first, so processes with catalogs of their own can write one table in turn or at once. An
append is staged, moved into the current folder, and then moves the pointer on, to the same folder;
if an overwrite came in between, the rows are appended again, to the new folder. Partitioned tables write
into the table's own folder. The guards use metadata only and run before anything is written.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.names import check_unique, quote
from ..session import session_conf
from . import versions
from .versions import Pointer, file_system, qualified, stored_paths

WRITE_MODES = ("append", "overwrite")
# The flat types a table accepts.
FLAT_TYPES = (
    T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType, T.BooleanType,
    T.StringType, T.CharType, T.VarcharType, T.BinaryType, T.DateType, T.TimestampType, T.TimestampNTZType,
)


class TableLoadError(RuntimeError):
    """A table guard failed; nothing was written."""


class TableConflict(TableLoadError):
    """The table is no longer at the version that the caller expected; nothing was written."""


def table_name(*names: str) -> str:
    """The quoted name of a database, or of a table in it. Both are plain identifiers, since they
    also name folders of the warehouse."""
    wrong = [n for n in names if not (isinstance(n, str) and n.isascii() and n.isidentifier())]
    if wrong:
        raise ValueError(f"not plain identifiers: {wrong}")
    return ".".join(quote(n) for n in names)


def column_type(data_type: T.DataType, ntz_as_timestamp: bool = False) -> str:
    """K6: the table type for a column, or TableLoadError for nested and other types."""
    if ntz_as_timestamp and data_type == T.TimestampNTZType():
        data_type = T.TimestampType()
    plain = isinstance(data_type, FLAT_TYPES) and (type(data_type) is not T.StringType or data_type == T.StringType())
    if not plain:
        raise TableLoadError(f"a table cannot hold columns of type {data_type.simpleString()}")
    return data_type.simpleString()


def _checked_schema(schema: T.StructType) -> list[str]:
    """The column names of a frame that may become a table."""
    names = schema.fieldNames()
    if not names:
        raise ValueError("the frame has no columns")
    check_unique(names)
    unprintable = [n for n in names if not n.strip() or not set(n).isdisjoint("\r\n\0")]
    if unprintable:
        raise ValueError(f"columns a table cannot have: {unprintable}")
    return names


def table_location(spark: SparkSession, database: str, table: str) -> str | None:
    """M4: the registered location of a table (None when it has none), from its catalog entry."""
    entry = spark.sql(f"DESCRIBE TABLE EXTENDED {table_name(database, table)} AS JSON").first()[0]
    return (json.loads(entry).get("location") or "").rstrip("/") or None


def _folder(warehouse_dir: str, database: str, table: str) -> str:
    table_name(database, table)
    return f"{warehouse_dir.rstrip('/')}/{database}.db/{table}"


def register_table(spark: SparkSession, database: str, table: str, warehouse_dir: str) -> bool:
    """Make the table stored below ``warehouse_dir`` known to this session's catalog: its current
    version, or its folder with all partitions. False if nothing is stored there."""
    base = _folder(warehouse_dir, database, table)
    now = versions.current(spark, base)
    names = [path.rpartition("/")[2] for path in stored_paths(spark, f"{base}/*")]
    if now is None and all(name.startswith(("v-", "_", ".")) for name in names):
        return False  # nothing, or versions that no pointer has named
    _create_database(spark, database, warehouse_dir)
    if not spark.catalog.tableExists(f"{database}.{table}"):
        place = f"{base}/{now.folder}" if now else base
        spark.sql(f"CREATE TABLE {table_name(database, table)} USING PARQUET LOCATION '{_sql_text(place)}'")
        _recover_partitions(spark, database, table)
    return True


def follow_pointer(spark: SparkSession, database: str, table: str) -> Pointer | None:
    """Bring the catalog entry of a registered table to the table's current version, which another
    process may have moved; the pointer, or None for a table without versions."""
    place, now = table_location(spark, database, table), None
    for base in (place, place.rpartition("/")[0]) if place else ():  # without versions so far, or a version
        now = versions.current(spark, base)
        if now is not None:
            break
    if now is not None and place != f"{base}/{now.folder}":
        spark.sql(f"ALTER TABLE {table_name(database, table)} SET LOCATION '{_sql_text(f'{base}/{now.folder}')}'")
    spark.catalog.refreshTable(table_name(database, table))
    return now


def table_version(spark: SparkSession, database: str, table: str) -> int:
    """The number of the table's current version, for ``save_table(expected_version=...)``; every
    overwrite and append raises it. 0 for a table that is not registered or has no versions."""
    if not spark.catalog.tableExists(f"{database}.{table}"):
        return 0
    now = follow_pointer(spark, database, table)
    return now.number if now else 0


def _recover_partitions(spark: SparkSession, database: str, table: str) -> None:
    if any(c.isPartition for c in spark.catalog.listColumns(f"{database}.{table}")):
        spark.sql(f"MSCK REPAIR TABLE {table_name(database, table)}")


def _create_database(spark: SparkSession, database: str, warehouse_dir: str) -> None:
    location = _sql_text(f"{warehouse_dir.rstrip('/')}/{database}.db")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote(database)} LOCATION '{location}'")


def table_schema(spark: SparkSession, database: str, table: str) -> tuple:
    """Ordered (case-folded name, type) pairs of a registered table."""
    schema = spark.table(table_name(database, table)).schema
    return tuple((f.name.casefold(), f.dataType.simpleString().lower()) for f in schema.fields)


def save_table(
    df: DataFrame,
    database: str,
    table: str,
    *,
    warehouse_dir: str | None = None,
    mode: str = "overwrite",
    ntz_as_timestamp: bool = False,
    partition_columns: Sequence[str] = (),
    expected_version: int | None = None,
) -> str:
    """K2/K3 after K4-K7: store ``df`` in ``database.table`` and return the table's folder.

    Database and table are created when absent (K7). An existing table must have the same ordered
    column names (case-insensitive) and types (K4) and be stored below the expected folder (K5);
    otherwise TableLoadError is raised and no data is written.

    Of overwrites at the same time the last to commit stays; no append to the version that stays is
    lost. With ``expected_version`` (``table_version``, as of when the caller read the table) an
    overwrite raises TableConflict instead if anything was committed since.

    With ``partition_columns`` (the frame's last columns) an overwrite replaces only the partitions
    present in ``df``; Spark stages them and moves them in when the job commits.
    """
    if mode not in WRITE_MODES:
        raise ValueError("mode must be 'append' or 'overwrite'")
    if expected_version is not None and (mode != "overwrite" or partition_columns):
        raise ValueError("expected_version is for overwrites of a whole table")
    table_name(database, table)
    names = _checked_schema(df.schema)
    parts = list(partition_columns)
    if parts and names[-len(parts):] != parts:
        raise ValueError("the partition columns must be the frame's last columns")
    columns = {f.name: column_type(f.dataType, ntz_as_timestamp) for f in df.schema.fields}
    df = df.select(*[df[quote(name)].cast(kind).alias(name) for name, kind in columns.items()])

    spark = df.sparkSession
    warehouse = (warehouse_dir or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")
    base = _folder(warehouse, database, table)
    _sql_text(base)
    if parts:
        return _save_partitions(df, database, table, warehouse, columns, parts, mode)
    known, seen = _guarded(spark, database, table, warehouse, columns)
    if mode == "append" and known:
        return _append(df, database, table, warehouse, columns)
    _expect(seen, expected_version, database, table)
    prepared = _prepared(df, database, table, warehouse, columns)
    if not _commit(spark, prepared, seen, expected_version, again=mode == "overwrite"):
        return _append(df, database, table, warehouse, columns)  # another process has created it meanwhile
    return base


def prepare_table(
    df: DataFrame, database: str, table: str, *, warehouse_dir: str | None = None, ntz_as_timestamp: bool = False
) -> dict:
    """The first half of an overwrite: guards, then the rows in a folder that no reader sees yet. What
    comes back is plain data for ``commit_table``, in this process or a later one."""
    table_name(database, table)
    _checked_schema(df.schema)
    columns = {f.name: column_type(f.dataType, ntz_as_timestamp) for f in df.schema.fields}
    df = df.select(*[df[quote(name)].cast(kind).alias(name) for name, kind in columns.items()])
    warehouse = (warehouse_dir or df.sparkSession.conf.get("spark.sql.warehouse.dir")).rstrip("/")
    _sql_text(_folder(warehouse, database, table))
    _guarded(df.sparkSession, database, table, warehouse, columns)
    return _prepared(df, database, table, warehouse, columns)


def commit_table(spark: SparkSession, prepared: dict) -> str:
    """The second half: the prepared folder becomes the table. Doing it again changes nothing."""
    names = (prepared["database"], prepared["table"], prepared["warehouse"])
    base = _folder(prepared["warehouse"], *names[:2])
    if not stored_paths(spark, f"{base}/{prepared['folder']}") or versions.named(spark, base, prepared["folder"]):
        register_table(spark, *names)  # committed before, and perhaps replaced since
    else:
        _, seen = _guarded(spark, *names, prepared["columns"])
        _commit(spark, prepared, seen, None, again=True)
    return base


def prepared_rows(spark: SparkSession, prepared: dict) -> DataFrame:
    base = _folder(prepared["warehouse"], prepared["database"], prepared["table"])
    return spark.read.schema(_columns_sql(prepared["columns"])).parquet(f"{base}/{prepared['folder']}")


def _prepared(df: DataFrame, database: str, table: str, warehouse: str, columns: dict[str, str]) -> dict:
    spark, folder = df.sparkSession, f"v-{uuid.uuid4().hex}"
    place = f"{_folder(warehouse, database, table)}/{folder}"
    try:
        df.write.parquet(place)
    except BaseException:
        versions.delete(spark, place)
        raise
    return {"database": database, "table": table, "warehouse": warehouse, "columns": columns, "folder": folder}


def _commit(spark: SparkSession, prepared: dict, seen: Pointer | None, expected: int | None, again: bool) -> bool:
    """Move the pointer to the prepared folder. If it has moved since ``seen``: once more from there
    (``again``), or give up, with the folder deleted."""
    names = (prepared["database"], prepared["table"], prepared["warehouse"])
    columns, folder = prepared["columns"], prepared["folder"]
    base = _folder(prepared["warehouse"], *names[:2])
    now = versions.advance(spark, base, seen, folder)
    while now is None:
        try:
            _, seen = _guarded(spark, *names, columns)
            _expect(seen, expected, *names[:2])
        except TableLoadError:
            versions.delete(spark, f"{base}/{folder}")
            raise
        if not again:
            versions.delete(spark, f"{base}/{folder}")
            return False
        now = versions.advance(spark, base, seen, folder)
    _publish(spark, *names, columns)
    versions.retire(spark, base, now, seen)
    return True


def _expect(seen: Pointer | None, expected: int | None, database: str, table: str) -> None:
    number = seen.number if seen else 0
    if expected is not None and number != expected:
        raise TableConflict(f"nothing was written to {database}.{table}: it is at version {number}, not {expected}")


def _append(df: DataFrame, database: str, table: str, warehouse: str, columns: dict[str, str]) -> str:
    """K3: add rows to the current folder; again, to the new one, if an overwrite came in between."""
    spark, base = df.sparkSession, _folder(warehouse, database, table)
    while True:
        _, seen = _guarded(spark, database, table, warehouse, columns)
        if seen is None:  # a table whose rows lie in its own folder, without versions
            df.write.insertInto(table_name(database, table))
            return base
        stored = spark.table(table_name(database, table)).columns  # equal up to case
        staged = f"{base}/_stage-{uuid.uuid4().hex}"  # jobs at once must not share a folder to write in
        try:
            df.toDF(*stored).write.parquet(staged)
            moved = _moved(spark, staged, f"{base}/{seen.folder}")
        finally:
            versions.delete(spark, staged)
        if not moved:
            if versions.current(spark, base).folder == seen.folder:
                raise RuntimeError(f"could not move the rows to {base}/{seen.folder}")
            continue
        now, latest = None, seen
        while now is None and latest.folder == seen.folder:
            now = versions.advance(spark, base, latest, seen.folder)
            latest = now or versions.current(spark, base)
        if now is not None:
            spark.catalog.refreshTable(table_name(database, table))
            versions.retire(spark, base, now, None)
            return base


def _moved(spark: SparkSession, staged: str, folder: str) -> bool:
    """Move the part files of ``staged``, whose names are unique, into ``folder``; False if it has gone."""
    fs, target = file_system(spark, folder)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for part in stored_paths(spark, f"{staged}/part-*"):
        if not fs.exists(target) or not fs.rename(path(part), path(target, part.rpartition("/")[2])):
            return False
    return True


def _save_partitions(
    df: DataFrame, database: str, table: str, warehouse: str, columns: dict[str, str], parts: list[str], mode: str
) -> str:
    spark, base, name = df.sparkSession, _folder(warehouse, database, table), table_name(database, table)
    if spark.catalog.tableExists(f"{database}.{table}"):
        _guard(spark, database, table, columns, base)
    else:
        _create_database(spark, database, warehouse)
        fs, folder = file_system(spark, base)
        fs.mkdirs(folder)
        keys = ", ".join(quote(c) for c in parts)
        spark.sql(f"CREATE TABLE {name} ({_columns_sql(columns)}) USING PARQUET PARTITIONED BY ({keys}) LOCATION '{base}'")
        _recover_partitions(spark, database, table)  # those that another process stored
    with session_conf(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
        df.write.insertInto(name, overwrite=(mode == "overwrite"))
    return base


def _columns_sql(columns: dict[str, str]) -> str:
    return ", ".join(f"{quote(name)} {kind}" for name, kind in columns.items())


def _publish(spark: SparkSession, database: str, table: str, warehouse: str, columns: dict[str, str]) -> None:
    """The catalog entry of a table that has a pointer: made if absent (K7), moved if behind."""
    if not spark.catalog.tableExists(f"{database}.{table}"):
        base = _folder(warehouse, database, table)
        _create_database(spark, database, warehouse)
        spark.sql(f"CREATE TABLE {table_name(database, table)} ({_columns_sql(columns)}) USING PARQUET "
                  f"LOCATION '{base}/{versions.current(spark, base).folder}'")
    follow_pointer(spark, database, table)


def _guarded(
    spark: SparkSession, database: str, table: str, warehouse: str, columns: dict[str, str]
) -> tuple[bool, Pointer | None]:
    """Whether the table exists, and its pointer, after K4 and K5, with the catalog brought up to it."""
    if not spark.catalog.tableExists(f"{database}.{table}") and not register_table(spark, database, table, warehouse):
        return False, None
    base = _folder(warehouse, database, table)
    _guard(spark, database, table, columns, base)
    return True, versions.current(spark, base)


def _guard(spark: SparkSession, database: str, table: str, columns: dict[str, str], base: str) -> None:
    """K4 and K5: the place on the catalog entry, then the columns of the current version."""
    problems = []
    place = table_location(spark, database, table)
    where, expected = qualified(spark, place) if place else None, qualified(spark, base)
    if where is None or (where != expected and where.rpartition("/")[0] != expected):
        problems.append(f"it is stored at {place!r}, not below {base!r}")
    else:
        now = follow_pointer(spark, database, table)
        if now is None and where != expected:
            problems.append(f"{place!r} is no version of it")
    existing, incoming = table_schema(spark, database, table), tuple((n.casefold(), k) for n, k in columns.items())
    if existing != incoming:
        problems.append(f"its columns are {existing}, those of the frame {incoming}")
    if problems:
        raise TableLoadError(f"nothing was written to {database}.{table}: " + "; ".join(problems))


def _sql_text(value: str) -> str:
    if any(ch in value for ch in "'\\\r\n\x00"):
        raise ValueError(f"unsafe character in location {value!r}")
    return value
