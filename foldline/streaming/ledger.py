"""The ledger of an ingest: folded rows by micro-batch, kept in a bounded number of pieces.

Every batch owns a partition (``query_id``, ``batch_id``) of the ledger's table. Once ``every`` batches
lie there, they are folded into one segment below ``<table>/_ledger``; ``every`` segments of one level
are folded into one of the next, so n batches leave fewer than ``every`` segments a level, about
log(n) levels, and each row is rewritten once a level. What is valid says a manifest, the text of a
pointer moved by compare-and-swap (``sinks.versions``): segments, and the last batch they hold.
Readers take the segments and the partitions of later batches, so at no time is a row read twice or
missed, wherever a compaction stops. Only batches whose successor is running are folded: the last
batch may still be retried, and then replaces its own partition. What a compaction replaces stays
until the next one, for readers that have just planned.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import col, cols
from ..sinks import versions
from ..sinks.tables import table_location, table_name
from ..sources.catalog import read_table

QUERY_COLUMN, BATCH_COLUMN = "query_id", "batch_id"
SEGMENTS = "_ledger"


def _manifest(spark: SparkSession, base: str) -> tuple[versions.Pointer | None, dict]:
    at = versions.current(spark, f"{base}/{SEGMENTS}")
    return at, json.loads(at.folder) if at else {"last": -1, "segments": []}


def _segment_rows(spark: SparkSession, base: str, folders: list[str], like: DataFrame) -> DataFrame:
    paths = [f"{base}/{SEGMENTS}/{name}" for name in folders]
    return spark.read.schema(like.schema).parquet(*paths)


def _folded(rows: DataFrame) -> DataFrame:
    """Occurrences of the same row summed; the last column is the multiplicity."""
    *keys, count = rows.columns
    return rows.groupBy(*cols(keys)).agg(F.sum(col(count)).alias(count))


def is_ledger(table: DataFrame) -> bool:
    return table.columns[-2:] == [QUERY_COLUMN, BATCH_COLUMN]


def read_ledger(spark: SparkSession, database: str, table: str) -> DataFrame:
    """The consolidated rows: segments and the batches after them, summed by row."""
    data, base = read_table(spark, database, table), table_location(spark, database, table)
    _, manifest = _manifest(spark, base)
    rows = data.where(F.col(BATCH_COLUMN) > manifest["last"]).drop(QUERY_COLUMN, BATCH_COLUMN)
    if manifest["segments"]:
        rows = rows.union(_segment_rows(spark, base, [s["folder"] for s in manifest["segments"]], rows))
    return _folded(rows)


def _stored_batches(spark: SparkSession, base: str, query_id: str) -> dict[int, str]:
    found = versions.stored_paths(spark, f"{base}/{QUERY_COLUMN}={query_id}/{BATCH_COLUMN}=*")
    return {int(path.rpartition("=")[2]): path for path in found}


def compact_ledger(spark: SparkSession, database: str, table: str, query_id: str, upto: int, every: int) -> bool:
    """Fold batches up to number ``upto`` (all committed by the stream) if there are ``every`` of
    them; True if a new manifest holds."""
    base = table_location(spark, database, table)
    at, manifest = _manifest(spark, base)
    stored = _stored_batches(spark, base, query_id)
    batches = [n for n in stored if manifest["last"] < n <= upto]
    if len(batches) < every:
        return False
    kept, level = list(manifest["segments"]), 1
    merged: list[str] = []
    while len(kept) >= every - 1 and all(s["level"] == level for s in kept[1 - every:]):
        merged += [s["folder"] for s in kept[1 - every:]]
        del kept[1 - every:]
        level += 1
    data = read_table(spark, database, table)
    own = F.col(BATCH_COLUMN).between(manifest["last"] + 1, upto) & (F.col(QUERY_COLUMN) == query_id)
    rows = data.where(own).drop(QUERY_COLUMN, BATCH_COLUMN)
    if merged:
        rows = rows.union(_segment_rows(spark, base, merged, rows))
    folder = f"s-{uuid.uuid4().hex}"
    _folded(rows).write.parquet(f"{base}/{SEGMENTS}/{folder}")
    segments = [*kept, {"level": level, "folder": folder}]
    now = versions.advance(spark, f"{base}/{SEGMENTS}", at, json.dumps({"last": upto, "segments": segments}))
    if now is None:  # another driver still runs this stream; its manifest holds
        versions.delete(spark, f"{base}/{SEGMENTS}/{folder}")
        return False
    _clear(spark, database, table, base, query_id, manifest, segments, now.number)
    return True


def _clear(spark, database, table, base, query_id, before: dict, segments: list[dict], number: int) -> None:
    """Remove what the manifest before did not need any more either."""
    needed = {s["folder"] for s in [*before["segments"], *segments]}
    for path in versions.stored_paths(spark, f"{base}/{SEGMENTS}/s-*"):
        if path.rpartition("/")[2] not in needed:
            versions.delete(spark, path)
    for batch, path in _stored_batches(spark, base, query_id).items():
        if batch <= before["last"]:
            spark.sql(f"ALTER TABLE {table_name(database, table)} DROP IF EXISTS PARTITION "
                      f"({QUERY_COLUMN} = '{query_id}', {BATCH_COLUMN} = {batch})")
            versions.delete(spark, path)
    versions.forget(spark, f"{base}/{SEGMENTS}", number - 1)
