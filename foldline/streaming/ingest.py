"""T3-T6 for sources that grow by new files: Structured Streaming.

``readStream`` picks up each new file once (the checkpoint records which).
Two ways to keep the consolidated result:

``output="complete"`` (default): the consolidation is a streaming aggregate
(partial aggregate per micro-batch, then a shuffle into the state store, one
row of state per distinct row; RocksDB keeps it off the JVM heap), and
``foreachBatch`` replaces the table with the complete multiset after every
batch. The table always holds the finished result; each trigger rewrites it.

``output="ledger"``: no state store. Each micro-batch folds only its own rows
and writes them into its own ``query_id``/``batch_id`` partition of the table (dynamic
partition overwrite, so a retried batch replaces its earlier attempt). A
trigger costs O(batch) however large the result has grown; readers fold the
ledger with ``read_ingested`` (one more partial aggregate). Older batches are
folded into segments, so their number stays bounded (``ledger``).

The checkpoint location is required: with it a restart, also in a new process with an
empty catalog, resumes where the last batch ended and finds the stored table again.
"""

from __future__ import annotations

import threading
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.names import check_unique, col, cols, positive_int
from ..plans.transform import transform_frame
from ..session import session_conf
from ..sinks.tables import save_table
from ..sinks.versions import stored_paths
from ..sources.catalog import read_table
from ..sources.files import checked_format
from .ledger import BATCH_COLUMN, QUERY_COLUMN, compact_ledger, is_ledger, read_ledger

COMPACT_EVERY = 16
OUTPUTS = ("complete", "ledger")
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def start_ingest(
    spark: SparkSession,
    input_dir: str,
    schema: T.StructType | str,
    database: str,
    table: str,
    checkpoint_location: str,
    *,
    file_format: str = "csv",
    read_options: Mapping | None = None,
    column_names: Sequence[str] | None = None,
    filter_column: str | None = None,
    filter_value=None,
    warehouse_dir: str | None = None,
    poll_interval: float = 2.0,
    available_now: bool = False,
    max_files_per_trigger: int | None = None,
    rocksdb_state: bool = True,
    output: str = "complete",
    state_partitions: int | None = None,
    compact_every: int = COMPACT_EVERY,
) -> StreamingQuery:
    """Keep ``database.table`` equal to the consolidation of all files so far.

    ``poll_interval`` (T4) becomes a processing-time trigger; ``available_now``
    processes what is there and stops. Progress (T5) lives in ``checkpoint_location``;
    restarting with the same location resumes. A ledger that another checkpoint wrote is
    refused, since both would count the same files.

    ``state_partitions`` (complete output, by default ``spark.sql.shuffle.partitions``) is
    the number of state-store partitions, fixed for the life of the checkpoint. It and the
    state-store provider apply to this query only: the stream copies the session's settings
    when it starts, and the caller's values are restored.

    ``compact_every`` (ledger output) is the number of batches, and of segments of one size class,
    that are folded into one; at least 2.
    """
    if positive_int(compact_every, "compact_every") < 2:
        raise ValueError("compact_every must be at least 2")
    if not checkpoint_location:
        raise ValueError("a checkpoint location is required")
    if not isinstance(poll_interval, (int, float)) or poll_interval <= 0:
        raise ValueError("poll_interval must be greater than zero")
    if output not in OUTPUTS:
        raise ValueError(f"output must be one of {OUTPUTS}")
    fmt = checked_format(file_format)
    options = dict(read_options or {})
    if fmt == "csv":
        options.setdefault("header", True)
    if max_files_per_trigger is not None:
        options["maxFilesPerTrigger"] = int(max_files_per_trigger)
    stream = spark.readStream.format(fmt).schema(schema).options(**options).load(input_dir)

    query_conf: dict[str, str] = {}
    if output == "complete":
        if rocksdb_state:
            query_conf["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB_PROVIDER
        if state_partitions is not None:
            query_conf["spark.sql.shuffle.partitions"] = str(positive_int(state_partitions, "state_partitions"))
        result = transform_frame(stream, column_names, filter_column, filter_value, True)

        def write_batch(batch: DataFrame, batch_id: int) -> None:
            save_table(batch, database, table, warehouse_dir=warehouse_dir, mode="overwrite")

        output_mode = "complete"
    else:
        result = transform_frame(stream, column_names, filter_column, filter_value, False)

        def write_batch(batch: DataFrame, batch_id: int) -> None:
            folded = transform_frame(batch, count_duplicates=True)
            check_unique([*folded.columns, QUERY_COLUMN, BATCH_COLUMN])
            query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
            _refuse_foreign_ledger(batch.sparkSession, database, table, warehouse_dir, query_id)
            folded = folded.withColumns({
                QUERY_COLUMN: F.lit(query_id), BATCH_COLUMN: F.lit(batch_id).cast("bigint")})
            save_table(
                folded, database, table, warehouse_dir=warehouse_dir, mode="overwrite",
                partition_columns=[QUERY_COLUMN, BATCH_COLUMN],
            )
            # batches before this one are committed and never run again
            compact_ledger(batch.sparkSession, database, table, query_id, batch_id - 1, compact_every)

        output_mode = "append"

    gate = threading.Lock()  # held while a batch writes; ``stop_ingest`` waits for it

    def gated(batch: DataFrame, batch_id: int) -> None:
        with gate:
            write_batch(batch, batch_id)

    writer = (
        result.writeStream.outputMode(output_mode)
        .foreachBatch(gated)
        .option("checkpointLocation", checkpoint_location)
        .queryName(f"ingest_{database}_{table}")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{float(poll_interval)} seconds")
    with session_conf(spark, query_conf):
        query = writer.start()
    query.write_gate = gate
    return query


def _refuse_foreign_ledger(
    spark: SparkSession, database: str, table: str, warehouse_dir: str | None, query_id: str
) -> None:
    warehouse = (warehouse_dir or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")
    for folder in stored_paths(spark, f"{warehouse}/{database}.db/{table}/{QUERY_COLUMN}=*"):
        if not folder.endswith(f"{QUERY_COLUMN}={query_id}"):
            raise ValueError(f"the ledger {database}.{table} belongs to another checkpoint: {folder}")


def stop_ingest(query: StreamingQuery | None, wait_timeout: float = 30.0) -> bool:
    """Let the batch that is being written finish, then stop; False when none is active.

    Work that the query began after that batch is repeated by the next start."""
    if query is None or not query.isActive:
        return False
    gate = getattr(query, "write_gate", None)
    if gate is not None and not gate.acquire(timeout=wait_timeout):
        raise TimeoutError(f"the current batch did not end within {wait_timeout} seconds")
    try:
        query.stop()
    finally:
        if gate is not None:
            gate.release()
    query.awaitTermination(wait_timeout)
    if query.isActive:
        raise TimeoutError(f"the ingest did not stop within {wait_timeout} seconds")
    return True


def read_ingested(spark: SparkSession, database: str, table: str) -> DataFrame:
    """The consolidated rows of an ingest table, for either output mode.

    A ledger (``query_id``/``batch_id`` partitions, and segments of older batches) is folded:
    occurrences of the same row are summed (a partial aggregate, no hot-key issue).
    """
    data = read_table(spark, database, table)
    return read_ledger(spark, database, table) if is_ledger(data) else data
