"""K1: publish a result under a fixed name, replacing the previous version.

The data is written by all tasks in parallel into a hidden staging folder next to the target. Only a
complete staging folder is moved into place, with two renames: a failure before them leaves the old
version, a failure between them is undone. A reader that comes between the two renames finds no
folder; on an object store, where a rename copies, that gap lasts as long as the copy. Readers that
must never see it use a table (``sinks.tables``), whose overwrites switch in one step. The published
name (``transformed_<source>``) is a folder of part files that ``spark.read`` reads as one dataset.

With ``single_file`` it is one file instead. The parts are still written in parallel; then they are
joined without passing through one task: HDFS joins files by their blocks (``concat``), and on a shared
``file:`` system tasks copy parts to their known offsets. One rename replaces the old file, so readers
see the old or the new one. Other file systems have no way to join files and are refused.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import SourceName

# Fixed value: published outputs are named after their source with this prefix.
OUTPUT_PREFIX = "transformed_"


def output_name(source: str) -> str:
    """``transformed_<file name of the source>``."""
    return OUTPUT_PREFIX + SourceName.of(source).name


def file_system(spark, path: str):
    """(Hadoop FileSystem, Path, JVM view) for ``path``."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, hpath, jvm


def swap_in(spark, staged: str, final: str) -> None:
    """Move the folder ``staged`` to ``final``, replacing what was there.

    The old folder is first renamed aside and deleted only after the new one
    is in place, so a failure leaves either version complete.
    """
    fs, staged_path, jvm = file_system(spark, staged)
    Path = jvm.org.apache.hadoop.fs.Path
    final_path = Path(final)
    retired_path = Path(f"{final.rstrip('/')}._old-{uuid.uuid4().hex}")
    had_old = fs.exists(final_path)
    if had_old and not fs.rename(final_path, retired_path):
        raise RuntimeError(f"could not move the previous output aside: {final}")
    if not fs.rename(staged_path, final_path):
        if had_old:
            fs.rename(retired_path, final_path)
        raise RuntimeError(f"could not publish {final}")
    if had_old:
        fs.delete(retired_path, True)


def publish_file(
    df: DataFrame,
    source: str,
    output_dir: str,
    file_format: str | None = None,
    write_options: Mapping | None = None,
    single_file: bool = False,
) -> str:
    """Write ``df`` as CSV or JSON to ``<output_dir>/transformed_<name>``, a folder of part files
    written in parallel or, with ``single_file``, one file joined from them; returns its path.

    The format follows the output name unless given; a given format does not change the name. CSV
    gets a header unless the options say otherwise. A single file is not compressed, and an empty
    frame gives one with a header alone, or an empty one.
    """
    staged = stage_file(df, source, output_dir, file_format, write_options, single_file)
    return publish_staged(df.sparkSession, staged)


def stage_file(
    df: DataFrame,
    source: str,
    output_dir: str,
    file_format: str | None = None,
    write_options: Mapping | None = None,
    single_file: bool = False,
) -> dict:
    """The first half of ``publish_file``: everything is written, next to the target. What comes back is
    plain data for ``publish_staged``, in this process or a later one."""
    target = SourceName.of(output_name(source), file_format)
    options = dict(write_options or {})
    options.setdefault(*(("header", True) if target.format == "csv" else ("ignoreNullFields", False)))
    out = output_dir.rstrip("/")
    folder = f"{out}/._stage-{uuid.uuid4().hex}"
    fs, folder_path, _ = file_system(df.sparkSession, folder)
    ready = folder
    try:
        if single_file:
            folded = {k.casefold(): v for k, v in options.items()}
            if str(folded.get("compression", "none")).casefold() not in ("none", "uncompressed"):
                raise ValueError("a single file is not compressed")
            headed = target.format == "csv" and str(folded.get("header")).casefold() == "true"
            plain = {k: v for k, v in options.items() if k.casefold() not in ("header", "compression")}
            bare = {"compression": "none"} | ({"header": False} if target.format == "csv" else {})
            df.write.format(target.format).options(**plain | bare).save(folder)
            if headed:  # a frame without rows gives the header line alone
                df.limit(0).coalesce(1).write.options(**plain | {"header": True, "compression": "none"}).csv(f"{folder}/_head")
            ready = _joined(df.sparkSession, folder)
        else:
            df.write.format(target.format).options(**options).save(folder)
    except BaseException:
        fs.delete(folder_path, True)
        raise
    return {"folder": folder, "ready": ready, "final": f"{out}/{target.name}"}


def publish_staged(spark: SparkSession, staged: dict) -> str:
    """The second half: the staged file or folder replaces the published one. Doing it again changes
    nothing."""
    fs, ready, jvm = file_system(spark, staged["ready"])
    final, Path = staged["final"], jvm.org.apache.hadoop.fs.Path
    if fs.exists(ready):
        if fs.isDirectory(ready) or fs.isDirectory(Path(final)):
            swap_in(spark, staged["ready"], final)
        else:
            _replace(spark, staged["ready"], final)
    if fs.exists(Path(final)):
        fs.delete(Path(staged["folder"]), True)
        for old in fs.globStatus(Path(f"{final}._old-*")) or []:  # of a stop between two renames
            fs.delete(old.getPath(), True)
    return final


COPY_BYTES = 8 << 20


def _joined(spark: SparkSession, staged: str) -> str:
    """One file, below ``staged``, of its head and parts in order."""
    fs, _, jvm = file_system(spark, staged)
    Path = jvm.org.apache.hadoop.fs.Path
    pieces = []
    for pattern in (f"{staged}/_head/part-*", f"{staged}/part-*"):
        pieces += sorted((f.getPath().toString(), f.getLen()) for f in fs.globStatus(Path(pattern)) or [] if f.getLen())
    joined = f"{staged}/joined"
    if not pieces:
        fs.create(Path(joined)).close()
    elif fs.getUri().getScheme() == "file":
        _copy_to_offsets(spark, [(Path(p).toUri().getPath(), size) for p, size in pieces], Path(joined).toUri().getPath())
    else:
        first, *rest = [Path(p) for p, _ in pieces]
        fs.rename(first, Path(joined))
        if rest:
            others = spark.sparkContext._gateway.new_array(Path, len(rest))
            for i, piece in enumerate(rest):
                others[i] = piece
            fs.concat(Path(joined), others)
    return joined


def _copy_to_offsets(spark: SparkSession, pieces: list[tuple[str, int]], target: str) -> None:
    """Every task copies its pieces into ``target``, each at its place."""
    rows, at = [], 0
    for path, size in pieces:
        rows += [(path, start, min(COPY_BYTES, size - start), at + start) for start in range(0, size, COPY_BYTES)]
        at += size
    with open(target, "wb") as out:
        out.truncate(at)
    copy_bytes = COPY_BYTES

    def copy(batches):
        for batch in batches:
            for path, start, length, place in zip(*(batch.column(i).to_pylist() for i in range(4))):
                with open(path, "rb") as source, open(target, "r+b") as out:
                    data = os.pread(source.fileno(), copy_bytes, start)[:length]
                    done = 0
                    while done < length:
                        done += os.pwrite(out.fileno(), data[done:], place + done)
                    os.fsync(out.fileno())
            yield pa.RecordBatch.from_arrays([pa.array([sum(batch.column(2).to_pylist())], pa.int64())], ["copied"])

    tasks = min(len(rows), 4 * spark.sparkContext.defaultParallelism)
    frame = spark.createDataFrame(rows, "path string, start long, length long, place long").repartition(tasks)
    copied = frame.mapInArrow(copy, "copied long").agg(F.sum("copied").alias("n")).first()["n"]
    if copied != at:
        raise RuntimeError(f"{copied} of {at} bytes were joined")


def _replace(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file over another in one step."""
    fs, source_path, jvm = file_system(spark, source)
    target_path = jvm.org.apache.hadoop.fs.Path(target)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    flags = spark.sparkContext._gateway.new_array(rename, 1)
    flags[0] = rename.OVERWRITE
    context.rename(source_path, target_path, flags)
