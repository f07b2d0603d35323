"""Which folder holds a table's rows: numbered pointers, moved by compare-and-swap.

``<base>/_current/`` holds one small file a commit, named by its number; the greatest number is the
pointer and the file's text names the folder below ``base``. A commit creates the file of the next
number, which succeeds for one writer only: on a local file system by a hard link, elsewhere by a
rename that refuses to replace (atomic on HDFS; a store without such a rename is no place for tables
that several processes write). Whoever loses finds another pointer and starts again from that.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

POINTERS = "_current"


class Pointer(NamedTuple):
    number: int
    folder: str


def file_system(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def qualified(spark: SparkSession, path: str) -> str:
    fs, hpath = file_system(spark, path)
    return fs.makeQualified(hpath).toString().rstrip("/")


def stored_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Files and folders that match a path pattern."""
    fs, hpath = file_system(spark, pattern)
    return [status.getPath().toString() for status in fs.globStatus(hpath) or []]


def delete(spark: SparkSession, path: str) -> None:
    fs, hpath = file_system(spark, path)
    fs.delete(hpath, True)


def _numbers(spark: SparkSession, base: str) -> list[int]:
    names = (path.rpartition("/")[2] for path in stored_paths(spark, f"{base}/{POINTERS}/*"))
    return sorted(int(name) for name in names if name.isdecimal())


def _file(base: str, number: int) -> str:
    return f"{base}/{POINTERS}/{number:020d}"


def _folder(spark: SparkSession, base: str, number: int) -> str | None:
    """The folder a pointer names; None if it has gone."""
    fs, hpath = file_system(spark, _file(base, number))
    try:
        stream = fs.open(hpath)
    except Py4JJavaError as error:
        if "FileNotFoundException" in error.java_exception.getClass().getName():
            return None
        raise
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()


def current(spark: SparkSession, base: str) -> Pointer | None:
    """The pointer, or None if the folder has no versions."""
    while numbers := _numbers(spark, base):
        folder = _folder(spark, base, numbers[-1])
        if folder is not None:  # else two commits have come since the listing
            return Pointer(numbers[-1], folder)
    return None


def advance(spark: SparkSession, base: str, seen: Pointer | None, folder: str) -> Pointer | None:
    """Point at ``folder`` if the pointer is still ``seen``; None if it has moved."""
    jvm = spark.sparkContext._jvm
    number = seen.number + 1 if seen else 1
    fs, target = file_system(spark, _file(base, number))
    _, staged = file_system(spark, f"{base}/{POINTERS}/.staged-{uuid.uuid4().hex}")
    out = fs.create(staged)
    out.write(bytearray(f"{folder}\n", "utf-8"))
    out.close()
    try:
        if fs.getUri().getScheme() == "file":
            java = jvm.java.nio.file
            java.Files.createLink(java.Path.of(target.toUri().getPath(), spark.sparkContext._gateway.new_array(jvm.String, 0)),
                                  java.Path.of(staged.toUri().getPath(), spark.sparkContext._gateway.new_array(jvm.String, 0)))
        else:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
            flags = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
            context.rename(staged, target, flags)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return None
        raise
    finally:
        fs.delete(staged, False)
    if _numbers(spark, base)[-1] != number:  # ``seen`` was so old that its successor had been removed
        fs.delete(target, False)
        return None
    return Pointer(number, folder)


def retire(spark: SparkSession, base: str, now: Pointer, before: Pointer | None) -> None:
    """Forget what came before ``before``: older pointers, and the folders that only they name. The
    folder before an overwrite stays, for readers that have just planned; folders no pointer has ever
    named belong to writers at work and are not touched."""
    kept = {now.folder, before.folder if before else now.folder}
    for number in _numbers(spark, base):
        if number >= now.number - 1:
            continue
        folder = _folder(spark, base, number)
        if folder is not None and folder not in kept:
            if len(kept) == 1:  # an append: the version before its folder still has readers
                continue
            delete(spark, f"{base}/{folder}")
        delete(spark, _file(base, number))


def named(spark: SparkSession, base: str, folder: str) -> bool:
    """Whether a pointer that is still kept names ``folder``."""
    return any(_folder(spark, base, number) == folder for number in _numbers(spark, base))


def forget(spark: SparkSession, base: str, number: int) -> None:
    """Remove pointers below ``number``."""
    for old in _numbers(spark, base):
        if old < number:
            delete(spark, _file(base, old))
