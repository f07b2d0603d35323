"""Helpers shared by the training-data operators: tables, scratch folders, word hashing.

Words are the maximal runs of bytes outside ``[\\x20\\x09-\\x0D]``; since these are
ASCII bytes, cutting UTF-8 bytes and cutting characters give the same words.
"""

from __future__ import annotations

import os
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_root

WORD = r"[^\x20\x09-\x0D]+"
JOINS_KEPT_PARTS = "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning"
CHUNK_BYTES = 1 << 15  # so that the arrays of a chunk stay in the cache


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared checkpoint folder, removed when the application ends."""
    path = f"{checkpoint_root(spark).rstrip('/')}/llm-{purpose}-{uuid.uuid4().hex}"
    _hadoop(spark, path, lambda fs, p: fs.deleteOnExit(p))
    return path


def discard(*frames: DataFrame) -> None:
    """Delete the folders of frames that ``materialize`` wrote, and release those that ``keep`` kept, when
    nothing reads them any more."""
    for frame in frames:
        if frame.is_cached:
            frame.unpersist()
        path = getattr(frame, "_scratch_path", None)
        if path is not None:
            _hadoop(frame.sparkSession, path, lambda fs, p: fs.delete(p, True))


def _hadoop(spark: SparkSession, path: str, action):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return action(p.getFileSystem(spark._jsc.hadoopConfiguration()), p)


def materialize(df: DataFrame, purpose: str, parts: int | None = None) -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage, survives lost executors.

    ``parts``: shuffle the rows to so many files, instead of a file for each task that makes them."""
    path = scratch(df.sparkSession, purpose)
    df = df if parts is None else df.repartition(parts)
    df.write.parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found._scratch_path = path  # for ``discard``
    return found


def keep(df: DataFrame) -> DataFrame:
    """Compute once and keep on the executors' disks until ``discard``, for what is read a few times and
    released at once: the shuffles behind it stay as long. No file is made in the shared folder, which
    costs a process a file on a local file system. Parts lost with an executor are computed anew. Small
    shuffle partitions are joined to one part, as they are for written frames."""
    conf = df.sparkSession.conf
    before = conf.get(JOINS_KEPT_PARTS)
    conf.set(JOINS_KEPT_PARTS, "true")
    try:
        kept = df.persist(StorageLevel.DISK_ONLY)
    finally:
        conf.set(JOINS_KEPT_PARTS, before)
    kept.count()
    return kept


def write_shared(uri: str, data: bytes) -> None:
    """Write one file of a task's output below the shared folder (any file system pyarrow knows)."""
    with _open_shared(uri, "wb") as out:
        out.write(data)


def read_shared(uri: str, start: int, length: int) -> bytes:
    """At most ``length`` bytes of a shared file from ``start`` on."""
    with _open_shared(uri, "rb") as source:
        source.seek(start)
        return source.read(length)


def _open_shared(uri: str, mode: str):
    if uri.startswith(("file:", "/")):
        path = "/" + uri.removeprefix("file:").lstrip("/")
        if mode == "wb":
            os.makedirs(os.path.dirname(path), exist_ok=True)
        return open(path, mode)
    system, path = pa.fs.FileSystem.from_uri(uri)
    if mode == "wb":
        system.create_dir(path.rpartition("/")[0], recursive=True)
        return system.open_output_stream(path)
    return system.open_input_file(path)


# ------------------------------------------------------------------ word hashing

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SOLID_TABLE, _LOWER_TABLE = (~_SPACE).tobytes(), _LOWER.tobytes()  # for bytes.translate
_M64 = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser over uint64 arrays (multiply and xor-shift)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_CODE = mix64((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(_BASE))
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of each."""
    size = 1 << max(12, int(n).bit_length())
    if size not in _POWERS:
        inverse = pow(_BASE, -1, 1 << 64)
        with np.errstate(over="ignore"):
            pair = []
            for step in (_BASE, inverse):
                factors = np.full(size, step, np.uint64)
                factors[0] = 1
                pair.append(np.cumprod(factors, dtype=np.uint64))
        _POWERS.clear()
        _POWERS[size] = (pair[0], pair[1])
    return _POWERS[size]


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets (int64, one more than rows) and bytes of a string column; nulls are empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    start = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1]
    if len(start) == 0:
        start = np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return start, raw


def slices(column: pa.Array, max_bytes: int = 4 << 20):
    """(first row, rows) of consecutive parts of a string column of about max_bytes, so that work
    on a batch takes memory for a few megabytes of text, or for its longest text."""
    offsets, _ = text_buffers(column)
    at = 0
    while at < len(column):
        end = int(np.searchsorted(offsets, offsets[at] + max_bytes, side="right")) - 1
        end = min(len(column), max(at + 1, end))
        yield at, column.slice(at, end - at)
        at = end


class Words:
    """All words of a batch: hashes, byte spans and the document of each word."""

    __slots__ = ("hash", "start", "end", "first")

    def __init__(self, hashes, start, end, first):
        self.hash, self.start, self.end = hashes, start, end
        self.first = first  # index of each document's first word, plus the total

    def of(self, i: int) -> slice:
        return slice(self.first[i], self.first[i + 1])


def batch_words(column: pa.Array, lower: bool = True) -> Words:
    """Cut and hash the words of a string column, about CHUNK_BYTES at a time, so the
    temporary arrays stay small for any text length (chunks end at white space or at a document's
    end, or, for one word longer than a chunk, at that word's end)."""
    offsets, raw = text_buffers(column)
    begin, stop = int(offsets[0]), int(offsets[-1])
    hashes, starts, ends = [], [], []
    a = begin
    while a < stop:
        b = min(stop, a + CHUNK_BYTES)
        if b < stop:
            b = _cut(raw, offsets, a, b, stop)
        h, s, e = _chunk_words(raw[a:b], offsets, a, b, lower)
        hashes.append(h), starts.append(s), ends.append(e)
        a = b
    h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    s = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    e = np.concatenate(ends) if ends else np.zeros(0, np.int64)
    return Words(h, s, e, np.searchsorted(s, offsets))


def _cut(raw, offsets, a, b, stop):
    boundary = int(offsets[np.searchsorted(offsets, b, side="right") - 1])
    if boundary > a:
        return boundary
    space = np.flatnonzero(_SPACE[raw[a:b]])
    if len(space):
        return a + int(space[-1]) + 1
    after = int(offsets[np.searchsorted(offsets, a, side="right")])
    while b < after and not _SPACE[raw[b]]:
        b += 1
    return min(b, after, stop)


def _chunk_words(part, offsets, a, b, lower):
    data = part.tobytes()
    solid = np.frombuffer(data.translate(_SOLID_TABLE), bool)
    if lower:
        part = np.frombuffer(data.translate(_LOWER_TABLE), np.uint8)
    n = len(part)
    head = solid.copy()
    head[1:] &= ~solid[:-1]
    tail = solid.copy()
    tail[:-1] &= ~solid[1:]
    inside = offsets[np.searchsorted(offsets, a, "right"): np.searchsorted(offsets, b, "left")] - a
    head[inside] = solid[inside]
    tail[inside - 1] = solid[inside - 1]
    s, e = np.flatnonzero(head), np.flatnonzero(tail) + 1
    with np.errstate(over="ignore"):
        up, down = _powers(n + 1)
        sums = np.empty(n + 1, np.uint64)
        sums[0] = 0
        codes = _BYTE_CODE.take(part, mode="clip")
        codes *= up[:n]
        np.cumsum(codes, out=sums[1:])
        h = mix64((sums[e] - sums[s]) * down[s])
    return h, s + a, e + a


_SHINGLE_MULTIPLIERS = np.array([pow(0xD6E8FEB86659FD93, i + 1, 1 << 64) for i in range(5)], np.uint64)


def shingles(words: Words, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the word shingles of each document, in text order, with repeats.

    Returns (hashes, first): shingles of document i are hashes[first[i]:first[i + 1]]. A document
    of 1 to width - 1 words has one shingle, its whole word sequence; one without words has none.
    """
    first, h = words.first, words.hash
    counts = np.diff(first)
    with np.errstate(over="ignore"):
        n = max(0, len(h) - width + 1)
        rolled = np.zeros(n, np.uint64)
        for i in range(width):
            rolled += h[i: n + i] * _SHINGLE_MULTIPLIERS[i]
        rolled = mix64(rolled + np.uint64(width))
        produced = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
        out_first = np.concatenate([[0], np.cumsum(produced)]).astype(np.int64)
        out = np.zeros(int(out_first[-1]), np.uint64)
        long = np.flatnonzero(counts >= width)
        if len(long):
            lengths = produced[long]
            base = np.repeat(first[long] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
            source = base + np.arange(int(lengths.sum()))
            base = np.repeat(out_first[long] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
            out[base + np.arange(int(lengths.sum()))] = rolled[source]
        for k in range(1, width):
            short = np.flatnonzero(counts == k)
            if len(short):
                value = np.full(len(short), k, np.uint64)
                for i in range(k):
                    value += h[first[short] + i] * _SHINGLE_MULTIPLIERS[i]
                out[out_first[short]] = mix64(value)
    return out, out_first


def as_long(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)
