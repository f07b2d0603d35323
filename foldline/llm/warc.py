"""WARC archives: write pages as records, read archives by boundary-chain verification.

Writing: one gzip member per record (``.warc.gz``; ``compress=False`` writes plain ``.warc``), files
of about FILE_BYTES under names of their own; only files that tasks report are read again, so a task
that runs twice leaves at most unread files.

Reading is split: a task takes a byte range of a file and emits every place in it that looks like a
record start (the magic bytes, with a parsable record behind them), with the offset of the record's
successor. Magic bytes inside payloads give candidates as well. Only what can be reached from the
file's first byte is a record: inside a range the chains are followed at once, and between ranges by
pointer jumping (each round doubles the distance), so a file of n ranges takes about log2(n) rounds.
The ranges are then read from their verified entry points.
"""

from __future__ import annotations

import hashlib
import math
import re
import uuid
import zlib
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import _open_shared, materialize, scratch, write_shared

FILE_BYTES = 16 << 20
RANGE_BYTES = 4 << 20
MIN_REVISIT_BYTES = 100
DATE = "1970-01-01T00:00:00Z"
_GZIP = b"\x1f\x8b\x08"
_PLAIN = re.compile(rb"WARC/1\.[01]\r\n")
_READ = 1 << 16


def record_bytes(page_id, url, payload: bytes, digest: str, refers_to=None, revisit: bool = False, date: str = DATE) -> bytes:
    """One response or revisit record, its HTTP header with the payload's full length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id}:{url}:{digest}:{'revisit' if revisit else 'response'}")
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:uuid:{name}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", None if url is None else quote(url, safe="!#$%&'()*+,/:;=?@[]~|^`{}\"<>\\")),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if revisit else None),
        ("X-Page-ID", page_id),
        ("X-Refers-To-Page-ID", refers_to if revisit else None),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", len(block)),
    ]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def plan_records(pages: DataFrame) -> DataFrame:
    """page_id, url, html ('' for null), digest, refers_to: the smallest page_id of an equal payload
    of at least MIN_REVISIT_BYTES, or null if the row is that page itself or has no equal."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha2("html", 256))
    first = (
        rows.where(F.octet_length("html") >= MIN_REVISIT_BYTES).groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first")
    )
    joined = rows.join(first, "digest", "left")
    other = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select("page_id", "url", "html", "digest", F.when(other, F.col("first")).alias("refers_to"))


def write_warc(pages: DataFrame, path: str, compress: bool = True) -> DataFrame:
    """Write ``pages`` (page_id, url, html) below ``path``; a row (file, bytes, records) a file.

    Null html is an empty payload; of equal payloads of MIN_REVISIT_BYTES or more, rows with the
    smallest page_id are responses and all others revisits of it (null ids count as larger; if all
    ids are null, all are responses). Null urls and ids leave their fields out. Repeated rows are
    all written. An empty table writes nothing. Other columns are not read."""
    ending = "warc.gz" if compress else "warc"

    def run(batches):
        from pyspark import TaskContext

        place, waiting, records, parts = 0, 0, 0, []

        def flush():
            name = f"part-{TaskContext.get().partitionId():06d}-{place:06d}-{uuid.uuid4().hex}.{ending}"
            write_shared(f"{path.rstrip('/')}/{name}", b"".join(parts))
            return pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([waiting], pa.int64()), pa.array([records], pa.int64())],
                ["file", "bytes", "records"])

        for batch in batches:
            for page_id, url, html, digest, refers in zip(*batch.columns):
                page_id, url, refers = page_id.as_py(), url.as_py(), refers.as_py()
                data = record_bytes(
                    page_id, url, html.as_py().encode(), digest.as_py(), refers, refers is not None)
                data = _member(data) if compress else data
                parts.append(data)
                waiting += len(data)
                records += 1
                if waiting >= FILE_BYTES:
                    yield flush()
                    place, waiting, records, parts = place + 1, 0, 0, []
        if parts:
            yield flush()

    return materialize(plan_records(pages).mapInArrow(run, "file string, bytes long, records long"), "warc-manifest")


class _Bytes:
    """A window of a file that grows forward on demand."""

    def __init__(self, uri: str, start: int, size: int):
        self.source = _open_shared(uri, "rb")
        self.source.seek(start)
        self.start, self.size, self.data = start, size, b""

    def upto(self, end: int) -> bytes:
        """The window's bytes, read to ``end`` at least or to the file's end."""
        missing = min(end, self.size) - self.start - len(self.data)
        if missing > 0:
            self.data += self.source.read(missing)
        return self.data

    def record(self, offset: int):
        """(record bytes, offset behind it) of a gzip member or plain record at ``offset``; None
        where there is no whole record."""
        at = offset - self.start
        if self.upto(offset + 3)[at: at + 3] == _GZIP:
            unpacker, out, end = zlib.decompressobj(31), [], offset
            try:
                while not unpacker.eof and end < self.size:
                    piece = self.upto(end + _READ)[end - self.start: end - self.start + _READ]
                    out.append(unpacker.decompress(piece))
                    end += len(piece)
                    if len(out) == 1 and not b"WARC/1.".startswith(out[0][:7]):
                        return None
            except zlib.error:
                return None
            return (b"".join(out), end - len(unpacker.unused_data)) if unpacker.eof else None
        head = self._head(offset)
        length = None if head is None else content_length(head)
        if length is None:
            return None
        end = offset + len(head) + 4 + length + 4
        if end > self.size:
            return None
        return self.upto(end)[at: end - self.start], end

    def _head(self, offset: int):
        at, end = offset - self.start, offset + _READ
        while True:
            data = self.upto(end)
            stop = data.find(b"\r\n\r\n", at)
            if stop >= 0:
                return data[at:stop] if _PLAIN.match(data, at) else None
            if end >= self.size or end > offset + (1 << 20):
                return None
            end += _READ


def content_length(head: bytes):
    found = re.search(rb"\r\nContent-Length:[ \t]*([0-9]{1,15})(?=\r\n|$)", head, re.IGNORECASE)
    return int(found[1]) if found else None


def range_candidates(uri: str, size: int, start: int, end: int) -> list[tuple[int, int]]:
    """(offset, exit) of every candidate record in [start, end): exit is the first offset at or
    behind ``end`` on its chain, or -1 if the chain breaks inside the range."""
    window = _Bytes(uri, start, size)
    data = window.upto(end + 16)
    limit = end - start
    places = {m.start() for m in _PLAIN.finditer(data) if m.start() < limit}
    places |= {m.start() for m in re.finditer(re.escape(_GZIP), data) if m.start() < limit}
    exits: dict[int, int] = {}
    for offset in sorted((start + p for p in places), reverse=True):
        found = window.record(offset)
        if found is not None:
            follows = found[1]
            exits[offset] = follows if follows >= end else exits.get(follows, -1)
    return sorted(exits.items())


def parse_record(data: bytes) -> dict:
    """Fields of one record, its payload, and the payload's full length."""
    head, _, block = data.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:])}
    block = block[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    full = content_length(b"\r\n" + http)
    return {"fields": fields, "payload": payload, "payload_bytes": len(payload) if full is None else full}


def verified_entries(spark: SparkSession, path: str, files: DataFrame) -> DataFrame:
    """(file, bytes, start, end, entry): the ranges of the files with their first real record.
    ``files``: file, bytes. Raises if a file's chain does not end at the file's end."""
    ranges = files.where("bytes > 0").select(
        "file", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(RANGE_BYTES).cast("long"))).alias("start"))
    ranges = ranges.withColumn("end", F.least(F.col("start") + RANGE_BYTES, F.col("bytes")))

    def scan(batches):
        for batch in batches:
            for file, size, start, end in zip(*(c.to_pylist() for c in batch.columns)):
                found = range_candidates(f"{path.rstrip('/')}/{file}", size, start, end)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file] * len(found), pa.string()), pa.array([f[0] for f in found], pa.int64()),
                     pa.array([f[1] for f in found], pa.int64())], ["file", "offset", "exit"])

    dealt = spread(ranges)
    jumps = materialize(dealt.mapInArrow(scan, "file string, offset long, exit long"), "warc-candidates")
    reached = files.where("bytes > 0").select("file", F.lit(0).cast("long").alias("offset"))
    most = files.agg(F.max("bytes")).first()[0] or 0
    for _ in range(max(1, math.ceil(math.log2(max(2, most / RANGE_BYTES + 1))))):
        step = reached.join(jumps, ["file", "offset"]).where("exit >= 0").select("file", F.col("exit").alias("offset"))
        reached = materialize(reached.union(step).distinct(), "warc-reached")
        onward = jumps.select("file", F.col("offset").alias("exit"), F.col("exit").alias("further"))
        jumps = materialize(
            jumps.join(onward, ["file", "exit"]).select("file", "offset", F.col("further").alias("exit")), "warc-jumps")
    ends = reached.join(files, "file").where("offset = bytes").select("file").distinct()
    broken = files.where("bytes > 0").join(ends, "file", "left_anti").limit(3).collect()
    if broken:
        raise ValueError(f"no unbroken chain of records: {[r['file'] for r in broken]}")
    places = reached.withColumnRenamed("offset", "entry").withColumn("start", F.col("entry") - F.pmod("entry", F.lit(RANGE_BYTES)))
    return places.join(ranges, ["file", "start"]).select("file", "bytes", "start", "end", "entry")


def spread(ranges: DataFrame) -> DataFrame:
    """One task for each range: each row stands for megabytes of reading."""
    return ranges.repartition(max(1, ranges.count()), "file", "start")


def read_warc(spark: SparkSession, path: str, files: DataFrame, with_payload: bool = True) -> DataFrame:
    """Every record of the archives below ``path`` named by ``files`` (file, bytes): file, offset,
    page_id, url (as written), record_type, refers_to, payload_bytes, payload_digest (sha256, checked
    for payloads that are there), and the payload."""
    entries = verified_entries(spark, path, files)

    def take(batches):
        for batch in batches:
            for file, size, start, end, entry in zip(*(c.to_pylist() for c in batch.columns)):
                window, rows = _Bytes(f"{path.rstrip('/')}/{file}", entry, size), []
                while entry < end:
                    data, follows = window.record(entry)
                    found = parse_record(data)
                    fields, digest = found["fields"], found["fields"].get("warc-payload-digest", "").removeprefix("sha256:")
                    if fields["warc-type"] == "response" and hashlib.sha256(found["payload"]).hexdigest() != digest:
                        raise ValueError(f"{file}: payload of the record at {entry} is damaged")
                    page, refers = fields.get("x-page-id"), fields.get("x-refers-to-page-id")
                    rows.append((
                        file, entry, None if page is None else int(page), fields.get("warc-target-uri"), fields["warc-type"],
                        None if refers is None else int(refers), found["payload_bytes"], digest,
                        found["payload"] if with_payload else None))
                    entry = follows
                    if len(rows) >= 2000:
                        yield record_batch(rows)
                        rows = []
                if rows:
                    yield record_batch(rows)

    schema = "file string, offset long, page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"
    return spread(entries).mapInArrow(take, schema)


def record_batch(rows):
    names = ["file", "offset", "page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def list_archives(spark: SparkSession, path: str) -> DataFrame:
    """(file, bytes) of the archives in a folder, from the file listing alone."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc*").load(path)
    return listed.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("bytes"))


def warc_round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as archives and report what reading them gives, a row a page."""
    spark = pages.sparkSession
    path = scratch(spark, "warc")
    manifest = write_warc(pages, path)
    records = read_warc(spark, path, manifest.select("file", "bytes"), with_payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
