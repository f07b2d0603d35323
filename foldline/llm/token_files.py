"""Token-id files: tokenize documents, write ids in Simple-8b, read them back.

Documents are range-partitioned and sorted by id, so files in order hold the documents in order.
A task writes files of at most about FILE_IDS ids under names of its own; only the names it reports
are read, so a task that is run again leaves at most unread files. Positions over all files come from
the files' totals.

File: MAGIC, then five little-endian int64 (documents, ids, words, blocks, exceptions), then arrays of
little-endian 64-bit numbers: document ids, ids before each document (and their total), first word of
each block (and the total), exceptions, words. A null document id is stored as the smallest int64.
"""

from __future__ import annotations

import gc
import itertools
import os
import re
import sys
import types
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, mix64, scratch, slices, text_buffers, write_shared
from .simple8b import decode, encode

MAGIC = b"S8BTOK01"
FILE_IDS = 4_000_000
CACHE_ENTRIES = 1_000_000
CACHE_CHARS = 20_000_000
SLICE_BYTES = 4 << 20
NULL_ID = -(1 << 63)
END_ID = 0
# Characters whose class no Unicode version changes, the plain space and the line feed.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
PLAIN = re.compile(f"[\n -~{_LETTERS}]+")
# Fixed value: the byte-level pre-tokenizer's pattern, for texts of such characters.
PIECE = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^\\s{_LETTERS}0-9]+|\\s+(?!\\S)|\\s+")
GAP = re.compile(r"(?= \S)")
# Texts that can be cut by the classes of neighbouring bytes: plain characters without apostrophes and
# without two white-space characters in a row. There, every byte from 128 on belongs to a letter.
SIMPLE = f"\\A[\n -&(-~{_LETTERS}]*\\z"
_SPACE, _BREAK = 3, 4
_CLASS = np.zeros(256, np.int8)
_CLASS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_CLASS[48:58] = 2
_CLASS[32], _CLASS[10] = _SPACE, _BREAK
_BYTE_CODE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FACTOR = 0xD6E8FEB86659FD93
# Rule of byte-level vocabularies: printable bytes of Latin-1 stand for themselves, the others for
# the characters from 256 on, in order.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_NAMES = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Ids of whole texts from a byte-level BPE tokenizer of the tokenizers library.

    Texts are cut into strings that the tokenizer treats alone, and the library encodes each different
    string once: the pre-tokenizer's own pieces where all characters are plain, else the parts between
    gaps before a space that is followed by something else than white space, which it never joins.
    Texts that hold a special token's string go to the library whole, as do all texts if the tokenizer
    is of another kind. At most CACHE_ENTRIES strings of CACHE_CHARS characters are remembered; pieces
    of simple texts by a 64-bit hash of their bytes (n of them collide by a chance of n * n / 2**65)."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        before = self.library.pre_tokenizer
        self.by_piece = (
            isinstance(before, pre_tokenizers.ByteLevel) and before.use_regex and not before.add_prefix_space
            and self.library.normalizer is None)
        self.by_piece = self.by_piece and self._own_bytes()
        self._forget()

    def _own_bytes(self) -> bool:
        """Whether the model spells bytes as this class does, tried on all bytes of plain texts."""
        probe = ["".join(map(chr, range(32, 127))), " éÿĀɏ", "\n \n", "the"]
        return all(self._spelled(p) == self.library.encode(p, add_special_tokens=False).ids
                   for text in probe for p in PIECE.findall(text))

    def _spelled(self, piece: str) -> list[int]:
        """Ids of one piece, by the library's model alone."""
        return [t.id for t in self.library.model.tokenize(piece.encode().decode("latin-1").translate(BYTE_NAMES))]

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.hashes, self.hash_places = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # sorted by hash
        self.chars = 0
        self.lengths = np.zeros(0, np.int64)
        self.starts = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    @staticmethod
    def _cut(text: str) -> list[str]:
        if PLAIN.fullmatch(text):
            return PIECE.findall(text)
        pieces = []
        for part in GAP.split(text):
            if PLAIN.fullmatch(part):
                pieces += PIECE.findall(part)
            elif part:
                pieces.append(part)
        return pieces

    def _learn(self, names: list[str]) -> list[str]:
        """Append the ids of the different strings of ``names``; they in the order of their places."""
        known = dict.fromkeys(names)
        odd = [n for n in known if not PLAIN.fullmatch(n)]
        for n in odd:
            del known[n]
        new = [*known, *odd]
        collecting = gc.isenabled()
        gc.disable()  # hundreds of thousands of short lists, none in a cycle
        try:
            tokenize = self.library.model.tokenize
            found = [[t.id for t in tokenize(n.encode().decode("latin-1").translate(BYTE_NAMES))] for n in known]
            found += [e.ids for e in self.library.encode_batch(odd, add_special_tokens=False)]
            ids = np.fromiter(itertools.chain.from_iterable(found), np.uint32)
            lengths = np.fromiter(map(len, found), np.int64, len(found))
        finally:
            if collecting:
                gc.enable()
        self.chars += sum(map(len, new))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.ids = np.concatenate([self.ids, ids])
        return new

    def _places(self, names: list[str]) -> np.ndarray:
        """Where the ids of the strings are; unknown strings are learnt first."""
        self._make_room()
        which = np.fromiter(map(self.place.get, names, itertools.repeat(-1)), np.int64, len(names))
        missing = np.flatnonzero(which < 0)
        if len(missing):
            wanted, base = [names[i] for i in missing], len(self.lengths)
            new = self._learn(wanted)
            self.place.update(zip(new, range(base, base + len(new))))
            which[missing] = np.fromiter(map(self.place.__getitem__, wanted), np.int64, len(wanted))
        return which

    def _flat(self, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the strings, one after the other; the first of each and the total)"""
        return self._gathered(self._places(names))

    def _gathered(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths = self.lengths[which]
        first = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        return self.ids[np.repeat(self.starts[which] - first[:-1], lengths) + np.arange(first[-1])], first

    def _make_room(self) -> None:
        if len(self.lengths) > CACHE_ENTRIES or self.chars > CACHE_CHARS:
            self._forget()

    def _cut_simple(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(place of each piece of the column's texts, number of pieces of each text): a piece begins at
        white space, at a text's first byte, and where the class changes but for behind a space."""
        offsets, raw = text_buffers(column)
        data, offsets = raw[offsets[0]: offsets[-1]], offsets - offsets[0]
        kind = _CLASS[data]
        begins = kind >= _SPACE
        begins[1:] |= (kind[1:] != kind[:-1]) & (kind[:-1] != _SPACE)
        begins[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(begins)
        edges = np.append(starts, len(data))
        sizes = np.diff(edges)
        powers = np.full(int(sizes.max(initial=0)) + 1, _FACTOR, np.uint64)
        powers[0] = 1
        with np.errstate(over="ignore"):
            place = np.arange(len(data)) - np.repeat(starts, sizes)
            running = np.append(np.uint64(0), np.cumsum(_BYTE_CODE[data] * np.cumprod(powers, dtype=np.uint64)[place], dtype=np.uint64))
            hashes = mix64(running[edges[1:]] - running[edges[:-1]] + sizes.astype(np.uint64))
        coded = pa.array(hashes).dictionary_encode()
        codes, names = coded.indices.to_numpy(), coded.dictionary.to_numpy()
        self._make_room()
        which = np.full(len(names), -1)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, names), len(self.hashes) - 1)
            which = np.where(self.hashes[at] == names, self.hash_places[at], -1)
        missing = np.flatnonzero(which < 0)
        if len(missing):
            seen = np.zeros(len(names), np.int64)
            seen[codes[::-1]] = np.arange(len(codes))[::-1]  # where each piece occurs first
            begin, end = edges[seen[missing]].tolist(), edges[seen[missing] + 1].tolist()
            text, base = data.tobytes(), len(self.lengths)
            self._learn([text[a:b].decode() for a, b in zip(begin, end)])  # all different and plain
            which[missing] = np.arange(base, base + len(missing))
            both, places = np.concatenate([self.hashes, names[missing]]), np.concatenate([self.hash_places, which[missing]])
            order = np.argsort(both, kind="stable")
            self.hashes, self.hash_places = both[order], places[order]
        return which[codes], np.diff(np.searchsorted(starts, offsets))

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``encode`` of a string column without nulls: simple texts are cut and looked up as arrays."""
        match = pa.compute.match_substring_regex
        simple = pa.compute.and_not(match(column, SIMPLE), match(column, r"\s\s"))
        for special in self.special:
            simple = pa.compute.and_not(simple, pa.compute.match_substring(column, special))
        simple = simple.to_numpy(zero_copy_only=False) & self.by_piece
        others = np.flatnonzero(~simple)
        other_ids, other_sizes = self.encode(column.take(pa.array(others)).to_pylist())
        which, counts = self._cut_simple(column.filter(pa.array(simple)))
        flat, first = self._gathered(which)
        sizes = np.empty(len(column), np.int64)
        sizes[simple] = np.diff(first[np.append(0, np.cumsum(counts))]) + 1
        sizes[others] = other_sizes
        ends = np.cumsum(sizes)
        out = np.full(int(ends[-1]) if len(ends) else 0, END_ID, np.uint32)
        owner, inside = np.repeat(simple, sizes), np.ones(len(out), bool)
        inside[ends - 1] = False
        out[owner & inside] = flat
        out[~owner] = other_ids
        return out, sizes

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each followed by END_ID; number of ids of each text with its end)."""
        whole, pieces, counts = {}, [], []
        for i, text in enumerate(texts):
            before = len(pieces)
            if not self.by_piece or any(s in text for s in self.special):
                whole[i] = np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)
            else:
                pieces += self._cut(text)
            counts.append(len(pieces) - before)
        flat, first = self._flat(pieces)
        edge = first[np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)]
        parts, sizes, end = [flat[:0]], [], np.array([END_ID], np.uint32)
        for i in range(len(texts)):
            own = whole[i] if i in whole else flat[edge[i]: edge[i + 1]]
            parts += [own, end]
            sizes.append(len(own) + 1)
        return np.concatenate(parts), np.array(sizes, np.int64)


def pack_file(doc_ids: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> bytes:
    words, first, exceptions = encode(ids.astype(np.uint64))
    starts = np.concatenate([[0], np.cumsum(sizes)])
    head = np.array([len(doc_ids), len(ids), len(words), len(first) - 1, len(exceptions)], "<i8")
    parts = [head, doc_ids.astype("<i8"), starts.astype("<i8"), first.astype("<i8"), exceptions.astype("<u8"), words.astype("<u8")]
    return MAGIC + b"".join(p.tobytes() for p in parts)


def unpack_file(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document ids, ids before each document and their total, ids); raises on a damaged file."""
    if data[:8] != MAGIC:
        raise ValueError("not a token-id file")
    docs, total, words, blocks, exceptions = (int(x) for x in np.frombuffer(data, "<i8", 5, 8))
    counts = [docs, docs + 1, blocks + 1, exceptions, words]
    if len(data) != 48 + 8 * sum(counts):
        raise ValueError("token-id file of a wrong length")
    at, parts = 48, []
    for count, kind in zip(counts, ("<i8", "<i8", "<i8", "<u8", "<u8")):
        parts.append(np.frombuffer(data, kind, count, at))
        at += 8 * count
    return parts[0], parts[1], decode(parts[4], parts[2], parts[3], total)


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str | None = None, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Write the files below ``path`` (a shared folder); (file, part, place, documents, ids), a row a
    file, in file order by (part, place). Null texts are empty: one end id. Rows are ordered by id
    (null first), then by text; repeated rows are all written. An empty table writes no file."""
    tokenizer = tokenizer or default_tokenizer()
    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order, "text")

    def run(batches):
        from pyspark import TaskContext

        # one encoder a worker process: what it has learnt serves the process's later tasks
        kept = sys.modules.setdefault("foldline_encoders", types.ModuleType("foldline_encoders")).__dict__
        encoder, place = kept.setdefault(tokenizer, None) or Encoder(tokenizer), 0
        kept[tokenizer] = encoder
        ids, sizes, names, waiting = [], [], [], 0

        def flush():
            name = f"part-{TaskContext.get().partitionId():06d}-{place:06d}-{uuid.uuid4().hex}.s8b"
            write_shared(f"{path.rstrip('/')}/{name}", pack_file(np.concatenate(names), np.concatenate(sizes), np.concatenate(ids)))
            columns = ([name], [TaskContext.get().partitionId()], [place], [sum(map(len, names))], [waiting])
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, (pa.string(), *[pa.int64()] * 4))],
                ["file", "part", "place", "documents", "ids"])

        for batch in batches:
            for at, part in slices(batch.column(1), SLICE_BYTES):
                flat, counts = encoder.encode_column(part)
                ids.append(flat), sizes.append(counts)
                names.append(batch.column(0).slice(at, len(part)).fill_null(NULL_ID).to_numpy(zero_copy_only=False))
                waiting += len(flat)
                if waiting >= FILE_IDS:
                    yield flush()
                    place += 1
                    ids, sizes, names, waiting = [], [], [], 0
        if names:
            yield flush()

    return materialize(dealt.mapInArrow(run, "file string, part long, place long, documents long, ids long"), "token-manifest")


def read_token_files(spark: SparkSession, path: str, manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the manifest's files; ``start``
    counts the ids of all documents before it."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.s8b").load(path).select("path", "content")

    def run(batches):
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                doc_ids, starts, ids = unpack_file(content.as_py())
                raw = ids.astype("<u4").tobytes()
                sums = [zlib.crc32(raw[4 * a: 4 * b]) for a, b in zip(starts[:-1], starts[1:])]
                null = doc_ids == NULL_ID
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name.rpartition("/")[2]] * len(doc_ids), pa.string()), pa.array(doc_ids, pa.int64(), mask=null),
                     pa.array(starts[:-1]), pa.array(np.diff(starts)), pa.array(sums, pa.int64())],
                    ["file", "doc_id", "start", "n_tokens", "ids_crc32"])

    found = files.mapInArrow(run, "file string, doc_id long, start long, n_tokens long, ids_crc32 long")
    before = F.sum("ids").over(Window.orderBy("part", "place").rowsBetween(Window.unboundedPreceding, -1))  # a row a file
    offsets = manifest.select("file", F.coalesce(before, F.lit(0)).alias("before"))
    return found.join(offsets, "file").select("doc_id", (F.col("before") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")


def token_round_trip(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write ``docs`` (doc_id, text) as token-id files and report what reading them gives."""
    spark = docs.sparkSession
    path = scratch(spark, "token-files")
    manifest = write_token_files(docs, path, tokenizer)
    if manifest.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return read_token_files(spark, path, manifest)
