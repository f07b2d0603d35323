"""Spelling variant grouping by reduced-alphabet generation.

Letters are hashed to SYMBOLS symbols. Each word's reduced form gets its full neighbourhood of one
edit (itself, deletions, replacements and insertions), as 64-bit polynomial hashes built from prefix
and suffix sums; neighbours are joined with the reduced vocabulary, and candidate words are verified
on the original strings. An edit of a word is at most one edit of its reduced form, so no pair is missed.

Most neighbours stand for no word. A bitmap of the reduced vocabulary, of a fixed 2**BITMAP_BITS bits
for any vocabulary, drops those that cannot before they are shuffled; the join decides about the rest.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_long, materialize, mix64

RUN = "[A-Za-zÀ-ÿ]"
MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5
SYMBOLS = 8
ALTER_EVERY = 199
BITMAP_BITS = 24
PIECE = 1 << 20  # code points of a text looked at together
FLUSH = 200_000  # distinct words a task holds before it sends their counts

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _pieces(text: str, inside: re.Pattern):
    """Parts of a text of about PIECE code points that cut no run."""
    at = 0
    while at < len(text):
        end = at + PIECE
        rest = inside.match(text, end)
        end = rest.end() if rest else end
        yield text[at:end]
        at = end


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words of ``docs`` (id, text) with their occurrences: runs of letters with A-Z
    lower-cased; a run whose crc32 with the id is a multiple of ALTER_EVERY loses the code point at
    crc32 % length. Words of fewer code points or occurrences are no words."""
    long_run = f"{RUN}{{{min_length},}}"  # a shorter run cannot give a word

    def run(batches):
        runs, inside, totals = re.compile(long_run), re.compile(RUN + "+"), Counter()

        def send():
            words = list(totals)
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(totals.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for name, text in zip(batch.column(0), batch.column(1)):
                name, text = name.as_py(), text.as_py()
                start = zlib.crc32(f"{'' if name is None else name}:".encode())
                for piece in _pieces(text or "", inside):
                    for word, times in Counter(runs.findall(piece.encode().translate(_LOWER).decode())).items():
                        h = zlib.crc32(word.encode(), start)
                        if h % ALTER_EVERY == 0:
                            cut = h % len(word)
                            word = word[:cut] + word[cut + 1:]
                            if len(word) < min_length:
                                continue
                        totals[word] += times
                    if len(totals) >= FLUSH:
                        yield send()
                        totals.clear()
        if totals:
            yield send()

    counted = docs.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= min_count)


def _reduced(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all words in a row, and the first of each word (and their number)."""
    codes = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), np.uint32)
    first = np.append(0, np.cumsum(pa.compute.utf8_length(words).to_numpy(zero_copy_only=False))).astype(np.int64)
    return mix64(codes.astype(np.uint64)) % np.uint64(SYMBOLS) + np.uint64(1), first


class _Sums:
    """Polynomial hashes of the reduced forms of a batch of words, and of all their one-edit neighbours."""

    def __init__(self, words: pa.Array):
        symbols, self.first = _reduced(words)
        self.lengths = np.diff(self.first)
        self.word = np.repeat(np.arange(len(words)), self.lengths)
        place = np.arange(len(symbols)) - self.first[self.word]
        powers = np.full(int(self.lengths.max(initial=0)) + 2, _BASE, np.uint64)
        powers[0] = 1
        self.power = np.cumprod(powers, dtype=np.uint64)
        self.symbols, self.at = symbols, self.power[place]
        running = np.append(np.uint64(0), np.cumsum(symbols * self.at, dtype=np.uint64))
        self.before = running[:-1] - running[self.first[self.word]]
        self.total = running[self.first[1:]] - running[self.first[:-1]]

    def neighbours(self) -> tuple[np.ndarray, np.ndarray]:
        """(word, key) of the full neighbourhoods, with repeats."""
        word, total = self.word, self.total[self.word]
        own = self.symbols * self.at
        after = total - self.before - own
        words, keys = [np.arange(len(self.total)), word], [self.total, self.before + after * np.uint64(_INVERSE)]
        ends = self.power[self.lengths]
        for symbol in range(1, SYMBOLS + 1):
            added = np.uint64(symbol)
            words += [word, word, np.arange(len(self.total))]
            keys += [total - own + added * self.at,
                     self.before + added * self.at + (own + after) * np.uint64(_BASE),
                     self.total + added * ends]
        return np.concatenate(words), mix64(np.concatenate(keys))


def _keyed(words: DataFrame) -> DataFrame:
    """``words`` (word, n) with the key of their reduced forms."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(as_long(mix64(_Sums(batch.column(0)).total))), batch.column(0), batch.column(1)], ["key", "word", "n"])

    return words.select("word", "n").mapInArrow(run, "key long, word string, n long")


def _bitmap(keys: DataFrame) -> np.ndarray:
    """The fixed-size bitmap of ``keys`` (key), as 64-bit words: at most 2**BITMAP_BITS / 64 rows come."""
    low = F.col("key").bitwiseAND(F.lit((1 << BITMAP_BITS) - 1))
    bit = F.expr(f"shiftleft(1L, cast(key & 63 as int))")
    rows = keys.groupBy(F.shiftright(low, 6).cast("int").alias("at")).agg(F.bit_or(bit).alias("bits")).toArrow()
    out = np.zeros(1 << (BITMAP_BITS - 6), np.uint64)
    out[rows.column("at").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return out


def near_words(vocabulary: DataFrame) -> DataFrame:
    """(word, n, near, near_n) for every two words of ``vocabulary`` (word, n; written, not null)
    that differ by exactly one inserted, deleted or replaced code point; both ways round."""
    spark = vocabulary.sparkSession
    keyed = materialize(_keyed(vocabulary), "spelling-keys")
    bitmap = spark.sparkContext.broadcast(_bitmap(keyed.select("key").distinct()))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                word, key = _Sums(part.column(0)).neighbours()
                low = key & np.uint64((1 << BITMAP_BITS) - 1)
                there = (bitmap.value[(low >> np.uint64(6)).astype(np.int64)] >> (low & np.uint64(63))) & np.uint64(1) == 1
                word, key = word[there], key[there]
                order = np.lexsort((key, word))
                word, key = word[order], key[order]
                new = np.ones(len(word), bool)
                new[1:] = (word[1:] != word[:-1]) | (key[1:] != key[:-1])
                own = part.take(pa.array(word[new]))
                yield pa.RecordBatch.from_arrays([pa.array(as_long(key[new])), own.column(0), own.column(1)], ["key", "word", "n"])

    near = keyed.select("word", "n").mapInArrow(run, "key long, word string, n long")
    others = keyed.select("key", F.col("word").alias("near"), F.col("n").alias("near_n"))
    lengths = F.abs(F.length("word") - F.length("near")) <= 1
    return (
        near.hint("merge").join(others, "key").where(lengths & (F.levenshtein("word", "near", 1) == 1))
        .select("word", "n", "near", "near_n")
    )


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms`` (word, form): pointers jump until none moves; a chain of forms gets
    RATIO times more frequent at each step, so it ends, after log2 of its length rounds."""
    pointers = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        following = pointers.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = pointers.join(following, "root", "left")
        jumped = materialize(moved.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        pointers = jumped.select("word", "root")
        if jumped.where("moved").isEmpty():
            return pointers


def spelling_variants(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    ``form`` is the near word of largest n (ties: the first in code-point order) if that is at least
    RATIO times the word's n, else null; ``root`` follows forms to the last. Null and empty texts
    have no words; a null id hashes as empty text; repeated rows count as often as they occur.
    Texts of any length are read in pieces. An empty table gives an empty result; other columns,
    whatever their names, are not read."""
    source = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").alias("text"))
    vocabulary = materialize(word_counts(source.select(F.col("id").cast("string").alias("id"), "text")), "spelling-words")
    best = near_words(vocabulary).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    words = materialize(
        vocabulary.join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(-F.col("best.less") >= RATIO * F.col("n"), F.struct(F.col("best.near").alias("form"), (-F.col("best.less")).alias("n"))).alias("f"))
        .select("word", "n", "n_near", F.col("f.form").alias("form"), F.col("f.n").alias("form_n")), "spelling-forms")
    roots = _roots(words.where(F.col("form").isNotNull()).select("word", "form"))
    return words.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
