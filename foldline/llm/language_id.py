"""Language identification by words first, then shorter and shorter character n-grams.

A text's words are its runs of letters, lower-cased. A known word scores, for each language, the log
of its frequency among that language's known words. An unseen word falls back to its character n-grams
of ORDERS[0] code points (word edges count as one each); if none of them is known, to shorter ones,
and so on: the first order with known n-grams gives the mean of their log frequencies. The sums over
all words of a text and the log share of each language's documents give the prediction.

Counts cover all training texts. A word or n-gram that occurs once tells no frequency and counts as
unseen. The tables that tasks look up hold the most frequent features of each kind, CELLS numbers (a
fixed bound, whatever the corpus and the number of languages) in all; a histogram of counts finds
the least count that fits, so only features of the tables reach the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_long, materialize, mix64, slices, text_buffers

HELD_OUT_OF, HELD_OUT = 4, 2
ORDERS = (4, 3, 2, 1)
CELLS = 1 << 22  # half of them for words, the rest in equal parts for the orders
LEAST_COUNT = 2
SMOOTHING = 0.5
BINS = 8  # histogram bins for each doubling of a count
FLUSH = 2_000_000  # counts a task holds before it folds and sends them
UNDETERMINED = "und"

_FACTOR = 0x9E3779B97F4A7C15


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text (null: empty) leaves HELD_OUT when divided by HELD_OUT_OF."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(HELD_OUT_OF)) == HELD_OUT


# ------------------------------------------------------------------ words and n-grams of a batch


class Letters:
    """Letters and lower case by code point (others than the first 65,536 as they occur)."""

    def __init__(self):
        names = [chr(i) for i in range(1 << 16)]
        self.letter = np.array([c.isalpha() for c in names])
        self.lower = np.array([ord(c.lower()[0]) for c in names], np.uint32)

    def __call__(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low = np.minimum(codes, np.uint32(0xFFFF))
        is_letter, lower = self.letter[low], self.lower[low]
        high = np.flatnonzero(codes > 0xFFFF)
        if len(high):
            found, back = np.unique(codes[high], return_inverse=True)
            is_letter[high] = np.array([chr(c).isalpha() for c in found])[back]
            lower[high] = np.array([ord(chr(c).lower()[0]) for c in found], np.uint32)[back]
        return is_letter, lower


class WordBatch:
    """The words of a string column: ``hash`` and ``doc`` of each, and the codes of their letters."""

    def __init__(self, column: pa.Array, letters: Letters):
        offsets, raw = text_buffers(column)
        text = raw[offsets[0]: offsets[-1]].tobytes().decode()
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        lengths = pa.compute.utf8_length(column.fill_null("")).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths).astype(np.int64)
        is_letter, lower = letters(codes)
        head = is_letter.copy()
        head[1:] &= ~is_letter[:-1]
        cut = ends[ends < len(codes)]
        head[cut] = is_letter[cut]
        starts = np.flatnonzero(head)
        self.doc = np.searchsorted(ends, starts, "right")
        kept = np.flatnonzero(is_letter)
        self.first = np.append(np.searchsorted(kept, starts), len(kept)).astype(np.int64)
        with np.errstate(over="ignore"):
            self.code = mix64(lower[kept].astype(np.uint64) + np.uint64(2))
            sizes = np.diff(self.first)
            place = np.arange(len(kept)) - np.repeat(self.first[:-1], sizes)
            powers = np.full(int(sizes.max(initial=0)) + 1, _FACTOR, np.uint64)
            powers[0] = 1
            powers = np.cumprod(powers, dtype=np.uint64)
            running = np.append(np.uint64(0), np.cumsum(self.code * powers[place], dtype=np.uint64))
            self.hash = mix64(running[self.first[1:]] - running[self.first[:-1]])

    def ngrams(self, words: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``words``, hash) of every n-gram of the words with these numbers, their edges included."""
        sizes = self.first[words + 1] - self.first[words]
        ends = np.cumsum(sizes + 2)
        owner = np.repeat(np.arange(len(words)), sizes + 2)
        padded = np.full(int(ends[-1]) if len(ends) else 0, mix64(np.array([1], np.uint64))[0], np.uint64)
        inside = np.ones(len(padded), bool)
        inside[ends - 1], inside[ends - sizes - 2] = False, False
        source = np.repeat(self.first[words] - np.append(0, np.cumsum(sizes)[:-1]), sizes) + np.arange(int(sizes.sum()))
        padded[inside] = self.code[source]
        n = max(0, len(padded) - order + 1)
        with np.errstate(over="ignore"):
            value, factor = np.full(n, order, np.uint64), np.uint64(1)
            for i in range(order):
                factor = factor * np.uint64(_FACTOR)
                value += padded[i: n + i] * factor
        whole = owner[:n] == owner[order - 1:]
        return owner[:n][whole], mix64(value[whole])


def _summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, weights = keys[order], weights[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], (np.add.reduceat(weights, starts) if len(starts) else weights)


# ------------------------------------------------------------------ learning


def feature_counts(texts: DataFrame, languages: list[str]) -> DataFrame:
    """(kind, feature, total, counts array<struct<lang int, n long>>) of the words (kind 0) and n-grams
    (kind: their order) of ``texts`` (text, lang) that occur LEAST_COUNT times or more."""
    known = pa.array(languages, pa.string())

    def run(batches):
        letters, waiting, held = Letters(), {}, 0

        def send():
            for (kind, lang), parts in waiting.items():
                keys, counts = _summed(*(np.concatenate(p) for p in zip(*parts)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(keys), kind, np.int32)), pa.array(as_long(keys)),
                     pa.array(np.full(len(keys), lang, np.int32)), pa.array(counts)], ["kind", "feature", "lang", "n"])

        for batch in batches:
            for at, part in slices(batch.column(0), 2 << 20):
                words = WordBatch(part, letters)
                lang = pa.compute.index_in(batch.column(1).slice(at, len(part)), known).fill_null(-1).to_numpy(zero_copy_only=False)[words.doc]
                for own in np.unique(lang[lang >= 0]):
                    mine = np.flatnonzero(lang == own)
                    hashes, some, times = np.unique(words.hash[mine], return_index=True, return_counts=True)
                    found = [(0, hashes, times)]
                    for order in ORDERS:
                        place, grams = words.ngrams(mine[some], order)
                        found.append((order, *_summed(grams, times[place])))
                    for kind, keys, counts in found:
                        waiting.setdefault((kind, int(own)), []).append((keys, counts.astype(np.int64)))
                        held += len(keys)
                if held > FLUSH:
                    yield from send()
                    waiting, held = {}, 0
        yield from send()

    rows = texts.select("text", "lang").mapInArrow(run, "kind int, feature long, lang int, n long")
    return (
        rows.repartition("kind", "feature").groupBy("kind", "feature", "lang").agg(F.sum("n").alias("n"))
        .groupBy("kind", "feature").agg(F.sum("n").alias("total"), F.collect_list(F.struct("lang", "n")).alias("counts"))
        .where(F.col("total") >= LEAST_COUNT)
    )


def _tables(counts: DataFrame, languages: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By kind: sorted features and their log frequencies by language. At most CELLS numbers."""
    size = F.floor(F.log2("total") * BINS).cast("int")
    histogram = counts.groupBy("kind", size.alias("size")).agg(F.count("*").alias("n")).orderBy("kind", F.desc("size")).collect()
    least, left = {}, {0: CELLS // 2 // languages} | dict.fromkeys(ORDERS, CELLS // 2 // len(ORDERS) // languages)
    for row in histogram:
        left[row["kind"]] -= row["n"]
        if left[row["kind"]] >= 0:
            least[row["kind"]] = row["size"]
    tables = {}
    for kind, bound in least.items():
        found = counts.where((F.col("kind") == kind) & (size >= bound)).select("feature", "counts").toArrow().combine_chunks()
        features = found.column("feature").to_numpy().view(np.uint64)
        lists = found.column("counts").combine_chunks()
        number = np.zeros((len(features), languages))
        pairs = lists.flatten()
        rows = np.repeat(np.arange(len(features)), pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False))
        number[rows, pairs.field("lang").to_numpy()] = pairs.field("n").to_numpy()
        logs = np.log((number + SMOOTHING) / (number.sum(axis=0) + SMOOTHING * len(features)))
        order = np.argsort(features)
        tables[kind] = features[order], logs[order].astype(np.float32)
    return tables


def _places(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)


def word_scores(words: WordBatch, some: np.ndarray, tables: dict, languages: int) -> np.ndarray:
    """Log frequencies by language of the words with numbers ``some``; 0 where nothing is known."""
    scores = np.zeros((len(some), languages))
    open_words = np.arange(len(some))
    if 0 in tables:
        features, logs = tables[0]
        at = _places(features, words.hash[some])
        scores[at >= 0] = logs[at[at >= 0]]
        open_words = np.flatnonzero(at < 0)
    for order in ORDERS:
        if order not in tables or not len(open_words):
            continue
        features, logs = tables[order]
        place, grams = words.ngrams(some[open_words], order)
        at = _places(features, grams)
        place, at = place[at >= 0], at[at >= 0]
        known = np.bincount(place, minlength=len(open_words))
        for lang in range(languages):
            total = np.bincount(place, logs[at, lang], len(open_words))
            scores[open_words, lang] = np.where(known > 0, total / np.maximum(known, 1), 0.0)
        open_words = open_words[known == 0]
    return scores


def identify_language(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang"
) -> DataFrame:
    """One row per row of ``docs``: id, held_out, lang_pred, score.

    Learns from the texts and non-null languages of rows that are not held out; predictions use
    texts alone. ``score`` is the posterior share of the predicted language. A text that is null or
    has no letters is ``und`` with score 0, as is any text if no language can be learned. Of
    languages with equal scores the first in code-point order is taken. Equal texts get equal
    predictions; a null id hashes as empty text and is not held out. Whole texts are read, of any
    length. An empty table gives an empty result; other columns, whatever their names, are not read."""
    spark = docs.sparkSession
    source = docs.select(
        F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").alias("text"),
        F.col(f"`{lang_column}`").cast("string").alias("lang"), held_out(F.col(f"`{id_column}`")).alias("held"))
    learning = source.where(~F.col("held") & F.col("lang").isNotNull())
    shares = sorted((r["lang"], r["n"]) for r in learning.groupBy("lang").agg(F.count("*").alias("n")).collect())
    languages = [lang for lang, _ in shares]
    tables = {}
    if languages:
        tables = _tables(materialize(feature_counts(learning, languages), "language-counts"), len(languages))
    prior = np.log(np.array([n for _, n in shares], float) / max(1, sum(n for _, n in shares)))
    shared = spark.sparkContext.broadcast(tables)

    def run(batches):
        letters = Letters()
        for batch in batches:
            for at, part in slices(batch.column(2), 2 << 20):
                words = WordBatch(part, letters)
                _, some, back = np.unique(words.hash, return_index=True, return_inverse=True)
                best, share = np.full(len(part), -1), np.zeros(len(part))
                if languages:
                    scores = word_scores(words, some, shared.value, len(languages))
                    totals = np.stack([np.bincount(words.doc, scores[back, i], len(part)) for i in range(len(languages))], 1) + prior
                    lettered = np.bincount(words.doc, minlength=len(part)) > 0
                    odds = np.exp(totals - totals.max(axis=1, keepdims=True))
                    best = np.where(lettered, totals.argmax(axis=1), -1)
                    share = np.where(lettered, odds.max(axis=1) / odds.sum(axis=1), 0.0)
                named = pa.array(languages + [UNDETERMINED], pa.string()).take(pa.array(np.where(best < 0, len(languages), best)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(part)), batch.column(1).slice(at, len(part)), named, pa.array(share)],
                    ["id", "held_out", "lang_pred", "score"])

    kind = source.schema["id"].dataType.simpleString()
    rows = source.select("id", "held", "text").mapInArrow(run, f"id {kind}, held_out boolean, lang_pred string, score double")
    return rows.withColumnRenamed("id", id_column)
