"""Scoring whole documents with a gated recurrent language model.

Word counts cover all training documents; the counts of every word also enter the score. The network
(``gru``) predicts the VOCABULARY - 2 most frequent words, the text's end, and one id for all other
words, which are then scored by their own counts among such words, with one added to each. It is
trained by one data-parallel pass over the whole texts of all training documents: every task trains
a copy on its rows, and the copies are averaged by tokens.

Scoring looks words up in a broadcast table of the FREQUENT most frequent words (a fixed bound). All
other occurrences are joined with the full count table by word, and their sums by document return to
the documents; no task holds the vocabulary.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import as_long, batch_words, materialize, mix64, slices, text_buffers
from .gru import PARAMETERS, new_model, pack, score, train, unpack

FREQUENT = 65_536
VOCABULARY = 1024
TRAIN_TOKENS = 4 << 20  # tokens a task gathers before it trains on them
SCORE_BYTES = 32 << 20  # of texts that are scored side by side: few steps are spent on a long text alone
ENCODE_BYTES = 2 << 20  # of texts whose words are held at once
AVERAGERS = 8
HELD_OUT_OF, HELD_OUT = 7, 2
END_WORD = int(mix64(np.array([0xE0D], np.uint64)).view(np.int64)[0])  # stands for the end token
END, OTHER = 0, 1  # ids of the network


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text (null: empty) leaves HELD_OUT when divided by HELD_OUT_OF."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(HELD_OUT_OF)) == HELD_OUT


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, count) of all words of ``texts`` (text) and of one end each; words as 64-bit hashes."""

    def run(batches):
        for batch in batches:
            found = [batch_words(part).hash for _, part in slices(batch.column(0))]
            words, counts = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.uint64), [])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(as_long(words), END_WORD)), pa.array(np.append(counts, batch.num_rows).astype(np.int64))],
                ["word", "n"])

    return texts.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("count"))


def _by_bits(words: np.ndarray) -> tuple[np.ndarray, int]:
    """For each value of the leading bits of sorted hashes, the first place that may hold it, and the
    number of the bits that are not read: about a quarter of the values occur."""
    bits = max(1, (2 * len(words)).bit_length())
    counts = np.bincount((words >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return (np.cumsum(counts) - counts).astype(np.int32), 64 - bits


class _Table:
    """Lookups in the broadcast table of frequent words; place -1 has no word, no count and the id OTHER."""

    def __init__(self, shared: dict):
        self.words, (self.starts, self.shift) = shared["words"], shared["starts"]
        self.logs, self.ids = np.append(shared["logs"], 0.0), np.append(shared["ids"], np.int32(OTHER))

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each hash in the table, or -1."""
        if not len(self.words):
            return np.full(len(hashes), -1)
        last = len(self.words) - 1
        at = np.minimum(self.starts[hashes >> np.uint64(self.shift)], last)
        found = self.words[at]
        behind = np.flatnonzero((found < hashes) & (at < last))
        while len(behind):  # words with equal leading bits
            at[behind] += 1
            found[behind] = self.words[at[behind]]
            behind = behind[(found[behind] < hashes[behind]) & (at[behind] < last)]
        return np.where(found == hashes, at, -1)


def _encoded(column: pa.Array, table: _Table):
    """(words, places, ids with ends, first id of each text) of a part of a column."""
    words = batch_words(column)
    place = table(words.hash)
    ids = table.ids[place]
    counts = np.diff(words.first)
    first = np.concatenate([[0], np.cumsum(counts + 1)]).astype(np.int64)
    out = np.full(first[-1], END, np.int32)
    inside = np.ones(first[-1], bool)
    inside[first[1:] - 1] = False
    out[inside] = ids
    return words, place, out, first


def _gathered(batches, table: _Table):
    """(ids with ends, first id of each text) of all rows of a task, about TRAIN_TOKENS at a time."""
    parts, sizes, tokens = [], [], 0
    for batch in batches:
        for _, part in slices(batch.column(0), ENCODE_BYTES):
            _, _, ids, first = _encoded(part, table)
            parts.append(ids), sizes.append(np.diff(first))
            tokens += len(ids)
            if tokens >= TRAIN_TOKENS:
                yield np.concatenate(parts), np.append(0, np.cumsum(np.concatenate(sizes)))
                parts, sizes, tokens = [], [], 0
    if tokens:
        yield np.concatenate(parts), np.append(0, np.cumsum(np.concatenate(sizes)))


def _table(counts: DataFrame) -> tuple[dict, dict]:
    """The broadcast table and the totals; at most FREQUENT + 1 rows reach the driver."""
    totals = counts.agg(F.sum("count").alias("n"), F.count("*").alias("v")).first()
    n, v = int(totals["n"] or 0), int(totals["v"])
    top = counts.orderBy(F.desc("count"), "word").limit(FREQUENT).collect()
    end = counts.where(F.col("word") == END_WORD).select("count").first()
    rows = [(r["word"], r["count"]) for r in top if r["word"] != END_WORD]
    words = np.array([w for w, _ in rows], np.int64).view(np.uint64)
    number = np.array([c for _, c in rows], np.int64)
    ids = np.full(len(rows), OTHER, np.int32)
    known = min(len(rows), VOCABULARY - 2)
    ids[:known] = np.arange(2, 2 + known)
    order = np.argsort(words, kind="stable")
    ends = int(end["count"]) if end is not None else 0
    rest = n - ends - int(number[:known].sum())
    words = words[order]
    shared = {"words": words, "starts": _by_bits(words), "logs": np.log10(number[order] + 1.0), "ids": ids[order]}
    unigram = np.concatenate([[ends, max(rest, 0)], number[:known]]).astype(np.float64)
    sizes = {"n": n, "v": v, "ends": ends, "rest": rest, "rest_words": v - (1 if ends else 0) - known, "unigram": unigram}
    return shared, sizes


def _train_pass(texts: DataFrame, shared, model: dict) -> dict:
    """The average of the copies that tasks train from ``model``, by tokens."""
    spark = texts.sparkSession
    start = spark.sparkContext.broadcast(model)

    def learn(batches):
        own, memory, tokens = {k: v.copy() for k, v in start.value.items()}, None, 0
        for ids, first in _gathered(batches, _Table(shared.value)):
            own, memory = train(own, ids, first, END, memory, lanes=min(256, max(16, len(first) // 16)))
            tokens += len(ids)
        if tokens:
            yield pa.RecordBatch.from_arrays(
                [pa.array([tokens], pa.int64()), pa.array([pack(own).astype(np.float32).tobytes()], pa.binary())], ["tokens", "weights"])

    def average(batches):
        total, tokens = None, 0
        for batch in batches:
            for n, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                flat = np.frombuffer(blob, np.float32).astype(np.float64) * n
                total, tokens = (flat if total is None else total + flat), tokens + n
        if tokens:
            yield pa.RecordBatch.from_arrays(
                [pa.array([tokens], pa.int64()), pa.array([(total / tokens).astype(np.float32).tobytes()], pa.binary())], ["tokens", "weights"])

    schema = "tokens long, weights binary"
    rows = texts.select("text").mapInArrow(learn, schema).repartition(AVERAGERS).mapInArrow(average, schema).collect()
    start.unpersist()
    if not rows:
        return model
    rows.sort(key=lambda r: (r["tokens"], r["weights"]))
    tokens = sum(r["tokens"] for r in rows)
    flat = sum(np.frombuffer(r["weights"], np.float32).astype(np.float64) * (r["tokens"] / tokens) for r in rows)
    return unpack(model, flat)


def _row_key(ids: list, offsets: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """A 64-bit key of (id, text) for each row; equal rows have equal keys and equal scores."""
    codes = np.array([zlib.crc32(raw[a:b]) | (zlib.adler32(raw[a:b]) << 32) for a, b in zip(offsets[:-1], offsets[1:])], np.uint64)
    named = np.array([0 if i is None else (i * 2 + 1) & ((1 << 64) - 1) for i in ids], np.uint64)
    with np.errstate(over="ignore"):
        return as_long(mix64(codes + mix64(named)))


def score_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the rows that are not held out; scores are log10 probabilities of whole texts, end
    included. Null texts are empty (one end); words are lower-cased in A-Z. Equal rows get equal
    scores; null ids hash as empty text. With nothing to learn from, all words are unseen and the
    untrained network scores. An empty table gives an empty result; other columns are not read."""
    spark = docs.sparkSession
    source = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text_column}`").alias("text"),
        held_out(F.col(f"`{id_column}`")).alias("held"))
    learning = source.where(~F.col("held"))
    counts = materialize(word_counts(learning), "lm-counts")
    table, sizes = _table(counts)
    shared = spark.sparkContext.broadcast(table)
    model = new_model(sizes["unigram"])
    model = _train_pass(learning, shared, model)
    network = spark.sparkContext.broadcast({k: model[k] for k in [*PARAMETERS, "class"]})
    end_log = math.log10(sizes["ends"] + 1)

    def scored(waiting):
        """The rows of parts that were encoded one by one; the network reads all their texts side by side."""
        sizes = np.concatenate([size for _, _, size in waiting])
        network_score = score(network.value, np.concatenate([ids for _, ids, _ in waiting]), np.append(0, np.cumsum(sizes)), END)
        end = 0
        for columns, _, size in waiting:
            start, end = end, end + len(size)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(network_score[start:end] / math.log(10))], names)

    def measure(batches):
        lookup = _Table(shared.value)
        waiting, held_bytes = [], 0
        for batch in batches:
            for at, part in slices(batch.column(1), ENCODE_BYTES):
                words, place, ids, first = _encoded(part, lookup)
                counted = lookup.logs[place]
                other = lookup.ids[place] == OTHER
                doc = np.repeat(np.arange(len(part)), np.diff(words.first))

                def by_doc(values, doc=doc, size=len(part)):
                    return np.bincount(doc, values, size)

                named, (offsets, raw) = batch.column(0).slice(at, len(part)), text_buffers(part)
                waiting.append(([
                    named, pa.array(_row_key(named.to_pylist(), offsets, raw)), batch.column(2).slice(at, len(part)),
                    pa.array(np.diff(first)), pa.array(by_doc(place >= 0).astype(np.int64)),
                    pa.array(by_doc(counted) + end_log), pa.array(by_doc(np.where(other, counted, 0.0))),
                    pa.array(by_doc(other).astype(np.int64)),
                ], ids, np.diff(first)))
                held_bytes += int(offsets[-1] - offsets[0])
                if held_bytes >= SCORE_BYTES:
                    yield from scored(waiting)
                    waiting, held_bytes = [], 0
        if waiting:
            yield from scored(waiting)

    names = ["id", "key", "held", "n_tokens", "frequent", "counted", "other_counted", "n_other", "network"]
    measured = materialize(source.mapInArrow(
        measure, "id long, key long, held boolean, n_tokens long, frequent long, counted double, other_counted double, n_other long, network double"),
        "lm-measured")

    def tail(batches):
        lookup = _Table(shared.value)
        for batch in batches:
            for at, part in slices(batch.column(1)):
                words = batch_words(part)
                rare = np.flatnonzero(lookup(words.hash) < 0)
                if not len(rare):
                    continue
                keys = _row_key(batch.column(0).slice(at, len(part)).to_pylist(), *text_buffers(part))
                doc = np.searchsorted(words.first, rare, "right") - 1
                hashes = words.hash[rare]
                order = np.lexsort((hashes, doc))
                doc, hashes = doc[order], hashes[order]
                new = np.ones(len(doc), bool)
                new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
                starts = np.flatnonzero(new)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(as_long(hashes[starts])), pa.array(keys[doc[starts]]),
                     pa.array(np.diff(np.append(starts, len(doc))).astype(np.int32))], ["word", "key", "times"])

    rare = source.select("id", "text").mapInArrow(tail, "word long, key long, times int")
    sums = rare.join(counts, "word", "left").groupBy("key").agg(  # of all rows with a key
        F.sum(F.col("times") * F.log10(F.coalesce("count", F.lit(0)) + 1)).alias("tail"),
        F.sum(F.when(F.col("count") > 0, F.col("times")).otherwise(0)).alias("tail_known"))
    copies = F.count("*").over(Window.partitionBy("key"))
    rows = measured.withColumn("copies", copies).join(sums, "key", "left")
    base_log = math.log10(sizes["n"] + sizes["v"] + 1)
    other_log = math.log10(max(sizes["rest"], 0) + max(sizes["rest_words"], 0) + 1)
    tail_sum = F.coalesce(F.col("tail") / F.col("copies"), F.lit(0.0))
    tail_known = F.coalesce(F.col("tail_known") / F.col("copies"), F.lit(0))
    end_known = 1 if sizes["ends"] else 0
    return rows.select(
        F.col("id").alias(id_column),
        F.col("held").alias("held_out"),
        "n_tokens",
        (F.col("frequent") + end_known + tail_known).cast("long").alias("n_known"),
        F.lit(sizes["n"]).cast("long").alias("train_tokens"),
        (F.col("counted") + tail_sum - F.col("n_tokens") * base_log).alias("base_score"),
        (F.col("network") + F.col("other_counted") + tail_sum - F.col("n_other") * other_log).alias("score"),
    )
