"""Benchmark decontamination: size-partitioned MinHash containment search.

An item is found in a document that contains at least ``threshold`` of the item's distinct 5-word
shingles. Items are partitioned by their number of shingles, [2**p, 2**(p + 1)). An item's sketch
is its bottom-k MinHash values; k is set per partition so that a document lacking the whole sketch
lacks more than ``1 - threshold`` of any item of the partition: k = u - ceil(t u) + 1 for the
partition's upper bound u. A document's size therefore does not matter, unlike with a Jaccard
MinHash, and no containing document is missed. Hits are verified by exact shingle containment.

Items are the query set: they are broadcast in blocks of a bounded number of shingles, and each
block makes one pass over the documents, without a shuffle of their texts.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_long, batch_words, mix64, shingles, slices

THRESHOLD = Fraction(3, 4)
WIDTH = 5
BLOCK_SHINGLES = 2_000_000
_FILTER_BITS = 20


def _item_sets(items: DataFrame, id_column: str, text_column: str) -> DataFrame:
    def run(batches):
        for batch in batches:
            values, first = shingles(batch_words(batch.column(1)), WIDTH)
            sets = [as_long(np.unique(values[a:b])) for a, b in zip(first[:-1], first[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(sets, pa.list_(pa.int64()))],
                ["item_id", "shingles"])

    source = items.select(F.col(id_column).cast("long").alias("item_id"), F.col(text_column).alias("text"))
    return source.mapInArrow(run, "item_id long, shingles array<long>").where("size(shingles) > 0")


def _blocks(items: DataFrame, id_column: str, text_column: str):
    """The items' shingle sets, in blocks of about BLOCK_SHINGLES shingles."""
    sets = _item_sets(items, id_column, text_column)
    total = sets.agg(F.sum(F.size("shingles"))).first()[0] or 0
    count = max(1, math.ceil(total / BLOCK_SHINGLES))
    for block in range(count if total else 0):
        rows = sets.where(F.pmod(F.xxhash64("shingles"), F.lit(count)) == block).collect()
        yield [(r[0], np.array(r[1], np.int64).view(np.uint64)) for r in rows]


def _partition_sketch(values: np.ndarray, threshold: Fraction) -> np.ndarray:
    upper = (1 << len(values).bit_length()) - 1
    k = min(len(values), upper - math.ceil(threshold * upper) + 1)
    return values[np.argsort(mix64(values), kind="stable")[:k]]


def _slot(values):
    return (values >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)


def _index(items, threshold) -> dict:
    """Sketch shingles of one block of items, with a bit filter in front of the sorted lookup."""
    sets = [s for _, s in items]
    sketches = [_partition_sketch(s, threshold) for s in sets]
    values = np.concatenate(sketches)
    owners = np.repeat(np.arange(len(sketches)), [len(s) for s in sketches])
    order = np.argsort(values, kind="stable")
    bits = np.zeros(1 << _FILTER_BITS, bool)
    bits[_slot(values)] = True
    return {"ids": [i for i, _ in items], "sets": sets, "need": [math.ceil(threshold * len(s)) for s in sets],
            "values": values[order], "owners": owners[order], "bits": bits}


def _hits(index: dict, column: pa.Array):
    """(row, item's place in the index, shingles found) for each verified containment."""
    for start, part in slices(column):
        values, first = shingles(batch_words(part), WIDTH)
        maybe = np.flatnonzero(index["bits"][_slot(values)])
        at = np.minimum(np.searchsorted(index["values"], values[maybe]), len(index["values"]) - 1)
        maybe = maybe[index["values"][at] == values[maybe]]
        docs = np.searchsorted(first, maybe, side="right") - 1
        for doc in np.unique(docs):
            found = values[maybe[docs == doc]]
            low = np.searchsorted(index["values"], found, "left")
            high = np.searchsorted(index["values"], found, "right")
            items = np.unique(np.concatenate([index["owners"][a:b] for a, b in zip(low, high)]))
            whole = np.unique(values[first[doc]: first[doc + 1]])
            for item in items:
                wanted = index["sets"][item]
                place = np.minimum(np.searchsorted(whole, wanted), len(whole) - 1)
                count = int((whole[place] == wanted).sum())
                if count >= index["need"][item]:
                    yield start + int(doc), int(item), count


def find_items(
    docs: DataFrame,
    items: DataFrame,
    threshold: Fraction = THRESHOLD,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """(id, item_id, item_shingles, found_shingles) for each document row that contains an item.

    Words are lower-cased in A-Z. An item of one to four words has one shingle, its whole word
    sequence, so only a document of exactly these words contains it; null or wordless items and
    documents match nothing. Repeated rows of either table give a row each; null ids stay null;
    empty tables give an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    schema = f"`{id_column}` long, item_id long, item_shingles long, found_shingles long"
    result = spark.createDataFrame([], schema)
    for block in _blocks(items, item_id_column, item_text_column):
        index = spark.sparkContext.broadcast(_index(block, threshold))

        def run(batches, index=index):
            for batch in batches:
                own = index.value
                rows = list(_hits(own, batch.column(1)))
                ids = batch.column(0).take(pa.array([r[0] for r in rows], pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([own["ids"][r[1]] for r in rows], pa.int64()),
                     pa.array([len(own["sets"][r[1]]) for r in rows], pa.int64()),
                     pa.array([r[2] for r in rows], pa.int64())],
                    [id_column, "item_id", "item_shingles", "found_shingles"])

        result = result.union(source.mapInArrow(run, schema))
    return result


def drop_contaminated(
    docs: DataFrame,
    items: DataFrame,
    threshold: Fraction = THRESHOLD,
    text_column: str = "text",
    item_id_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """``docs`` without the rows that contain an item, as ``find_items`` decides; all columns,
    their order and all other rows (null and empty texts included) stay."""
    spark, result = docs.sparkSession, docs
    place = docs.columns.index(text_column)
    for block in _blocks(items, item_id_column, item_text_column):
        index = spark.sparkContext.broadcast(_index(block, threshold))

        def run(batches, index=index):
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for doc, _, _ in _hits(index.value, batch.column(place)):
                    keep[doc] = False
                yield batch.filter(pa.array(keep))

        result = result.mapInArrow(run, docs.schema)
    return result
