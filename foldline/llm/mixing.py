"""Mixing sources to target weights by weighted fair queueing.

Every source is a flow whose documents, shuffled by hash, may be sent up to ``max_repeats`` times.
A document's virtual finish time is the source's tokens sent up to and including it, divided by the
source's target. Documents of all sources are then ordered by virtual finish time and cut where the
total budget is used up, so each source gets its target up to about one document.

Nothing is sorted in one place. Within a source, the shuffled order is cut into hash ranges of
about a thousand rows: range sums give offsets, and only rows of one range are cumulated together.
The global order is cut into equal ranges of virtual time in the same way; only the range in which
the budget runs out is looked at row by row. What remains is, per source and repetition, the last
hash that is taken, so the decision needs no join of documents and no shuffle of their texts.

Rows of equal source, id and text have one hash. They are counted, and their copies from the first on
get hashes of their own, spread over the whole order: a row that is a third of the table neither
goes at once nor into one range. Only such rows are numbered, from counts by key and partition.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
RANGE_ROWS = 1000
KEY_BITS = 60
SPACE = " \t\n\x0b\x0c\r"


def word_count(text: Column) -> Column:
    """Number of maximal runs outside [\\x20\\x09-\\x0D]; 0 for null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    words = F.size(F.split(trimmed, r"[\x20\x09-\x0D]+"))
    return F.when(trimmed == "", F.lit(0)).otherwise(words).cast("long")


def hash_key(seed: str, *parts: Column) -> Column:
    """60 bits of the md5 of the seed and the parts (null as empty), as a non-negative long."""
    texts = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), *texts)), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int], max_repeats: int) -> DataFrame:
    """``sizes`` (source, source_size, one row a source) with rank, weight and target.

    Sources by code point, null last, take the weights in turn and share the sum of all sizes;
    a target stops at ``max_repeats`` times its source's size and the excess is shared by weight
    among the others. With sources ordered by limit / weight, those that stop are a prefix."""
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))))
    ranked = (
        ranked.withColumn("weight", F.get(F.array(*map(F.lit, weights)), F.pmod(F.col("rank") - 1, F.lit(len(weights)))))
        .withColumn("limit", F.col("source_size") * max_repeats)
        .withColumn("total", F.sum("source_size").over(Window.partitionBy()))
    )
    order = Window.orderBy(F.col("limit") / F.col("weight"), "rank")
    before = F.coalesce(F.sum("limit").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    later = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    ranked = ranked.withColumn("level", (F.col("total") - before) / later)
    ranked = ranked.withColumn("stops", F.col("limit") < F.col("weight") * F.col("level"))
    place = F.row_number().over(order)
    ranked = ranked.withColumn("open", F.when(~F.col("stops"), F.struct(place.alias("p"), F.col("level").alias("v"))))
    level = F.min("open").over(Window.partitionBy())["v"]
    target = F.when(F.col("stops") | level.isNull(), F.col("limit").cast("double")).otherwise(F.col("weight") * level)
    return ranked.withColumn("target", target).select("source", "source_size", "rank", "weight", "target", "total")


def mix_plan(rows: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, target, last_keys) per source: repetition e of a row is taken if its
    key is not above ``last_keys[e]``. ``rows``: source, size and key (a written, narrow table)."""
    count = rows.count()
    bits = min(40, max(0, math.ceil(math.log2(max(1, count / RANGE_ROWS)))))
    sizes = rows.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    targets = materialize(source_targets(sizes, weights, max_repeats), "mix-targets")
    named = targets.withColumnRenamed("source", "s")
    queued = rows.join(named, F.col("source").eqNullSafe(F.col("s")))
    queued = queued.withColumn("part", F.shiftright("key", KEY_BITS - bits))
    sums = queued.groupBy("rank", "part").agg(F.sum("size").alias("part_size"))
    offset = F.sum("part_size").over(Window.partitionBy("rank").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select("rank", "part", F.coalesce(offset, F.lit(0)).alias("offset"))
    inside = F.sum("size").over(Window.partitionBy("rank", "part").orderBy("key"))
    queued = queued.withColumn("inside", inside).join(sums, ["rank", "part"])
    queued = queued.select(
        "rank", "key", "size", "source_size", "target", "total", (F.col("offset") + F.col("inside")).alias("sent"))
    queued = materialize(queued, "mix-queue")
    finish = (F.col("round") * F.col("source_size") + F.col("sent")) / F.col("target")
    stream = queued.withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1))))
    # without words a source's target is 0; such rows carry no tokens and stay out of the mix
    stream = stream.where("target > 0").withColumn("finish", finish)
    stream = stream.withColumn("span", F.floor(F.col("finish") * (1 << bits)))
    spans = stream.groupBy("span").agg(F.sum("size").alias("n"), F.max("total").alias("total"))
    spans = spans.withColumn("upto", F.sum("n").over(Window.orderBy("span")))
    edge = spans.where("upto > total").agg(F.min(F.struct("span", (F.col("upto") - F.col("n")).alias("before"), "total")).alias("e")).first()["e"]
    taken = F.lit(True)
    if edge is not None:
        order = Window.orderBy("finish", "rank", "key")  # one span: about max_repeats * RANGE_ROWS rows
        last = (
            stream.where(F.col("span") == edge["span"]).withColumn("upto", F.sum("size").over(order))
            .where(F.col("upto") + edge["before"] <= edge["total"])
            .agg(F.max(F.struct("finish", "rank", "key")).alias("m")).first()["m"]
        )
        taken = F.col("span") < edge["span"]
        if last is not None:
            cut = F.struct(F.lit(last["finish"]).alias("finish"), F.lit(last["rank"]).alias("rank"), F.lit(last["key"]).alias("key"))
            taken = taken | ((F.col("span") == edge["span"]) & (F.struct("finish", "rank", "key") <= cut))
    keys = [F.max(F.when((F.col("round") == e) & taken, F.col("key"))).alias(f"k{e}") for e in range(max_repeats)]
    lasts = stream.groupBy("rank").agg(*keys).select("rank", F.array(*[f"k{e}" for e in range(max_repeats)]).alias("last_keys"))
    return materialize(targets.join(lasts, "rank", "left"), "mix-plan").select("source", "source_size", "target", "last_keys")


def _copies(key: str) -> Column:
    return F.size(F.filter(F.coalesce("last_keys", F.array().cast("array<bigint>")), lambda k: F.coalesce(F.col(key) <= k, F.lit(False))))


def _keyed(docs: DataFrame, id_column: str, text_column: str, source_column: str, seed: str) -> list[Column]:
    text = F.col(f"`{text_column}`")
    return [
        F.col(f"`{source_column}`").alias("source"),
        word_count(text).alias("size"),
        hash_key(seed, F.col(f"`{id_column}`"), F.md5(F.coalesce(text, F.lit("")))).alias("key"),
    ]


COPIES_TOGETHER = 1000


def _copy_key(key: str, copy: str) -> Column:
    return hash_key("copy", F.col(key), F.col(copy))


def _repeated(narrow: DataFrame, *also: str) -> DataFrame:
    """(source, key, size, n) and the columns ``also`` of rows of ``narrow`` that are there n > 1 times, written."""
    counted = narrow.groupBy("source", "key").agg(F.count("*").alias("n"), F.max("size").alias("size"), *[F.max(c).alias(c) for c in also])
    return materialize(counted.where("n > 1"), "mix-repeated")


def _same(left: DataFrame, right: DataFrame) -> Column:
    return left["source"].eqNullSafe(right["source"]) & (left["key"] == right["key"])


def _singled(narrow: DataFrame, repeated: DataFrame, *also: str) -> DataFrame:
    """``narrow`` with a key of its own for each copy of the repeated rows."""
    if repeated.isEmpty():
        return narrow
    chunks = F.sequence(F.lit(0), F.floor((F.col("n") - 1) / COPIES_TOGETHER))
    chunked = repeated.withColumn("chunk", F.explode(chunks)).repartition("key", "chunk")  # a hot row's copies are dealt out
    first = F.col("chunk") * COPIES_TOGETHER
    copies = chunked.withColumn("copy", F.explode(F.sequence(first, F.least(first + COPIES_TOGETHER, F.col("n")) - 1)))
    copies = copies.withColumn("key", _copy_key("key", "copy"))
    names = ["source", "size", "key", *also]
    return narrow.join(repeated, _same(narrow, repeated), "left_anti").select(*names).union(copies.select(*names))


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` (_row, source, size, key, and ``_place``, a monotonically increasing id; written) with
    ``copy``: 0, 1, ... among equal source and key, from counts by partition; a window sees what one
    task wrote of a key."""
    rows = rows.withColumn("_part", F.shiftright("_place", 33))
    counts = rows.groupBy("source", "key", "_part").count()
    before = Window.partitionBy("source", "key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        F.col("source").alias("_s"), F.col("key").alias("_k"), F.col("_part").alias("_p"),
        F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("source", "key", "_part").orderBy("_place")) - 1
    same = F.col("source").eqNullSafe(F.col("_s")) & (F.col("key") == F.col("_k")) & (F.col("_part") == F.col("_p"))
    joined = rows.withColumn("_own", own).join(counts, same)
    return joined.withColumn("copy", F.col("_before") + F.col("_own")).select("_row", "source", "size", "key", "copy")


def mix_report(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS, seed: str = "mix",
    id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
) -> DataFrame:
    """One row per row of ``docs``: id, size, source_size, target, taken (words, repeats counted).

    Null texts have size 0; a null source is a source of its own, last in order; null ids are
    hashed with their text. Repeated rows are taken one by one, so a source of equal rows comes near
    its target as well. An empty table gives an empty result; other columns are not read. Reruns agree.
    """
    narrow = docs.select(F.col(f"`{id_column}`").alias("id"), *_keyed(docs, id_column, text_column, source_column, seed))
    narrow = materialize(narrow, "mix-rows")
    rows = _singled(narrow, _repeated(narrow, "id"), "id")
    plan = mix_plan(rows.select("source", "size", "key"), weights, max_repeats).withColumnRenamed("source", "s")
    return rows.join(plan, F.col("source").eqNullSafe(F.col("s"))).select(
        F.col("id").alias(id_column), "size", "source_size", "target", (F.col("size") * _copies("key")).cast("long").alias("taken"))


def mix_documents(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS, seed: str = "mix",
    id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
) -> DataFrame:
    """The mixed rows, with the columns of ``docs``: each row as often as the mix takes it (not at
    all, or up to ``max_repeats`` times). Rows without words are never taken.

    Nulls are treated as in ``mix_report``; of rows with equal source, id and text, which may differ in
    other columns, as many are taken as there. An empty table gives an empty result; columns of
    any other names come back as they are."""
    keyed = _keyed(docs, id_column, text_column, source_column, seed)
    narrow = materialize(docs.select(*keyed), "mix-rows")
    repeated = _repeated(narrow)
    plan = mix_plan(_singled(narrow, repeated), weights, max_repeats)
    plan = plan.select(F.col("source").alias("_s"), "last_keys")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *keyed)
    if not repeated.isEmpty():
        copies = packed.join(repeated.select("source", "key"), _same(packed, repeated), "left_semi")
        copies = materialize(copies.withColumn("_place", F.monotonically_increasing_id()), "mix-copies")
        copies = _numbered(copies).withColumn("key", _copy_key("key", "copy"))
        packed = packed.join(repeated, _same(packed, repeated), "left_anti").union(copies.select(*packed.columns))
    mixed = packed.join(plan, F.col("source").eqNullSafe(F.col("_s")))
    copies = F.when(F.col("size") > 0, _copies("key")).otherwise(F.lit(0))
    taken = mixed.withColumn("_copies", copies).where("_copies > 0")
    return taken.select("_row", F.explode(F.array_repeat(F.lit(0), F.col("_copies"))).alias("_")).select("_row.*")
