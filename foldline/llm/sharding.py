"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``vnodes`` points of a ring; a key belongs to the shard whose point ends the arc
it falls in. Loads are bounded by the number of rows: a shard takes its capacity (row counts at
most one apart, the sum of capacities is the number of rows) and keys that overflow a full shard
continue clockwise to the next shard with room. Equal texts have one ring position, so copies stay
together except where a shard is full.

Only arc counts (shards * vnodes of them, whatever the data) go to the driver, which walks the ring
and returns segments: rows from..to of an arc go to a shard from a slot on. A row's place in its arc
comes from two levels: counts of (ring cell, hash cell of the id), then a row number inside one such
group, so a text that fills a third of the table is spread over many groups.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize
from .mixing import KEY_BITS, hash_key

SHARDS = 40
VNODES = 64
CELL_BITS = 16
SUB_BITS = 10


def ring(shards: int, vnodes: int = VNODES) -> list[tuple[int, int]]:
    """(first cell after the arc, shard) clockwise: arc i holds the cells below ring[i][0] and not
    below ring[i - 1][0]; cells after the last point belong to arc 0."""
    points = []
    for shard in range(shards):
        for v in range(vnodes):
            digest = hashlib.md5(f"ring:{shard}:{v}".encode()).digest()
            points.append((int.from_bytes(digest[:8], "big") >> (64 - CELL_BITS), shard, v))
    return [(cell, shard) for cell, shard, _ in sorted(points)]


def place_arcs(counts: list[int], owners: list[int], capacity: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Segments (arc, from, to, shard, first slot) of the clockwise walk.

    First every arc fills its own shard, in ring order; what overflows then moves one arc further
    clockwise at a time. Each step ends an arc or fills a shard: at most arcs + shards segments."""
    free, used = list(capacity), [0] * len(capacity)
    segments, waiting = [], [(a, 0) for a in range(len(counts)) if counts[a]]
    hop = 0
    while waiting:
        rest = []
        for arc, done in waiting:
            shard = owners[(arc + hop) % len(owners)]
            fits = min(free[shard], counts[arc] - done)
            if fits:
                segments.append((arc, done, done + fits, shard, used[shard]))
                free[shard] -= fits
                used[shard] += fits
                done += fits
            if done < counts[arc]:
                rest.append((arc, done))
        waiting, hop = rest, hop + 1
    return segments


def bounded_ring(rows: DataFrame, position: Column, order: Column, shards: int = SHARDS, vnodes: int = VNODES) -> DataFrame:
    """``rows`` with shard and slot (int, long). ``position`` and ``order`` are 60-bit hash keys:
    the place on the ring, and the order of rows at one place."""
    names = rows.columns
    keyed = rows.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), position.alias("_pos"), order.alias("_order"))
    keyed = keyed.withColumn("_cell", F.shiftright("_pos", KEY_BITS - CELL_BITS).cast("int")).withColumn(
        "_sub", F.shiftright("_order", KEY_BITS - SUB_BITS).cast("int"))
    points = ring(shards, vnodes)
    # arc of a cell: the number of ring points at or below it, back to 0 after the last
    cells = [cell for cell, _ in points]
    spark = rows.sparkSession
    arcs, arc = [], 0
    for cell in range(1 << CELL_BITS):
        while arc < len(cells) and cells[arc] <= cell:
            arc += 1
        arcs.append((cell, arc % len(cells)))
    # 2 ** CELL_BITS rows, fixed by the parameter
    arc_table = F.broadcast(spark.createDataFrame(arcs, "_cell int, _arc int"))
    counts = materialize(keyed.groupBy("_cell", "_sub").count(), "ring-counts").join(arc_table, "_cell")
    totals = [0] * len(points)
    for row in counts.groupBy("_arc").agg(F.sum("count").alias("n")).collect():  # at most shards * vnodes
        totals[row["_arc"]] = row["n"]
    whole = sum(totals)
    capacity = [whole // shards + (1 if s < whole % shards else 0) for s in range(shards)]
    segments = place_arcs(totals, [shard for _, shard in points], capacity)
    wrapped = F.when(F.col("_cell") >= points[-1][0], F.lit(0)).otherwise(F.lit(1))  # arc 0 starts before cell 0
    before = F.sum("count").over(
        Window.partitionBy("_arc").orderBy(wrapped, "_cell", "_sub").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("_cell", "_sub", "_arc", F.coalesce(before, F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_cell", "_sub").orderBy("_pos", "_order"))
    ranked = keyed.withColumn("_inside", inside).join(offsets, ["_cell", "_sub"])
    ranked = ranked.select("_row", "_arc", (F.col("_before") + F.col("_inside") - 1).alias("_rank"))
    # at most shards * vnodes + shards rows, fixed by the parameters
    table = F.broadcast(spark.createDataFrame(
        segments, "_seg int, _from long, _to long, shard int, _slot long"))
    placed = ranked.join(table, (F.col("_arc") == F.col("_seg")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")))
    kept = [F.col("_row")[c].alias(c) for c in names if c not in ("shard", "slot")]
    return placed.select(*kept, "shard", (F.col("_slot") + F.col("_rank") - F.col("_from")).alias("slot"))


def shard_documents(
    docs: DataFrame, shards: int = SHARDS, id_column: str = "doc_id", text_column: str = "text", vnodes: int = VNODES,
) -> DataFrame:
    """``docs`` with shard (0 to shards - 1) and slot (gapless from 0 within a shard).

    Every row gets one place; row counts of shards differ by one at most, and no row is lost, also
    with fewer rows than shards. Null and empty texts share a ring position, null ids are hashed as
    empty; equal rows get different slots, in any order among them. An empty table gives an empty
    result. Columns named shard or slot are replaced, all others stay."""
    text = F.md5(F.coalesce(F.col(f"`{text_column}`"), F.lit("")))
    return bounded_ring(docs, hash_key("place", text), hash_key("order", F.col(f"`{id_column}`"), text), shards, vnodes)


def shard_report(docs: DataFrame, shards: int = SHARDS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One narrow row per row of ``docs``: id, size, text_crc32, law, shard, slot, grown_shard."""
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    narrow = docs.select(
        F.col(f"`{id_column}`").alias(id_column),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        hash_key("place", F.md5(text)).alias("_place"),
        hash_key("order", F.col(f"`{id_column}`"), F.md5(text)).alias("_tie"),
    )
    narrow = materialize(narrow, "ring-rows")
    placed = bounded_ring(narrow, F.col("_place"), F.col("_tie"), shards)
    return placed.select(id_column, "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
