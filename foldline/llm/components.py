"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize

ROWS_A_PART = 1 << 16
LEAST_PARTS = 4


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) for every vertex of ``edges`` (columns a, b: long, a != b, not null).

    ``component`` is the smallest vertex id reachable. Each round moves every neighbour of a
    vertex to the smallest neighbour (larger ones first, then smaller ones); the rounds stop when
    each remaining edge points from a vertex to its component, after about log(diameter) rounds; edges
    that are stars from the start need none. A hub with very many neighbours is reduced by a partial
    minimum before its rows move, and each round is written to the shared folder, so lost executors
    cost one round at most. The parts written follow the number of edges, not that of shuffle
    partitions; for that, ``edges`` are read twice.
    """
    parts = _parts(edges)
    current = materialize(_oriented(edges).coalesce(parts), "components")
    while not _are_stars(current):
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        moved = _star(_star(both, larger=True), larger=False)
        before, current = current, materialize(_oriented(moved).coalesce(parts), "components")
        discard(before)
    roots = current.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("id"), F.col("b").alias("component")).union(roots)


def join_components(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (id, component) with the components joined that ``links`` (a, b) connect; ids that had
    no label are components of their own. Only links between components are followed. ``links`` are read
    twice, to be counted and to be joined."""
    ends = links
    for end in ("a", "b"):
        named = labels.select(F.col("id").alias(end), F.col("component").alias(f"{end}_component"))
        ends = ends.join(named, end, "left").withColumn(f"{end}_component", F.coalesce(f"{end}_component", end))
    ends = materialize(ends.coalesce(_parts(links)), "components-ends")
    bridges = ends.select(F.col("a_component").alias("a"), F.col("b_component").alias("b")).where("a <> b")
    moved = connected_components(bridges).select(F.col("id").alias("component"), F.col("component").alias("joined"))
    known = labels.union(ends.select("a", "a_component")).union(ends.select("b", "b_component")).distinct()
    return known.join(moved, "component", "left").select("id", F.coalesce("joined", "component").alias("component"))


def _parts(rows: DataFrame) -> int:
    """Into how many parts to write about as many rows of a few numbers."""
    return max(LEAST_PARTS, -(-rows.count() // ROWS_A_PART))


def _are_stars(edges: DataFrame) -> bool:
    """Whether every vertex with an edge to a smaller one has one such edge, to a vertex without any."""
    ends = edges.select(F.col("a").alias("v"), F.lit(1).alias("down"), F.lit(0).alias("up")).union(
        edges.select("b", F.lit(0), F.lit(1)))
    return ends.groupBy("v").agg(F.sum("down").alias("down"), F.max("up").alias("up")).where(
        "down > 1 OR (down > 0 AND up > 0)").isEmpty()


def _oriented(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger to the smaller end."""
    return (
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """One contraction; at most one row for each edge and one for each vertex, repeats included."""
    lowest = edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    joined = edges.join(lowest, "a")
    if larger:  # neighbours above the vertex move to its minimum; the vertex itself as well
        moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:  # edges already point downwards
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = lowest.where("m <> a").select("a", F.col("m").alias("b"))
    return moved.union(own).where("a <> b")
