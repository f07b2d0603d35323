"""Compaction of an ingest's ledger: bounded pieces, the same totals wherever it stops."""

import os
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from foldline.sinks import save_table, versions
from foldline.sources import attach_table, read_table
from foldline.streaming import ledger, read_ingested, start_ingest

QUERY = "11111111-2222-3333-4444-555555555555"


@pytest.fixture()
def place(spark, tmp_dir):
    return f"led_{uuid.uuid4().hex[:8]}", "t", tmp_dir


def _batch(spark, place, number, values):
    database, table, warehouse = place
    rows = spark.createDataFrame(list(Counter(values).items()), "v string, occurrences long")
    save_table(
        rows.withColumns({"query_id": F.lit(QUERY), "batch_id": F.lit(number).cast("long")}),
        database, table, warehouse_dir=warehouse, partition_columns=["query_id", "batch_id"])


def _totals(spark, place):
    return {r["v"]: r["occurrences"] for r in read_ingested(spark, *place[:2]).collect()}


def _pieces(place):
    base = f"{place[2]}/{place[0]}.db/{place[1]}"
    segments = f"{base}/{ledger.SEGMENTS}"
    live = [n for n in os.listdir(f"{base}/query_id={QUERY}") if n.startswith("batch_id=")]
    return live, [n for n in os.listdir(segments) if n.startswith("s-")] if os.path.isdir(segments) else []


def _manifest(spark, place):
    return ledger._manifest(spark, f"{place[2]}/{place[0]}.db/{place[1]}")[1]


def test_many_batches_leave_few_pieces(spark, place):
    expected = Counter()
    for n in range(14):
        values = ["a", f"v{n % 5}", f"only{n}"]
        expected.update(values)
        _batch(spark, place, n, values)
        ledger.compact_ledger(spark, *place[:2], QUERY, n - 1, 3)
        live, folders = _pieces(place)
        assert len(live) <= 8 and len(folders) <= 9
    levels = Counter(s["level"] for s in _manifest(spark, place)["segments"])
    assert max(levels) == 2 and max(levels.values()) < 3
    assert _totals(spark, place) == expected
    # another process finds the same
    spark.sql(f"DROP TABLE {place[0]}.{place[1]}")
    attach_table(spark, *place)
    assert _totals(spark, place) == expected


@pytest.mark.parametrize("stop", ["write", "pointer", "clear"])
def test_a_stop_in_the_middle_changes_no_total(spark, place, monkeypatch, stop):
    expected = Counter()
    for n in range(5):
        expected.update(["a", f"b{n}"])
        _batch(spark, place, n, ["a", f"b{n}"])

    def dies(*arguments, **named):
        raise KeyboardInterrupt

    target, name = {"write": (versions, "advance"), "pointer": (ledger, "_clear"), "clear": (versions, "forget")}[stop]
    for start in (0, 1):
        real = getattr(target, name)
        monkeypatch.setattr(target, name, dies)
        with pytest.raises(KeyboardInterrupt):
            ledger.compact_ledger(spark, *place[:2], QUERY, 3, 2)
        monkeypatch.setattr(target, name, real)
        assert _totals(spark, place) == expected
        _batch(spark, place, 4, ["a", "b4"])  # the last batch is retried: its partition is replaced
        assert _totals(spark, place) == expected
        if stop != "write":
            break
    for n in range(5, 11):
        expected.update(["c"])
        _batch(spark, place, n, ["c"])
        ledger.compact_ledger(spark, *place[:2], QUERY, n - 1, 2)
        assert _totals(spark, place) == expected
    live, folders = _pieces(place)
    assert len(live) <= 6 and len(folders) <= 6


def test_a_reader_that_has_planned_still_finds_its_files(spark, place):
    for n in range(4):
        _batch(spark, place, n, ["a"])
    planned = read_ingested(spark, *place[:2])
    ledger.compact_ledger(spark, *place[:2], QUERY, 2, 3)
    assert [tuple(r) for r in planned.collect()] == [("a", 4)] == [tuple(r) for r in read_ingested(spark, *place[:2]).collect()]


def test_two_compactors(spark, place, monkeypatch):
    """Of two drivers on one ledger, the manifest of the first to commit holds."""
    for n in range(4):
        _batch(spark, place, n, ["a"])
    advance = versions.advance

    def late(*arguments):
        monkeypatch.setattr(versions, "advance", advance)
        assert ledger.compact_ledger(spark, *place[:2], QUERY, 2, 3)
        return advance(*arguments)

    monkeypatch.setattr(versions, "advance", late)
    assert not ledger.compact_ledger(spark, *place[:2], QUERY, 2, 3)
    assert _totals(spark, place) == {"a": 4} and len(_pieces(place)[1]) == 1


def test_stream_compacts_and_restarts(spark, tmp_dir):
    database = f"led_{uuid.uuid4().hex[:8]}"
    expected = Counter()

    def run(first, files):
        for i in range(first, first + files):
            values = ["x", f"y{i % 3}"]
            expected.update(values)
            spark.createDataFrame([(v,) for v in values], "v string").coalesce(1).write.mode("append").csv(f"{tmp_dir}/in")
        query = start_ingest(
            spark, f"{tmp_dir}/in", "v string", database, "t", f"{tmp_dir}/cp", warehouse_dir=f"{tmp_dir}/wh",
            read_options={"header": False}, available_now=True, max_files_per_trigger=1, output="ledger", compact_every=2)
        query.awaitTermination()
        assert query.exception() is None

    run(0, 5)
    assert {r["v"]: r["occurrences"] for r in read_ingested(spark, database, "t").collect()} == expected
    run(5, 4)
    assert {r["v"]: r["occurrences"] for r in read_ingested(spark, database, "t").collect()} == expected
    assert read_table(spark, database, "t").select("batch_id").distinct().count() <= 6
    with pytest.raises(ValueError):
        start_ingest(spark, f"{tmp_dir}/in", "v string", database, "t", f"{tmp_dir}/cp", compact_every=1)
