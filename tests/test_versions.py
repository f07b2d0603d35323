"""Tables that several processes write: pointers moved by compare-and-swap."""

import os
import subprocess
import sys
import uuid
from concurrent.futures import ThreadPoolExecutor

import pytest

from foldline.sinks import TableConflict, TableLoadError, save_table, table_location, table_version, tables, versions
from foldline.sources import attach_table, read_table

JOB = os.path.join(os.path.dirname(os.path.abspath(__file__)), "jobs", "table_job.py")


def _db():
    return f"v_{uuid.uuid4().hex[:8]}"


def _ids(spark, database, table="t"):
    return sorted(r[0] for r in read_table(spark, database, table).collect())


def _other_process(*arguments):
    out = subprocess.run([sys.executable, JOB, *arguments], capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    return [int(x) for x in out.stdout.partition("COUNTS")[2].split()]


def test_processes_in_turn_lose_no_row(spark, tmp_dir):
    database = _db()
    save_table(spark.range(10), database, "t", warehouse_dir=tmp_dir)
    assert _other_process(tmp_dir, database, "t", "count", "overwrite:100:3", "append:200:4") == [10]
    assert _ids(spark, database) == [100, 101, 102, 200, 201, 202, 203]
    save_table(spark.range(300, 302), database, "t", warehouse_dir=tmp_dir, mode="append")
    assert _ids(spark, database) == [100, 101, 102, 200, 201, 202, 203, 300, 301]


def test_one_writer_wins_a_number(spark, tmp_dir):
    first = versions.advance(spark, tmp_dir, None, "v-a")
    assert first == versions.current(spark, tmp_dir) == (1, "v-a")
    assert versions.advance(spark, tmp_dir, None, "v-b") is None
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: versions.advance(spark, tmp_dir, first, f"v-{i}"), range(8)))
    winner = [w for w in won if w is not None]
    assert len(winner) == 1 and versions.current(spark, tmp_dir) == winner[0]
    # a writer that slept while its number was taken and removed again does not go back in time
    third = versions.advance(spark, tmp_dir, winner[0], "v-third")
    fourth = versions.advance(spark, tmp_dir, third, "v-fourth")
    versions.delete(spark, versions._file(tmp_dir, winner[0].number))
    assert versions.advance(spark, tmp_dir, first, "v-late") is None
    assert versions.current(spark, tmp_dir) == fourth
    assert sorted(os.listdir(f"{tmp_dir}/{versions.POINTERS}")) == [f"{n:020d}" for n in (1, 3, 4)]


def test_appends_at_once(spark, tmp_dir):
    database = _db()
    save_table(spark.range(1), database, "t", warehouse_dir=tmp_dir)
    frames = [spark.range(i, i + 1) for i in range(1, 13)]
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda f: save_table(f, database, "t", warehouse_dir=tmp_dir, mode="append"), frames))
    assert _ids(spark, database) == list(range(13))
    assert table_version(spark, database, "t") == 13
    assert len(os.listdir(f"{tmp_dir}/{database}.db/t/{versions.POINTERS}")) <= 3  # old pointers go


@pytest.mark.parametrize("between", ["append", "overwrite"])
def test_append_survives_a_commit_in_between(spark, tmp_dir, monkeypatch, between):
    database, advance = _db(), versions.advance
    save_table(spark.range(3), database, "t", warehouse_dir=tmp_dir)

    def late(*arguments):  # the rows are written; before they are committed somebody else commits
        monkeypatch.setattr(versions, "advance", advance)
        save_table(spark.range(50, 52), database, "t", warehouse_dir=tmp_dir, mode=between)
        return advance(*arguments)

    monkeypatch.setattr(versions, "advance", late)
    save_table(spark.range(90, 92), database, "t", warehouse_dir=tmp_dir, mode="append")
    kept = [0, 1, 2] if between == "append" else []
    assert _ids(spark, database) == [*kept, 50, 51, 90, 91]


def test_overwrites_at_once_leave_one_whole_version(spark, tmp_dir):
    database = _db()
    save_table(spark.range(2), database, "t", warehouse_dir=tmp_dir)
    frames = [spark.range(100 * i, 100 * i + 5) for i in range(1, 6)]
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda f: save_table(f, database, "t", warehouse_dir=tmp_dir), frames))
    found = _ids(spark, database)
    assert found in [list(range(100 * i, 100 * i + 5)) for i in range(1, 6)]
    folders = [n for n in os.listdir(f"{tmp_dir}/{database}.db/t") if n.startswith("v-")]
    assert len(folders) == 2  # the current one and the one before


def test_expected_version(spark, tmp_dir, monkeypatch):
    database = _db()
    assert table_version(spark, database, "t") == 0
    save_table(spark.range(3), database, "t", warehouse_dir=tmp_dir, expected_version=0)
    seen = table_version(spark, database, "t")
    save_table(spark.range(7, 8), database, "t", warehouse_dir=tmp_dir, mode="append")
    with pytest.raises(TableConflict):
        save_table(spark.range(1), database, "t", warehouse_dir=tmp_dir, expected_version=seen)
    # the version moves while the rows are being written
    advance, seen = versions.advance, table_version(spark, database, "t")

    def late(*arguments):
        monkeypatch.setattr(versions, "advance", advance)
        save_table(spark.range(8, 9), database, "t", warehouse_dir=tmp_dir, mode="append")
        return advance(*arguments)

    monkeypatch.setattr(versions, "advance", late)
    with pytest.raises(TableConflict):
        save_table(spark.range(1), database, "t", warehouse_dir=tmp_dir, expected_version=seen)
    assert _ids(spark, database) == [0, 1, 2, 7, 8]
    assert len([n for n in os.listdir(f"{tmp_dir}/{database}.db/t") if n.startswith("v-")]) == 1
    with pytest.raises(ValueError):
        save_table(spark.range(1), database, "t", warehouse_dir=tmp_dir, mode="append", expected_version=1)


def test_death_between_pointer_and_catalog(spark, tmp_dir, monkeypatch):
    database, publish = _db(), tables._publish
    save_table(spark.range(3), database, "t", warehouse_dir=tmp_dir)
    old = table_location(spark, database, "t")

    def dies(*arguments):
        raise KeyboardInterrupt

    monkeypatch.setattr(tables, "_publish", dies)
    with pytest.raises(KeyboardInterrupt):
        save_table(spark.range(5, 6), database, "t", warehouse_dir=tmp_dir)
    monkeypatch.setattr(tables, "_publish", publish)
    assert table_location(spark, database, "t") == old  # the catalog does not know yet
    assert _ids(spark, database) == [5]
    save_table(spark.range(6, 7), database, "t", warehouse_dir=tmp_dir, mode="append")
    assert _ids(spark, database) == [5, 6]


def test_death_before_the_pointer_leaves_the_old_table(spark, tmp_dir, monkeypatch):
    database = _db()
    save_table(spark.range(3), database, "t", warehouse_dir=tmp_dir)
    for mode in ("overwrite", "append"):
        failing = spark.range(4).selectExpr("CASE WHEN id = 3 THEN raise_error('broken') ELSE id END AS id").selectExpr("CAST(id AS BIGINT) AS id")
        with pytest.raises(Exception, match="broken"):
            save_table(failing, database, "t", warehouse_dir=tmp_dir, mode=mode)
    assert _ids(spark, database) == [0, 1, 2]


def test_versions_of_another_place_are_refused(spark, tmp_dir):
    database = _db()
    save_table(spark.range(3), database, "t", warehouse_dir=tmp_dir)
    spark.sql(f"ALTER TABLE {database}.t SET LOCATION '{tmp_dir}/elsewhere'")
    for mode in ("append", "overwrite"):
        with pytest.raises(TableLoadError):
            save_table(spark.range(1), database, "t", warehouse_dir=tmp_dir, mode=mode)
    spark.sql(f"DROP TABLE {database}.t")
    assert attach_table(spark, database, "t", tmp_dir).count() == 3


def test_table_without_versions(spark, tmp_dir):
    """A table that other software made in its own folder: appends go there, an overwrite starts versions."""
    database = _db()
    spark.range(3).write.parquet(f"{tmp_dir}/{database}.db/t")
    assert attach_table(spark, database, "t", tmp_dir).count() == 3
    save_table(spark.range(3, 5), database, "t", warehouse_dir=tmp_dir, mode="append")
    assert _ids(spark, database) == [0, 1, 2, 3, 4]
    save_table(spark.range(9, 10), database, "t", warehouse_dir=tmp_dir)
    assert _ids(spark, database) == [9] and table_version(spark, database, "t") == 1
