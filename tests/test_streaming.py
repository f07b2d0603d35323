import os
import time

import pytest

from foldline.operators.consolidate import consolidate
from foldline.sinks.files import publish_file
from foldline.sources.catalog import read_table
from foldline.streaming import (
    ChangeListener,
    fingerprint,
    refresh_if_changed,
    source_fingerprint,
    start_ingest,
    stop_ingest,
)
from foldline.plans.transform import transform
from foldline.sinks.tables import save_table

SF = "/root/testdata/sf0.001"


def test_fingerprint_is_order_insensitive(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    a = fingerprint(docs, ["text"]).first()
    b = fingerprint(docs.repartition(7), ["text"]).first()
    assert a == b and a.n == docs.count()
    changed = fingerprint(docs.limit(docs.count() - 1), ["text"]).first()
    assert changed != a
    multi = fingerprint(docs).first()
    assert multi.n == a.n


def test_source_fingerprint_absent_and_present(spark, tmp_dir):
    assert source_fingerprint(spark, os.path.join(tmp_dir, "missing.csv")) is None
    path = os.path.join(tmp_dir, "x.csv")
    with open(path, "w") as handle:
        handle.write("a\n1\n")
    first = source_fingerprint(spark, path)
    assert first[0] == 2
    with open(path, "w") as handle:
        handle.write("a\n2\n")
    assert source_fingerprint(spark, path) != first


def test_refresh_runs_only_on_change(spark, tmp_dir):
    orders = spark.read.parquet(f"{SF}/orders.parquet").select("o_orderstatus")
    src = publish_file(orders.where("o_orderstatus = 'O'"), "orders.csv", os.path.join(tmp_dir, "in"))
    state = os.path.join(tmp_dir, "state")
    calls = []

    def action(session):
        calls.append(1)
        out = transform(session, src, schema="o_orderstatus string")
        save_table(out, "refresh_db", "status", warehouse_dir=os.path.join(tmp_dir, "wh"))

    assert refresh_if_changed(spark, src, state, action)
    assert not refresh_if_changed(spark, src, state, action)
    publish_file(orders, "orders.csv", os.path.join(tmp_dir, "in"))
    assert refresh_if_changed(spark, src, state, action)
    assert len(calls) == 2
    got = {r.o_orderstatus: r.occurrences for r in read_table(spark, "refresh_db", "status").collect()}
    expect = {r.o_orderstatus: r.occurrences for r in consolidate(orders).collect()}
    assert got == expect


def test_failed_action_does_not_advance_state(spark, tmp_dir):
    path = os.path.join(tmp_dir, "x.csv")
    with open(path, "w") as handle:
        handle.write("a\n1\n")
    state = os.path.join(tmp_dir, "state")

    def boom(session):
        raise RuntimeError("boom")

    try:
        refresh_if_changed(spark, path, state, boom)
    except RuntimeError:
        pass
    assert refresh_if_changed(spark, path, state, lambda s: None)


def test_listener_polls_and_stops(spark, tmp_dir):
    path = os.path.join(tmp_dir, "x.csv")
    with open(path, "w") as handle:
        handle.write("a\n1\n")
    seen = []
    listener = ChangeListener(spark, path, os.path.join(tmp_dir, "state"), lambda s: seen.append(1), 0.2)
    status = listener.run(max_rounds=3)
    assert status.rounds == 3 and status.refreshes == 1
    listener.start()
    time.sleep(0.5)
    assert listener.stop(10)
    assert not listener.stop(1)
    assert listener.error is None


def test_ingest_equals_consolidation_of_all_files(spark, tmp_dir):
    events = spark.read.parquet(f"{SF}/events.parquet").select("event_type", "user_id")
    inbox = os.path.join(tmp_dir, "inbox")
    events.repartition(3).write.option("header", True).csv(inbox)
    query = start_ingest(
        spark, inbox, "event_type string, user_id bigint", "ingest_db", "events_t",
        warehouse_dir=os.path.join(tmp_dir, "wh"), checkpoint_location=os.path.join(tmp_dir, "ck"),
        available_now=True, max_files_per_trigger=1,
    )
    query.awaitTermination()
    assert query.exception() is None
    got = read_table(spark, "ingest_db", "events_t")
    expect = consolidate(events)
    assert got.exceptAll(expect).count() == 0 and expect.exceptAll(got).count() == 0
    assert len(query.recentProgress) >= 3
    # a restart with the same checkpoint sees no new files; a new file is added
    events.limit(10).write.mode("append").option("header", True).csv(inbox)
    again = start_ingest(
        spark, inbox, "event_type string, user_id bigint", "ingest_db", "events_t",
        warehouse_dir=os.path.join(tmp_dir, "wh"), checkpoint_location=os.path.join(tmp_dir, "ck"),
        available_now=True,
    )
    again.awaitTermination()
    total = read_table(spark, "ingest_db", "events_t").groupBy().sum("occurrences").first()[0]
    assert total == events.count() + 10
    assert not stop_ingest(again)


def test_ingest_stop(spark, tmp_dir):
    inbox = os.path.join(tmp_dir, "inbox")
    os.makedirs(inbox)
    query = start_ingest(
        spark, inbox, "a string", "ingest_db", "stop_t",
        warehouse_dir=os.path.join(tmp_dir, "wh"), checkpoint_location=os.path.join(tmp_dir, "ck"),
        poll_interval=0.5,
    )
    time.sleep(1)
    assert stop_ingest(query, 30)
    assert not stop_ingest(query)


def test_content_decides_not_size_or_time(spark, tmp_dir):
    path, state = os.path.join(tmp_dir, "x.csv"), os.path.join(tmp_dir, "state")

    def write(text):
        with open(path, "w") as handle:
            handle.write(text)
        os.utime(path, (1_600_000_000, 1_600_000_000))

    def refreshed():
        return refresh_if_changed(spark, path, state, lambda s: None)

    write("a,b\n1,2\n3,4\n")
    assert refreshed() and not refreshed()
    os.utime(path, (1_700_000_000, 1_700_000_000))
    assert not refreshed()  # touched only
    for text in ("a,b\n1,2\n3,5\n", "1,2\na,b\n3,5\n", "1,2\n3,5\na,b\n"):
        write(text)  # same size and time: a changed value, the header moved, lines exchanged
        assert refreshed() and not refreshed()


def test_listen_runs_the_flow_on_change(spark, tmp_dir):
    from foldline.streaming import listen
    src = os.path.join(tmp_dir, "samples.csv")
    with open(src, "w") as handle:
        handle.write("a,b\n1,x\n1,x\n2,y\n")
    listener = listen(
        spark, src, "https://example.org/samples.csv", os.path.join(tmp_dir, "out"),
        os.path.join(tmp_dir, "state"), database="listen_db", table="samples", poll_interval=0.1, warehouse_dir=os.path.join(tmp_dir, "wh"),
    )
    assert listener.run(max_rounds=2).refreshes == 1
    assert sorted(r.occurrences for r in read_table(spark, "listen_db", "samples").collect()) == [1, 2]
    with open(src, "w") as handle:
        handle.write("a,b\n1,x\n")
    assert listener.run(max_rounds=1).refreshes == 2
    assert [r.occurrences for r in read_table(spark, "listen_db", "samples").collect()] == [1]
    import pytest
    with pytest.raises(ValueError):
        listen(spark, src, "s.csv", tmp_dir, os.path.join(tmp_dir, "s2"), table="t")
    alone = listen(spark, src, "s.csv", os.path.join(tmp_dir, "o2"), os.path.join(tmp_dir, "s3"), poll_interval=0.1)
    assert alone.run(max_rounds=1).refreshes == 1
    assert os.path.isdir(os.path.join(tmp_dir, "o2", "transformed_s.csv"))


def test_ledger_ingest_is_idempotent_per_batch(spark, tmp_dir):
    from foldline.streaming import read_ingested
    events = spark.read.parquet(f"{SF}/events.parquet").select("event_type", "user_id")
    inbox = os.path.join(tmp_dir, "inbox")
    events.repartition(3).write.option("header", True).csv(inbox)
    opts = dict(warehouse_dir=os.path.join(tmp_dir, "wh"), checkpoint_location=os.path.join(tmp_dir, "ck"),
                available_now=True, max_files_per_trigger=1, output="ledger")
    q = start_ingest(spark, inbox, "event_type string, user_id bigint", "ledger_db", "ev", **opts)
    q.awaitTermination()
    assert q.exception() is None
    raw = read_table(spark, "ledger_db", "ev")
    assert raw.columns == ["event_type", "user_id", "occurrences", "query_id", "batch_id"]
    assert raw.select("batch_id").distinct().count() == 3
    got = read_ingested(spark, "ledger_db", "ev")
    expect = consolidate(events)
    assert got.exceptAll(expect).count() == 0 and expect.exceptAll(got).count() == 0
    # replaying a batch (as a retry would) replaces its partition, no double count
    from foldline.sinks.tables import save_table
    from pyspark.sql import functions as F
    replay = raw.where("batch_id = 0")
    replay = spark.createDataFrame(replay.collect(), replay.schema)
    save_table(replay, "ledger_db", "ev", warehouse_dir=os.path.join(tmp_dir, "wh"),
               partition_columns=["query_id", "batch_id"])
    again = read_ingested(spark, "ledger_db", "ev")
    assert again.agg(F.sum("occurrences")).first()[0] == events.count()


def test_file_stream_ignores_in_place_rewrite(spark, tmp_dir):
    """Why T2 exists: the streaming file source never re-reads a rewritten file."""
    from foldline.streaming import read_ingested
    inbox = os.path.join(tmp_dir, "inbox")
    os.makedirs(inbox)
    path = os.path.join(inbox, "a.csv")
    with open(path, "w") as handle:
        handle.write("v\n1\n")
    opts = dict(warehouse_dir=os.path.join(tmp_dir, "wh"), checkpoint_location=os.path.join(tmp_dir, "ck"),
                available_now=True)
    start_ingest(spark, inbox, "v string", "rewrite_db", "t", **opts).awaitTermination()
    with open(path, "w") as handle:
        handle.write("v\n2\n")
    os.utime(path, (time.time() + 60, time.time() + 60))
    start_ingest(spark, inbox, "v string", "rewrite_db", "t", **opts).awaitTermination()
    assert [tuple(r) for r in read_ingested(spark, "rewrite_db", "t").collect()] == [("1", 1)]


def test_ingest_leaves_caller_settings_alone(spark, tmp_dir):
    inbox = os.path.join(tmp_dir, "inbox")
    os.makedirs(inbox)
    with open(os.path.join(inbox, "a.csv"), "w") as handle:
        handle.write("v\n1\n1\n")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    provider = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    q = start_ingest(spark, inbox, "v string", "conf_db", "t", warehouse_dir=os.path.join(tmp_dir, "wh"),
                     checkpoint_location=os.path.join(tmp_dir, "ck"), available_now=True, state_partitions=3)
    q.awaitTermination()
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == provider
    assert [tuple(r) for r in read_table(spark, "conf_db", "t").collect()] == [("1", 2)]


def _events_in(spark, inbox, rows, mode="append"):
    spark.createDataFrame(rows, "v string").coalesce(1).write.mode(mode).option("header", True).csv(inbox)


def test_ingest_needs_its_checkpoint(spark, tmp_dir):
    inbox, opts = os.path.join(tmp_dir, "inbox"), dict(warehouse_dir=os.path.join(tmp_dir, "wh"), available_now=True, output="ledger")
    _events_in(spark, inbox, [("a",), ("a",)])
    with pytest.raises(ValueError):
        start_ingest(spark, inbox, "v string", "own_db", "t", "", **opts)
    start_ingest(spark, inbox, "v string", "own_db", "t", os.path.join(tmp_dir, "ck1"), **opts).awaitTermination()
    other = start_ingest(spark, inbox, "v string", "own_db", "t", os.path.join(tmp_dir, "ck2"), **opts)
    with pytest.raises(Exception, match="another checkpoint"):
        other.awaitTermination()
    from foldline.streaming import read_ingested
    assert [tuple(r) for r in read_ingested(spark, "own_db", "t").collect()] == [("a", 2)]


def test_stop_lets_the_running_batch_finish(spark, tmp_dir):
    inbox = os.path.join(tmp_dir, "inbox")
    _events_in(spark, inbox, [(str(i),) for i in range(1000)])
    args = (spark, inbox, "v string", "halt_db", "t", os.path.join(tmp_dir, "ck"))
    opts = dict(warehouse_dir=os.path.join(tmp_dir, "wh"))
    start_ingest(*args, available_now=True, **opts).awaitTermination()
    assert read_table(spark, "halt_db", "t").count() == 1000
    spark.range(300_000).selectExpr("cast(id as string) v").coalesce(1).write.mode("append").option("header", True).csv(inbox)
    query = start_ingest(*args, poll_interval=0.1, **opts)
    deadline = time.monotonic() + 60
    while not query.write_gate.locked() and time.monotonic() < deadline:
        time.sleep(0.02)
    assert stop_ingest(query, 120)
    assert read_table(spark, "halt_db", "t").count() in (1000, 300_000)
    start_ingest(*args, available_now=True, **opts).awaitTermination()
    assert read_table(spark, "halt_db", "t").count() == 300_000


def _lines_in_files(folder, lines, cuts):
    os.makedirs(folder)
    for i, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(lines)])):
        with open(os.path.join(folder, f"part-{i:05d}.csv"), "w", encoding="utf-8") as out:
            out.write("".join(line + "\n" for line in lines[a:b]))


def test_source_fingerprint_does_not_depend_on_splits(spark, tmp_dir):
    lines = [f"{i % 7},é{i}" for i in range(5000)] + ["", "", "last"]
    layouts = {"one": [], "two": [2500], "fifty": list(range(100, 5000, 100)), "odd": [1, 1, 17, 4999, 5003]}
    for name, cuts in layouts.items():
        _lines_in_files(os.path.join(tmp_dir, name), lines, cuts)
    found = {source_fingerprint(spark, os.path.join(tmp_dir, name)) for name in layouts}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")  # one file in many splits
    try:
        found.add(source_fingerprint(spark, os.path.join(tmp_dir, "one")))
        found.add(source_fingerprint(spark, os.path.join(tmp_dir, "two")))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(found) == 1 and found.pop()[0] == 5003
    others = set()
    for k, change in enumerate([(0, 1), (10, 4000), (2499, 2500), (5000, 5002)]):  # exchanged lines
        other = list(lines)
        other[change[0]], other[change[1]] = other[change[1]], other[change[0]]
        _lines_in_files(os.path.join(tmp_dir, f"x{k}"), other, [2500])
        others.add(source_fingerprint(spark, os.path.join(tmp_dir, f"x{k}")))
    for k, other in enumerate([lines[:-1], lines + [""], lines[1:], lines + lines]):
        _lines_in_files(os.path.join(tmp_dir, f"y{k}"), other, [])
        others.add(source_fingerprint(spark, os.path.join(tmp_dir, f"y{k}")))
    assert len(others) == 8 and source_fingerprint(spark, os.path.join(tmp_dir, "one")) not in others
    os.makedirs(os.path.join(tmp_dir, "none"))
    with open(os.path.join(tmp_dir, "none", "a.csv"), "w"):
        pass
    assert source_fingerprint(spark, os.path.join(tmp_dir, "none")) == (0, "0" * 16)
