"""Argument validation: one test per raise not covered elsewhere."""

import pytest

from foldline.functions.names import free_name, positive_int, quote, resolve
from foldline.operators.describe import limit_rows, scatter_points
from foldline.plans import print_rows
from foldline.sinks.tables import save_table
from foldline.streaming import ChangeListener, start_ingest


def test_names_helpers(spark):
    assert quote("a`b") == "`a``b`"
    assert free_name(["x", "OCCURRENCES", "occurrences_2"], "occurrences") == "occurrences_3"
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert resolve(df, "A") == "a"
    for bad in ("", "  ", None, 5):
        with pytest.raises(ValueError):
            resolve(df, bad)
    for bad in (0, -1, True, 1.5, "3"):
        with pytest.raises(ValueError):
            positive_int(bad, "n")
    with pytest.raises(ValueError):
        positive_int(101, "n", 100)


def test_limits_and_printing(spark):
    df = spark.range(5)
    for bad in (0, True, None):
        with pytest.raises(ValueError):
            limit_rows(df, bad)
        with pytest.raises(ValueError):
            print_rows(df, bad)
    with pytest.raises(ValueError):
        scatter_points(df.withColumn("y", df.id), "id", "missing")


def test_listener_and_ingest_arguments(spark, tmp_dir):
    for bad in (0, -1, "2"):
        with pytest.raises(ValueError):
            ChangeListener(spark, tmp_dir, tmp_dir + "/s", lambda s: None, bad)
    with pytest.raises(ValueError):
        start_ingest(spark, tmp_dir, "a string", "db", "t", tmp_dir + "/ck", poll_interval=0)
    with pytest.raises(ValueError):
        start_ingest(spark, tmp_dir, "a string", "db", "t", tmp_dir + "/ck", output="update")
    with pytest.raises(ValueError):
        start_ingest(spark, tmp_dir, "a string", "db", "t", tmp_dir + "/ck", file_format="parquet")


def test_partition_columns_must_be_last(spark, tmp_dir):
    df = spark.createDataFrame([(1, 2)], "p int, a int")
    with pytest.raises(ValueError):
        save_table(df, "argdb", "t", warehouse_dir=tmp_dir, partition_columns=["p"])
