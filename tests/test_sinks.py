import os
import uuid

import pytest
from pyspark.sql import functions as F

from foldline.sinks.files import output_name, publish_file
from foldline.sinks.tables import TableLoadError, column_type, save_table, table_location
from foldline.sources.catalog import (
    attach_table,
    describe_extended,
    describe_table,
    list_databases,
    list_tables,
    preview_table,
    read_table,
)
from foldline.sources.files import read_source

SF = "/root/testdata/sf0.001"


def _parts(path):
    return [n for n in os.listdir(path.replace("file:", "")) if n.startswith("part-")]


def test_output_name():
    assert output_name("https://h/x/samples.csv") == "transformed_samples.csv"
    with pytest.raises(ValueError):
        output_name("https://h/x/samples.parquet")


def test_publish_csv_roundtrip_and_replace(spark, tmp_dir):
    nation = spark.read.parquet(f"{SF}/nation.parquet")
    path = publish_file(nation, "https://example.org/data/nation.csv", tmp_dir)
    assert path.endswith("/transformed_nation.csv")
    back = read_source(spark, path, schema=nation.schema)
    assert back.exceptAll(nation).count() == 0 and nation.exceptAll(back).count() == 0
    # publishing again replaces the old content, leaving no staging folders
    publish_file(nation.limit(3), "nation.csv", tmp_dir)
    assert read_source(spark, path, schema=nation.schema).count() == 3
    assert sorted(os.listdir(tmp_dir)) == ["transformed_nation.csv"]


def test_publish_json_keeps_nulls_and_format_override(spark, tmp_dir):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    path = publish_file(df, "t.csv", tmp_dir, file_format="json")
    assert path.endswith("transformed_t.csv")
    back = spark.read.json(path)
    assert sorted(back.columns) == ["a", "b"] and back.count() == 2


def test_publish_empty_frame_writes_a_part(spark, tmp_dir):
    empty = spark.createDataFrame([], "a int, b string")
    path = publish_file(empty, "e.csv", tmp_dir)
    assert len(_parts(path)) >= 1
    assert read_source(spark, path, schema=empty.schema).count() == 0


def test_publish_is_parallel(spark, tmp_dir):
    lineitem = spark.read.parquet(f"{SF}/lineitem.parquet").repartition(4)
    path = publish_file(lineitem, "l.csv", tmp_dir)
    assert len(_parts(path)) == 4


def _db():
    return f"t_{uuid.uuid4().hex[:8]}"


def test_table_overwrite_append_and_catalog(spark, tmp_dir):
    db, tb = _db(), "nation"
    nation = spark.read.parquet(f"{SF}/nation.parquet")
    loc = save_table(nation, db, tb, warehouse_dir=tmp_dir)
    assert loc == f"{tmp_dir}/{db}.db/{tb}"
    save_table(nation, db, tb, warehouse_dir=tmp_dir, mode="overwrite")
    assert read_table(spark, db, tb).count() == 25
    save_table(nation, db, tb, warehouse_dir=tmp_dir, mode="append")
    assert read_table(spark, db, tb).count() == 50
    assert db in [r[0] for r in list_databases(spark).collect()]
    assert [r.tableName for r in list_tables(spark, db).collect()] == [tb]
    assert [(r.col_name, r.data_type) for r in describe_table(spark, db, tb).collect()] == [
        ("n_nationkey", "int"), ("n_name", "string"), ("n_regionkey", "int")]
    extended = {r.col_name: r.data_type for r in describe_extended(spark, db, tb).collect()}
    assert extended["Type"] == "EXTERNAL" and extended["Provider"].lower() == "parquet"
    assert f"/{db}.db/{tb}/v-" in table_location(spark, db, tb)
    assert preview_table(spark, db, tb, 7).count() == 7
    with pytest.raises(ValueError):
        save_table(nation, db, tb, warehouse_dir=tmp_dir, mode="ignore")


def test_schema_guard_writes_nothing(spark, tmp_dir):
    db, tb = _db(), "t"
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    save_table(df, db, tb, warehouse_dir=tmp_dir)
    swapped = df.select(F.col("b").alias("b"), F.col("a").alias("a"))
    for bad in (
        swapped,
        df.withColumn("c", F.lit(1)),
        df.select("a", F.col("b").cast("bigint").alias("b")),
    ):
        with pytest.raises(TableLoadError):
            save_table(bad, db, tb, warehouse_dir=tmp_dir)
    assert [tuple(r) for r in read_table(spark, db, tb).collect()] == [(1, 2)]
    # case differences in names are accepted
    save_table(df.toDF("A", "B"), db, tb, warehouse_dir=tmp_dir, mode="append")
    assert read_table(spark, db, tb).count() == 2


def test_location_guard(spark, tmp_dir):
    db = _db()
    df = spark.createDataFrame([(1,)], "a int")
    save_table(df, db, "t", warehouse_dir=tmp_dir)
    other = os.path.join(tmp_dir, "elsewhere")
    with pytest.raises(TableLoadError):
        save_table(df, db, "t", warehouse_dir=other)
    assert read_table(spark, db, "t").count() == 1


def test_type_gate_and_identifiers(spark, tmp_dir):
    nested = spark.createDataFrame([(1, [1])], "a int, l array<int>")
    with pytest.raises(TableLoadError):
        save_table(nested, _db(), "t", warehouse_dir=tmp_dir)
    df = spark.createDataFrame([(1,)], "a int")
    for db, tb in (("1db", "t"), ("db", "t-x"), ("db;drop", "t")):
        with pytest.raises(ValueError):
            save_table(df, db, tb, warehouse_dir=tmp_dir)
    with pytest.raises(ValueError):
        save_table(spark.createDataFrame([(1, 2)], "a int, A int"), _db(), "t", warehouse_dir=tmp_dir)
    from pyspark.sql import types as T
    assert column_type(T.TimestampNTZType()) == "timestamp_ntz"
    assert column_type(T.TimestampNTZType(), ntz_as_timestamp=True) == "timestamp"
    assert column_type(T.DecimalType(10, 2)) == "decimal(10,2)"


def test_read_missing_table(spark):
    with pytest.raises(TableLoadError):
        read_table(spark, "no_such_db_x", "nothing")


def test_nested_columns_in_file_sinks(spark, tmp_dir):
    from pyspark.errors import PySparkException
    nested = spark.createDataFrame([(1, {"x": 1}, [1, 2])], "a int, s struct<x:int>, l array<int>")
    path = publish_file(nested, "n.json", os.path.join(tmp_dir, "json"))
    back = spark.read.schema(nested.schema).json(path)
    assert back.collect() == nested.collect()
    with pytest.raises(PySparkException):
        publish_file(nested, "n.csv", os.path.join(tmp_dir, "csv"))
    # a failed publish leaves no staging folder and no output behind
    assert not os.path.exists(os.path.join(tmp_dir, "csv", "transformed_n.csv"))
    assert not [f for f in os.listdir(tmp_dir) if f.startswith("._stage")]


def test_publish_compressed_parts(spark, tmp_dir):
    nation = spark.read.parquet(f"{SF}/nation.parquet")
    path = publish_file(nation, "nation.csv", tmp_dir, write_options={"compression": "gzip"})
    parts = _parts(path)
    assert parts and all(p.endswith(".csv.gz") for p in parts)
    assert read_source(spark, path, schema=nation.schema).count() == 25


def test_timestamp_ntz_kept_unless_asked(spark, tmp_dir):
    orders = spark.read.parquet(f"{SF}/orders.parquet").select("o_orderkey", "o_orderdate")
    save_table(orders, "ntz_db", "native", warehouse_dir=tmp_dir)
    assert dict(read_table(spark, "ntz_db", "native").dtypes)["o_orderdate"] == "timestamp_ntz"
    save_table(orders, "ntz_db", "converted", warehouse_dir=tmp_dir, ntz_as_timestamp=True)
    back = read_table(spark, "ntz_db", "converted")
    assert dict(back.dtypes)["o_orderdate"] == "timestamp"
    assert back.count() == orders.count()


def test_overwrite_switches_versions(spark, tmp_dir):
    """A failing overwrite leaves the old rows; a good one keeps one version back; a table may be
    overwritten from itself; a new process finds the current version."""
    db, frame = _db(), spark.createDataFrame([(i, str(i)) for i in range(10)], "a int, b string")
    base = save_table(frame, db, "t", warehouse_dir=tmp_dir)
    failing = frame.select("a", F.when(F.col("a") > 5, F.raise_error(F.lit("boom"))).otherwise(F.col("b")).alias("b"))
    with pytest.raises(Exception, match="boom"):
        save_table(failing, db, "t", warehouse_dir=tmp_dir)
    assert read_table(spark, db, "t").count() == 10
    for n in (9, 8, 7):
        save_table(read_table(spark, db, "t").where(F.col("a") < n), db, "t", warehouse_dir=tmp_dir)
        assert read_table(spark, db, "t").count() == n
    assert len([f for f in os.listdir(base) if f.startswith("v-")]) == 2
    spark.sql(f"DROP TABLE {db}.t")
    assert attach_table(spark, db, "t", tmp_dir).count() == 7
    spark.sql(f"DROP TABLE {db}.t")
    save_table(frame, db, "t", warehouse_dir=tmp_dir, mode="append")
    assert read_table(spark, db, "t").count() == 17


def test_attach_finds_all_partitions_and_odd_paths(spark, tmp_dir):
    db = _db()
    frame = spark.createDataFrame([(1, "x"), (2, "y")], "a int, p string")
    save_table(frame, db, "t", warehouse_dir=tmp_dir, partition_columns=["p"])
    save_table(frame.where("a = 1").withColumn("a", F.lit(5)), db, "t", warehouse_dir=tmp_dir, partition_columns=["p"])
    spark.sql(f"DROP TABLE {db}.t")
    assert sorted(map(tuple, attach_table(spark, db, "t", tmp_dir).collect())) == [(2, "y"), (5, "x")]
    with pytest.raises(TableLoadError):
        attach_table(spark, db, "missing", tmp_dir)
    with pytest.raises(ValueError):
        save_table(frame, db, "q", warehouse_dir=os.path.join(tmp_dir, "it's"))


def test_single_file_is_joined_from_parts(spark, tmp_dir, monkeypatch):
    from foldline.sinks import files

    monkeypatch.setattr(files, "COPY_BYTES", 1000)  # more pieces than parts
    rows = [(i, f'te"xt, {i} é', None if i % 5 else "") for i in range(2000)]
    frame = spark.createDataFrame(rows, 'id int, `a,"b` string, c string').repartition(6)
    cases = [("csv", {"escape": '"', "emptyValue": "e", "nullValue": "n"}), ("csv", {"sep": ";", "quoteAll": True}), ("json", {})]
    for i, (suffix, options) in enumerate(cases):
        folder = publish_file(frame, f"t.{suffix}", os.path.join(tmp_dir, f"folder{i}"), write_options=options)
        path = publish_file(frame, f"t.{suffix}", os.path.join(tmp_dir, f"one{i}"), write_options=options, single_file=True)
        assert os.path.isfile(path) and os.listdir(os.path.dirname(path)) == [os.path.basename(path)]
        with open(path, encoding="utf-8") as handle:
            lines = handle.read().splitlines()
        parts = []
        for name in _parts(folder):
            with open(os.path.join(folder, name), encoding="utf-8") as handle:
                parts.append(handle.read().splitlines())
        header = parts[0][:1] if suffix == "csv" else []
        assert lines[: len(header)] == header and len(lines) == len(header) + 2000
        assert sorted(lines[len(header):]) == sorted(x for p in parts for x in p[len(header):])


def test_single_file_replaces_files_and_folders(spark, tmp_dir):
    nation = spark.read.parquet(f"{SF}/nation.parquet")
    path = publish_file(nation, "nation.csv", tmp_dir)
    assert os.path.isdir(path)
    for n in (25, 7):
        assert publish_file(nation.where(f"n_nationkey < {n}"), "nation.csv", tmp_dir, single_file=True) == path
        assert os.path.isfile(path) and read_source(spark, path, schema=nation.schema).count() == n
    empty = publish_file(nation.limit(0), "nation.csv", tmp_dir, single_file=True)
    assert open(empty).read() == "n_nationkey,n_name,n_regionkey\n"
    assert read_source(spark, publish_file(nation, "nation.csv", tmp_dir), schema=nation.schema).count() == 25
    with pytest.raises(ValueError):
        publish_file(nation, "nation.csv", tmp_dir, write_options={"compression": "gzip"}, single_file=True)
    nothing = publish_file(nation.limit(0), "n.json", tmp_dir, single_file=True)
    assert os.path.getsize(nothing) == 0
    assert sorted(n for n in os.listdir(tmp_dir) if not n.endswith(".crc")) == ["transformed_n.json", "transformed_nation.csv"]
