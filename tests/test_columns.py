import math

import pytest
from pyspark.errors import PySparkException

from foldline.operators.columns import (
    cell_text,
    drop_incomplete,
    filter_equals,
    numeric_columns,
    project,
    rename_columns,
)


def test_rename_positional(spark):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    assert rename_columns(df, ["id", "label"]).columns == ["id", "label"]
    with pytest.raises(ValueError):
        rename_columns(df, ["only_one"])
    with pytest.raises(ValueError):
        rename_columns(df, ["a", "A"])
    with pytest.raises(ValueError):
        rename_columns(df, ["a", ""])


def test_filter_equals_nulls_and_coercion(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (None, "a"), (None, "a")], "k int, s string")
    assert filter_equals(df, "s", "a").count() == 3
    assert filter_equals(df, "s", None).count() == 0
    assert filter_equals(df, "k", "1").count() == 1  # text coerces to the int column
    assert filter_equals(df, "K", 2).count() == 1  # resolution is case-insensitive
    with pytest.raises(ValueError):
        filter_equals(df, "missing", 1)
    with pytest.raises(PySparkException):
        filter_equals(df, "k", "abc").collect()


def test_dotted_names_are_literal(spark):
    df = spark.createDataFrame([(1, 2), (1, 3)], "`a.b` int, c int")
    assert filter_equals(df, "a.b", 1).count() == 2
    assert project(df, ["a.b"]).columns == ["a.b"]


def test_drop_incomplete_null_and_nan(spark):
    values = [(0.0,), (-0.0,), (float("nan"),), (float("nan"),), (None,), (float("inf"),)]
    df = spark.createDataFrame(values, "v double")
    kept = sorted(r.v for r in drop_incomplete(df, ["v"]).collect())
    assert kept[-1] == math.inf and len(kept) == 3


def test_numeric_from_text(spark):
    ok = spark.createDataFrame([(" 1.5 ",), ("2",)], "v string")
    assert sorted(r.v for r in numeric_columns(ok, ["v"]).collect()) == [1.5, 2.0]
    for bad in ["1_000", "inf", "x"]:
        df = spark.createDataFrame([(bad,)], "v string")
        with pytest.raises(PySparkException):
            numeric_columns(df, ["v"]).collect()
    flags = spark.createDataFrame([(True,), (False,)], "v boolean")
    assert sorted(r.v for r in numeric_columns(flags, ["v"]).collect()) == [0.0, 1.0]


def test_cell_text(spark):
    df = spark.createDataFrame(
        [(1, None, {"x": None, "y": "é"}, [1, 2])],
        "a int, b string, s struct<x:int,y:string>, l array<int>",
    )
    row = cell_text(df).first()
    assert row.a == "1" and row.b == ""
    assert row.s == '{"x":null,"y":"é"}'
    assert row.l == "[1,2]"
    assert all(t == "string" for _, t in cell_text(df).dtypes)


def test_filter_is_pushed_to_the_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").select("l_returnflag", "l_quantity")
    plan = filter_equals(df, "l_returnflag", "R")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in plan
    assert "ReadSchema: struct<l_quantity:double,l_returnflag:string>" in plan
