from hypothesis import given, settings
from hypothesis import strategies as st

from foldline.operators.consolidate import consolidate, multiplicity_name, row_count
from foldline.plans.transform import transform_frame


def test_nulls_group_together(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (None, "a"), (None, "a")], "k int, s string")
    out = {(r.k, r.s): r.occurrences for r in consolidate(df).collect()}
    assert out == {(1, "a"): 1, (2, None): 1, (None, "a"): 2}
    assert consolidate(df).dtypes[-1] == ("occurrences", "bigint")


def test_float_normalisation(spark):
    values = [(0.0,), (-0.0,), (float("nan"),), (float("nan"),), (None,), (float("inf"),)]
    out = consolidate(spark.createDataFrame(values, "v double")).collect()
    counts = sorted(r.occurrences for r in out)
    assert counts == [1, 1, 2, 2]


def test_name_collision_case_insensitive(spark):
    df = spark.createDataFrame([("x",), ("x",)], "Occurrences string")
    assert multiplicity_name(df) == "occurrences_2"
    out = consolidate(df)
    assert out.columns == ["Occurrences", "occurrences_2"]
    both = spark.createDataFrame([("x", 1)], "occurrences string, occurrences_2 int")
    assert consolidate(both).columns[-1] == "occurrences_3"


def test_dotted_and_nested_keys(spark):
    df = spark.createDataFrame([(1, [1, 2]), (1, [1, 2]), (1, [2])], "`a.b` int, arr array<int>")
    out = sorted(r.occurrences for r in consolidate(df).collect())
    assert out == [1, 2]


def test_transform_frame_order_and_no_dedup(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "x int, y string")
    out = transform_frame(df, ["k", "v"], "v", "a")
    assert [tuple(r) for r in out.collect()] == [(1, "a", 2)]
    raw = transform_frame(df, None, "y", "a", count_duplicates=False)
    assert raw.count() == 2 and raw.columns == ["x", "y"]


def test_row_count(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    assert row_count(df).first().row_count == df.count()


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["a", "b", None])), max_size=40))
def test_multiplicities_sum_to_input(spark, rows):
    df = spark.createDataFrame(rows, "k int, s string")
    out = consolidate(df).collect()
    assert sum(r.occurrences for r in out) == len(rows)
    assert len(out) == len(set(rows))


def test_partial_aggregation_plan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").select("l_returnflag", "l_linestatus")
    plan = consolidate(df)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "Exchange hashpartitioning" in plan


def _norm_key(v):
    import math
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return 0.0 if v == 0.0 else v
    return v


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([0.0, -0.0, float("nan"), 1.5, None]),
                          st.sampled_from(["a", None])), max_size=40))
def test_float_keys_fold_like_a_normalised_multiset(spark, rows):
    from collections import Counter
    df = spark.createDataFrame(rows, "v double, s string")
    got = Counter()
    for r in consolidate(df).collect():
        got[(_norm_key(r.v), r.s)] += r.occurrences
    expect = Counter((_norm_key(v), s) for v, s in rows)
    assert got == expect
    assert len(consolidate(df).collect()) == len(expect)


def _shuffle_records(df):
    """(partitioning, records written) of each exchange in the executed plan."""
    plan = df._jdf.queryExecution().executedPlan()
    stack, out = [plan.finalPhysicalPlan()], []
    while stack:
        node = stack.pop()
        name = node.getClass().getSimpleName()
        if name == "ShuffleQueryStageExec":
            stack.append(node.plan())
        if name == "ShuffleExchangeExec":
            out.append((node.outputPartitioning().toString(),
                        node.metrics().apply("shuffleRecordsWritten").value()))
        kids = node.children()
        stack.extend(kids.apply(i) for i in range(kids.size()))
    return out


def test_hot_row_crosses_the_shuffle_once_per_task(spark):
    from pyspark.sql import functions as F
    n = 30000
    base = spark.range(n).select((F.col("id") % 1000).cast("string").alias("k"))
    hot = spark.range(n // 2).select(F.lit("HOT").alias("k"))  # a third of all rows
    df = base.unionByName(hot).repartition(6)
    out = consolidate(df)
    rows = {r.k: r.occurrences for r in out.collect()}
    assert rows["HOT"] == n // 2 and len(rows) == 1001
    hashed = [recs for part, recs in _shuffle_records(out) if part.startswith("hashpartitioning")]
    # 6 map tasks x 1001 distinct rows at most, instead of 45,000 input rows
    assert hashed and hashed[0] <= 6 * 1001
