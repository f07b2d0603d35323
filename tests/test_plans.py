"""Guards on the physical plans (see PLANS.md)."""

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scatter_is_a_top_k(spark):
    plan = _plan(entry.queries()["scatter_sample"](spark, SF))
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>" in plan


def test_outliers_broadcast_checked_fences(spark):
    plan = _plan(entry.queries()["outliers"](spark, SF))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    alone = _plan(entry.queries()["outliers_single_group"](spark, SF))
    assert "Join" not in alone and "Exchange" not in alone


def test_box_stats_shuffles_no_rows_and_leaves_no_files(spark):
    """Exchanges carry partial aggregates or the one row a category of the broadcast state."""
    import os
    import re

    from foldline.session import checkpoint_root
    root = checkpoint_root(spark).removeprefix("file:")
    before = sorted(os.listdir(root))
    for name in ("box_stats", "box_stats_single_group", "box_stats_weighted"):
        plan = _plan(entry.queries()[name](spark, SF))
        assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan, name
        for below in re.findall(r" Exchange hashpartitioning[^\n]*\n([^\n]*)", plan):
            assert "HashAggregate" in below or "partial" in below, (name, below)
    assert sorted(os.listdir(root)) == before


def test_histogram_is_one_aggregate_without_joins(spark):
    plan = _plan(entry.queries()["histogram_totalprice"](spark, SF))
    assert "Join" not in plan and "ReadSchema: struct<o_totalprice:double>" in plan
    assert "partial_sum" in plan and "Range (0, 10" in plan


def test_no_plan_uses_cartesian_or_nested_loop_joins(spark):
    for name in ("consolidate_filtered", "consolidate_text", "fingerprint", "categories_ordered",
                 "histogram_weighted", "box_stats_weighted", "outliers_single_group"):
        plan = _plan(entry.queries()[name](spark, SF))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
