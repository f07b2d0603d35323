import numpy as np
import pytest
from pyspark.errors import PySparkException

from foldline.operators.consolidate import consolidate
from foldline.operators.describe import (
    box_stats,
    category_count,
    check_category_count,
    histogram,
    limit_rows,
    ordered_categories,
    outliers,
    quartiles,
    scatter_points,
)

SF = "/root/testdata/sf0.01"


def _np_hist(values, bins):
    counts, edges = np.histogram(np.asarray(values, dtype=float), bins=bins)
    return counts.tolist(), edges


@pytest.mark.parametrize(
    "table,column,bins",
    [("orders", "o_totalprice", 10), ("lineitem", "l_discount", 7), ("part", "p_size", 10),
     ("events", "value", 13), ("part", "p_retailprice", 1)],
)
def test_histogram_matches_numpy(spark, table, column, bins):
    df = spark.read.parquet(f"{SF}/{table}.parquet")
    values = [r[0] for r in df.select(column).collect()]
    expected, edges = _np_hist(values, bins)
    got = histogram(df, column, bins=bins).orderBy("bin").collect()
    assert [r.frequency for r in got] == expected
    assert [r.bin_start for r in got] == edges[:-1].tolist()
    assert [r.bin_end for r in got] == edges[1:].tolist()


def test_histogram_constant_and_empty(spark):
    const = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    got = {r.bin: r.frequency for r in histogram(const, "v").collect()}
    assert got[5] == 2 and sum(got.values()) == 2
    assert _np_hist([3.0, 3.0], 10)[0][5] == 2
    empty = spark.createDataFrame([], "v double")
    with pytest.raises(ValueError):
        histogram(empty, "v")
    for bad in (0, 101, True, 2.5):
        with pytest.raises(ValueError):
            histogram(const, "v", bins=bad)
    with pytest.raises(ValueError):
        histogram(const, "missing")


def test_histogram_rejects_non_finite(spark):
    df = spark.createDataFrame([(1.0,), (float("inf"),)], "v double")
    with pytest.raises(PySparkException):
        histogram(df, "v").collect()
    text = spark.createDataFrame([("1",), ("x",)], "v string")
    with pytest.raises(PySparkException):
        histogram(text, "v").collect()


def test_histogram_weighted_equals_unweighted_on_source(spark):
    df = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_quantity")
    plain = {r.bin: r.frequency for r in histogram(df, "l_quantity", bins=7).collect()}
    folded = consolidate(df)
    weighted = {r.bin: r.frequency for r in histogram(folded, "l_quantity", bins=7, weight="occurrences").collect()}
    assert plain == weighted


def _brute_box(groups):
    out = {}
    for cat, vals in groups.items():
        x = np.sort(np.asarray(vals, dtype=float))
        q1, med, q3 = np.percentile(x, [25, 50, 75])
        iqr = q3 - q1
        lo_in = x[x >= q1 - 1.5 * iqr]
        hi_in = x[x <= q3 + 1.5 * iqr]
        wl = q1 if len(lo_in) == 0 or lo_in.min() > q1 else lo_in.min()
        wh = q3 if len(hi_in) == 0 or hi_in.max() < q3 else hi_in.max()
        fliers = x[(x < wl) | (x > wh)]
        out[cat] = (len(x), q1, med, q3, wl, wh, sorted(fliers.tolist()))
    return out


def _check_box(stats_rows, expected):
    assert {r.category for r in stats_rows} == set(expected)
    for r in stats_rows:
        n, q1, med, q3, wl, wh, _ = expected[r.category]
        assert r.n == n
        assert [r.q1, r.median, r.q3, r.whisker_low, r.whisker_high] == [q1, med, q3, wl, wh]


def test_box_stats_on_driver_table(spark):
    df = spark.read.parquet(f"{SF}/orders.parquet")
    groups = {}
    for r in df.select("o_orderpriority", "o_totalprice").collect():
        groups.setdefault(r[0], []).append(r[1])
    _check_box(box_stats(df, "o_totalprice", "o_orderpriority").collect(), _brute_box(groups))


def test_box_stats_hot_category_spans_partitions(spark):
    # One category holds ~90% of the rows, with many repeated values.
    rows = [("hot", float(i % 997) * 0.5) for i in range(9000)]
    rows += [("cold", float(i) ** 1.5) for i in range(700)] + [("tiny", 4.0)]
    rows += [("hot", 1e6), ("hot", -1e6)]
    df = spark.createDataFrame(rows, "cat string, v double")
    groups = {}
    for c, v in rows:
        groups.setdefault(c, []).append(v)
    expected = _brute_box(groups)
    _check_box(box_stats(df, "v", "cat").collect(), expected)
    flagged = outliers(df, "v", "cat").collect()
    got = {}
    for r in flagged:
        got.setdefault(r.cat, []).append(r.v)
    for cat, e in expected.items():
        assert sorted(got.get(cat, [])) == e[6]


def test_box_stats_weighted_equals_expanded(spark):
    df = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_linestatus", "l_quantity")
    direct = {r.category: r for r in box_stats(df, "l_quantity", "l_linestatus").collect()}
    folded = consolidate(df)
    weighted = {r.category: r for r in box_stats(folded, "l_quantity", "l_linestatus", weight="occurrences").collect()}
    assert direct.keys() == weighted.keys()
    for k in direct:
        assert tuple(direct[k]) == tuple(weighted[k])


def test_box_without_category_and_approx(spark):
    df = spark.read.parquet(f"{SF}/events.parquet")
    exact = box_stats(df, "value").collect()
    assert len(exact) == 1 and exact[0].category == "value" and exact[0].n == df.count()
    approx = quartiles(df, "value", exact=False).first()
    assert abs(approx.median - exact[0].median) <= (exact[0].q3 - exact[0].q1)
    with pytest.raises(ValueError):
        box_stats(df, "value", weight="user_id", exact=False)
    with pytest.raises(ValueError):
        quartiles(df, "value", weight="user_id", exact=False)


def test_any_number_of_categories(spark, monkeypatch):
    from foldline.operators import describe
    many = spark.createDataFrame([(f"c{i % 60}", float(i * i % 101)) for i in range(900)], "c string, v double")
    assert category_count(many, "c", 100) == 60
    with pytest.raises(ValueError):
        check_category_count(many, "c")  # a caller about to draw may ask
    groups = {}
    for c, v in many.collect():
        groups.setdefault(c, []).append(v)
    expected = _brute_box(groups)
    fliers = sorted((c, v) for c, e in expected.items() for v in e[6])
    for bound in (10_000, 5):  # broadcast state, then a planned join
        monkeypatch.setattr(describe, "SMALL_STATE", bound)
        _check_box(box_stats(many, "v", "c").collect(), expected)
        assert sorted(map(tuple, outliers(many, "v", "c").collect())) == fliers
    got = [r.category for r in ordered_categories(many, "c").orderBy("position").collect()]
    assert got == sorted(groups)


def test_quartiles_with_a_coarse_sketch_stay_exact(spark):
    rows = [(float((i * 7919) % 5003) ** 2,) for i in range(6000)] + [(7.0,)] * 3000
    df = spark.createDataFrame(rows, "v double").repartition(5)
    expected = _brute_box({"v": [v for v, in rows]})
    for accuracy in (50, 200, 10_000):
        _check_box(box_stats(df, "v", accuracy=accuracy).collect(), expected)


def test_empty_frames_and_bad_weights_raise(spark):
    empty = spark.createDataFrame([], "c string, v double, w int")
    for call in (lambda: box_stats(empty, "v"), lambda: quartiles(empty, "v", "c"), lambda: outliers(empty, "v", "c"),
                 lambda: scatter_points(empty, "v", "w"), lambda: histogram(empty, "v"), lambda: box_stats(empty, "v", weight="w")):
        with pytest.raises(ValueError):
            call()
    for weight in (None, -1):
        bad = spark.createDataFrame([("a", 1.0, 1), ("a", 2.0, weight)], "c string, v double, w int")
        with pytest.raises(ValueError):
            histogram(bad, "v", weight="w")
        with pytest.raises(ValueError):
            box_stats(bad, "v", "c", weight="w")


def test_ordered_categories(spark):
    df = spark.createDataFrame([("b",), ("B",), ("a",), ("C",), ("a",)], "c string")
    got = [r.category for r in ordered_categories(df, "c").orderBy("position").collect()]
    assert got == sorted({"b", "B", "a", "C"}, key=lambda s: (s.lower(), s))


def test_scatter_points_repeatable(spark):
    df = spark.read.parquet(f"{SF}/orders.parquet")
    a = scatter_points(df, "o_totalprice", "o_custkey", key="o_orderkey", max_rows=50).collect()
    b = scatter_points(df.repartition(7), "o_totalprice", "o_custkey", key="o_orderkey", max_rows=50).collect()
    assert a == b and len(a) == 50
    assert dict(scatter_points(df, "o_totalprice", "o_custkey").dtypes) == {
        "o_totalprice": "double", "o_custkey": "double"}
    assert scatter_points(df, "o_totalprice", "o_custkey", max_rows=10).count() == 10
    with pytest.raises(ValueError):
        scatter_points(df, "o_totalprice", "o_custkey", max_rows=0)


def test_max_rows_cap_is_consistent(spark):
    df = spark.read.parquet(f"{SF}/orders.parquet")
    h = histogram(df, "o_totalprice", bins=5, max_rows=100)
    assert sum(r.frequency for r in h.collect()) == 100
    assert limit_rows(df, 5, order_by=["o_orderkey"]).count() == 5


def test_boolean_categories_read_like_python(spark):
    df = spark.createDataFrame([(True, 1.0), (False, 2.0), (True, 3.0)], "flag boolean, v double")
    assert {r.category for r in box_stats(df, "v", "flag").collect()} == {"True", "False"}
    assert [r.category for r in ordered_categories(df, "flag").orderBy("position").collect()] == ["False", "True"]
    assert len(outliers(df, "v", "flag").collect()) == 0


def test_dotted_and_spaced_names_everywhere(spark):
    from foldline.operators.columns import drop_incomplete
    df = spark.createDataFrame([(1.0, "x"), (None, "y"), (3.0, "x"), (2.0, None)], "`a.b` double, `c d` string")
    assert drop_incomplete(df, ["a.b"]).count() == 3
    assert sum(r.frequency for r in histogram(df, "a.b", bins=2).collect()) == 3
    assert [r.n for r in box_stats(df, "a.b", "c d").collect()] == [2]
    assert outliers(df, "a.b", "c d").count() == 0
    pts = scatter_points(df.withColumn("k", df["`a.b`"]), "a.b", "k", key="c d").collect()
    assert len(pts) == 3
    assert ordered_categories(df, "c d").count() == 2


def test_box_weights_must_be_counts(spark):
    df = spark.createDataFrame([(1.0, 2, 1.5), (5.0, 0, 0.5), (3.0, 1, 1.0)], "v double, w int, f double")
    with pytest.raises(ValueError):
        box_stats(df, "v", weight="f")
    r = box_stats(df, "v", weight="w").first()
    # the zero-weight value 5.0 is no observation: data is [1, 1, 3]
    assert (r.n, r.q1, r.median, r.q3, r.whisker_high) == (3, 1.0, 1.0, 2.0, 3.0)


def test_histogram_range_too_wide(spark):
    df = spark.createDataFrame([(-1e308,), (1e308,)], "v double")
    with pytest.raises(ValueError):
        histogram(df, "v", bins=3)


def test_histogram_bins_finer_than_floats(spark):
    df = spark.createDataFrame([(1.0,), (1.0 + 2.2e-16,)], "v double")
    with pytest.raises(ValueError):
        histogram(df, "v", bins=50)


def _wide_rows():
    import random

    rng = random.Random(4)
    rows = [("wide", rng.choice([-1, 1]) * 10.0 ** rng.uniform(-300, 300)) for _ in range(300)]
    rows += [("wide", 0.0)] * 9 + [("wide", -0.0)] * 3 + [("wide", 5e-324)] * 4 + [("wide", 1.7e308), ("wide", -1.7e308)]
    rows += [("near", 1.0 + i * 2.0 ** -52) for i in range(101)]  # neighbours in floating point
    rows += [("same", 7.25)] * 50 + [("one", 3.0)] + [("two", -1.0), ("two", 2.0)]
    rows += [("heavy", rng.random()) for _ in range(100)] + [("heavy", 1e300)] * 2
    return rows


@pytest.mark.parametrize("cells,weighted", [(4, False), (4, True), (4096, True)])
def test_quartiles_by_rounds(spark, monkeypatch, cells, weighted):
    """Few cells mean many rounds; the result stays that of NumPy, and spans stay bounded."""
    from foldline.operators import describe

    monkeypatch.setattr(describe, "CELLS", cells)
    spans, sizes = describe._spans, []

    def counted(*arguments):
        found = spans(*arguments)
        sizes.append(max(r["count"] for r in found.groupBy("category").count().collect()))
        return found

    monkeypatch.setattr(describe, "_spans", counted)
    rows = _wide_rows()
    groups = {}
    if weighted:
        frame = spark.createDataFrame([(c, v, 1 + i % 3) for i, (c, v) in enumerate(rows)] + [("none", 1.0, 0)], "cat string, v double, w int")
        for i, (c, v) in enumerate(rows):
            groups.setdefault(c, []).extend([v] * (1 + i % 3))
    else:
        frame = spark.createDataFrame(rows, "cat string, v double")
        for c, v in rows:
            groups.setdefault(c, []).append(v)
    got = quartiles(frame, "v", "cat", weight="w" if weighted else None, accuracy=20).collect()
    assert {r.category: (r.n, r.q1, r.median, r.q3) for r in got} == {
        c: (len(v), *np.percentile(np.array(v), [25, 50, 75])) for c, v in groups.items()}
    assert max(sizes) <= 3 * (cells + 1) + 1
    if cells == 4:
        assert len(sizes) > 3


def test_more_categories_than_may_be_broadcast(spark, monkeypatch):
    """Beyond SMALL_STATE rows of state the frame is written once and joined."""
    from foldline.operators import describe

    monkeypatch.setattr(describe, "SMALL_STATE", 3)
    written, freeze = [], describe._freeze
    monkeypatch.setattr(describe, "_freeze", lambda df, purpose, *rest: written.append(purpose) or freeze(df, purpose, *rest))
    rows = [(f"c{i % 7}", float((i * 37) % 101)) for i in range(500)] + [("c0", 1e6)]
    frame = spark.createDataFrame(rows, "cat string, v double")
    groups = {}
    for c, v in rows:
        groups.setdefault(c, []).append(v)
    expected = _brute_box(groups)
    _check_box(box_stats(frame, "v", "cat").collect(), expected)
    assert set(written) == {"category-state"}
    assert sorted((r.cat, r.v) for r in outliers(frame, "v", "cat").collect()) == sorted((c, v) for c, e in expected.items() for v in e[6])


def test_category_order_spreads_over_partitions(spark, monkeypatch):
    """All categories begin alike; they are still placed in as many tasks as there are ranges."""
    from foldline.operators import describe

    frozen, freeze = [], describe._freeze
    monkeypatch.setattr(describe, "_freeze", lambda df, purpose, *rest: frozen.append(freeze(df, purpose, *rest)) or frozen[-1])
    names = [f"Customer#{i:05d}" for i in range(3000)] + ["customer#00007", "CUSTOMER#00007", None, "customer#00007"]
    frame = spark.createDataFrame([(n,) for n in names], "name string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.category: r.position for r in ordered_categories(frame, "name").collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    expected = sorted({n for n in names if n}, key=lambda n: (n.lower(), n))
    assert got == {n: i + 1 for i, n in enumerate(expected)}
    sizes = [r["count"] for r in frozen[0].selectExpr("shiftright(_id, 33) AS p").groupBy("p").count().collect()]
    assert len(sizes) >= 6 and max(sizes) < len(expected) / 3
    assert ordered_categories(frame.limit(0), "name").collect() == []
