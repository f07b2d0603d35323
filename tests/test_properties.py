"""Random small fixtures against brute force (NumPy)."""

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from foldline.operators.describe import box_stats, histogram, outliers

values = st.one_of(
    st.integers(-50, 50).map(float),
    st.floats(-1e6, 1e6, allow_nan=False, allow_infinity=False),
)
rows = st.lists(st.tuples(st.sampled_from(["a", "B", "c"]), values), min_size=1, max_size=60)


def _brute(vals):
    x = np.sort(np.asarray(vals, dtype=float))
    q1, med, q3 = np.percentile(x, [25, 50, 75])
    iqr = q3 - q1
    lo_in, hi_in = x[x >= q1 - 1.5 * iqr], x[x <= q3 + 1.5 * iqr]
    wl = q1 if len(lo_in) == 0 or lo_in.min() > q1 else lo_in.min()
    wh = q3 if len(hi_in) == 0 or hi_in.max() < q3 else hi_in.max()
    return len(x), q1, med, q3, wl, wh, sorted(x[(x < q1 - 1.5 * iqr) | (x > q3 + 1.5 * iqr)].tolist())


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows, st.integers(1, 9))
def test_box_stats_match_numpy(spark, data, parts):
    df = spark.createDataFrame(data, "cat string, v double")
    groups = {}
    for c, v in data:
        groups.setdefault(c, []).append(v)
    got = {r.category: r for r in box_stats(df, "v", "cat").collect()}
    assert set(got) == set(groups)
    for c, vals in groups.items():
        n, q1, med, q3, wl, wh, fl = _brute(vals)
        r = got[c]
        assert r.n == n
        # bit-for-bit equal to NumPy (and so to the plotting library)
        assert [r.q1, r.median, r.q3, r.whisker_low, r.whisker_high] == [q1, med, q3, wl, wh]
    flagged = sorted((r.cat, r.v) for r in outliers(df, "v", "cat").collect())
    expect = sorted((c, v) for c, vals in groups.items() for v in _brute(vals)[6])
    assert flagged == expect


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(values, min_size=1, max_size=80), st.integers(1, 100), st.booleans())
def test_histogram_matches_numpy(spark, vals, bins, with_edges):
    if with_edges and max(vals) > min(vals):
        # values lying exactly on NumPy's bin edges are the hard cases
        vals = vals + np.linspace(min(vals), max(vals), bins + 1).tolist()
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = [r.frequency for r in histogram(df, "v", bins=bins).orderBy("bin").collect()]
    expect, _ = np.histogram(np.asarray(vals), bins=bins)
    assert got == expect.tolist()
    assert sum(got) == len(vals)
