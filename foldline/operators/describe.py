"""The data behind histogram, box-plot and scatter diagrams.

The statistics are computed by Spark over all rows (or over the first ``max_rows`` when a cap is
asked for); only scalars and rows of per-category state of a checked size reach the driver. No image
is rendered. Histogram bins and quartiles follow NumPy (and so the plotting library) bit for bit.

Scale notes
-----------
* Histogram: one min/max/count aggregate, then a ``groupBy(bin)`` with at most 100 keys; both are
  partial aggregates, so a hot value costs nothing extra.
* Box statistics: exact quartiles by narrowing, without a shuffle of rows. A first pass brackets the
  wanted ranks per category (a quantile sketch; all values for weighted rows). Each round then folds
  the rows outside the brackets to a few counts and those inside to counts of CELLS cells, as partial
  aggregates; running counts over these, a fixed number a category, give the ranks or the cells that
  hold them, which are the next round's brackets. Small inputs are done after one round.
* Any number of categories: per-category state is evaluated once a round and goes to the rows as
  literals (one group), as a broadcast of at most ``SMALL_STATE`` rows, or, beyond, written to the
  shared folder, by a join that Spark plans by size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import col, drop_nulls, positive_int, resolve
from ..functions.values import finite_double
from ..session import scratch_dir

# Histogram bins default to 10 and must lie in 1..100; a box plot
# shows at most 20 categories; whiskers reach 1.5 interquartile ranges; the
# quartiles are the 25th, 50th and 75th percentiles.
DEFAULT_BINS = 10
MAX_BINS = 100
MAX_CATEGORIES = 20
WHISKER_REACH = 1.5
# Rows of per-category state that may be broadcast; more go through a planned join.
SMALL_STATE = 10_000
# Cells into which a round divides each range of values that still holds a wanted rank.
CELLS = 4096
QUARTILES = (("q1", 0.25), ("median", 0.5), ("q3", 0.75))


# --------------------------------------------------------------------- helpers


def _values(
    df: DataFrame, columns: Sequence[str], max_rows: int | None, weight: str | None = None
) -> DataFrame:
    """P3 + P4 (+ L1): the selected columns without null/NaN rows, optionally capped.

    Rows are never dropped for their weight; ``_require_rows`` refuses bad weights.

    A capped frame is written once to the shared checkpoint folder so that every
    later pass sees the same ``max_rows`` rows (``limit`` alone may pick other
    rows on each evaluation).
    """
    wanted = [*columns, weight] if weight else columns
    data = drop_nulls(df.select(*[col(c) for c in wanted]), columns)
    if max_rows is not None:
        data = _freeze(data.limit(positive_int(max_rows, "max_rows")), "capped-rows")
    return data


def _freeze(df: DataFrame, purpose: str, partition_column: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back.

    Cuts the lineage (a retry re-reads the files instead of recomputing
    nondeterministic steps such as sampled range bounds or ``limit``).
    """
    path = scratch_dir(df.sparkSession, purpose)
    writer = df.write.mode("errorifexists")
    if partition_column:
        writer = writer.partitionBy(partition_column)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def _bad_weights(weight: str) -> Column:
    """Number of weights that are no count; part of the aggregate that runs anyway."""
    w = F.col(weight)
    return F.count(F.when(w.isNull() | (w < 0) | F.isnan(w.cast("double")), 1)).alias("bad_weights")


def _require_rows(row) -> None:
    if row is None or row["n"] == 0:
        raise ValueError("the frame holds no data for the diagram")
    if row["bad_weights"]:
        raise ValueError(f"{row['bad_weights']} rows have a null or negative weight")


def limit_rows(df: DataFrame, max_rows: int, order_by: Sequence[str] | None = None) -> DataFrame:
    """L1: at most ``max_rows`` rows; with ``order_by`` the same rows every time."""
    n = positive_int(max_rows, "max_rows")
    if order_by:
        df = df.orderBy(*[col(resolve(df, c)) for c in order_by])
    return df.limit(n)


def category_count(df: DataFrame, category: str | Column, limit: int = MAX_CATEGORIES) -> int:
    """Number of distinct categories, counted only up to ``limit + 1``."""
    expr = col(category) if isinstance(category, str) else category
    return df.select(expr.alias("_c")).distinct().limit(limit + 1).count()


def check_category_count(df: DataFrame, category: str | Column, limit: int = MAX_CATEGORIES) -> None:
    """D4 for a caller that is about to draw one picture; no operator here enforces it."""
    if category_count(df, category, limit) > limit:
        raise ValueError(f"a box plot can show at most {limit} categories")


def ordered_categories(df: DataFrame, category: str) -> DataFrame:
    """L2: distinct categories with their case-insensitive display position, any number of them.

    Categories are range-partitioned by sort key, ties by the category itself, and written with
    their place in their partition; counts of the partitions (one row each) give the offsets.
    """
    name = resolve(df, category)
    cats = drop_nulls(df, [name]).select(category_text(df, name).alias("category")).distinct()
    order = [F.lower("category"), F.col("category")]
    ranged = cats.repartitionByRange(*order).sortWithinPartitions(*order)
    # The id has the partition in its upper 31 bits and the row's place in it in the lower 33.
    placed = _freeze(ranged.withColumn("_id", F.monotonically_increasing_id()), "category-order")
    part = F.shiftright("_id", 33).alias("_part")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy(part).count().select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    place = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    rows = placed.select("category", part, place.alias("_place")).join(offsets, "_part")
    return rows.select("category", (F.col("_before") + F.col("_place")).cast("bigint").alias("position"))


# ------------------------------------------------------------------- histogram


def histogram(
    df: DataFrame,
    column: str,
    bins: int = DEFAULT_BINS,
    weight: str | None = None,
    max_rows: int | None = None,
) -> DataFrame:
    """Equal-width bins over [min, max], the last bin closed.

    Returns every bin (empty ones with frequency 0): ``bin`` int,
    ``bin_start``, ``bin_end`` double, ``frequency`` (row count, or the sum of
    ``weight``). Binning follows NumPy's rule exactly: the edges are
    ``i * step + lo`` (the last edge is ``hi``), a value's first guess is
    ``floor((v - lo) / (hi - lo) * bins)``, corrected by one bin when it falls
    on the wrong side of an edge. When all values are equal the range is
    widened to ``value +- 0.5``.
    """
    name = resolve(df, column)
    positive_int(bins, "bins", MAX_BINS)
    wname = resolve(df, weight) if weight is not None else None
    data = _values(df, [name], max_rows, wname)
    freq = col(wname) if wname else F.lit(1).cast("bigint")
    points = data.select(finite_double(name).alias("v"), freq.alias("f"))

    row = points.agg(
        F.min("v").alias("lo"), F.max("v").alias("hi"), F.count(F.lit(1)).alias("n"), _bad_weights("f")
    ).first()
    _require_rows(row)
    lo, hi = float(row["lo"]), float(row["hi"])
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    span = hi - lo
    step = span / bins
    # The (at most 101) edges as the job computes them; they must rise strictly.
    edge_values = [i * step + lo for i in range(bins)] + [hi]
    if span == float("inf") or any(a >= b for a, b in zip(edge_values, edge_values[1:])):
        raise ValueError(f"cannot make {bins} finite-sized bins over [{lo}, {hi}] of {name!r}")

    def edge(i: Column) -> Column:
        return F.when(i == F.lit(bins), F.lit(hi)).otherwise(i.cast("double") * F.lit(step) + F.lit(lo))

    v = F.col("v")
    guess = F.least(F.floor((v - F.lit(lo)) / F.lit(span) * F.lit(bins)), F.lit(bins - 1)).cast("int")
    below = F.when(v < edge(guess), guess - 1).otherwise(guess)
    above = F.when((below != F.lit(bins - 1)) & (v >= edge(below + 1)), below + 1).otherwise(below)
    # One zero row per bin (at most MAX_BINS rows, generated by Spark) makes
    # every bin appear in the single aggregate, so empty bins need no join.
    zeros = df.sparkSession.range(bins).select(
        F.col("id").cast("int").alias("bin"), F.lit(0).cast(points.schema["f"].dataType).alias("f")
    )
    binned = points.select(above.alias("bin"), "f").unionByName(zeros)
    counts = binned.groupBy("bin").agg(F.sum("f").alias("frequency"))
    return counts.select(
        "bin",
        edge(F.col("bin")).alias("bin_start"),
        edge(F.col("bin") + 1).alias("bin_end"),
        "frequency",
    )


# ---------------------------------------------------------------- box statistics


def _box_input(
    df: DataFrame,
    value: str,
    category: str | None,
    weight: str | None,
    max_rows: int | None,
) -> DataFrame:
    """(category string, value double, w) rows after P4 and P5. A zero weight is no observation."""
    vname = resolve(df, value)
    cname = resolve(df, category) if category is not None else None
    wname = resolve(df, weight) if weight is not None else None
    data = _values(df, [c for c in (cname, vname) if c], max_rows, wname)
    # Without a category the single group is named after the value column.
    cat = category_text(data, cname) if cname else F.lit(vname)
    w = F.lit(1).cast("bigint")
    if wname is not None:
        if not isinstance(data.schema[wname].dataType, T.IntegralType):
            raise ValueError(f"weight column {wname!r} must hold whole counts (an integer type)")
        w = col(wname).cast("bigint")
    return data.select(cat.alias("category"), finite_double(vname).alias("value"), w.alias("w"))


def category_text(df: DataFrame, name: str) -> Column:
    """A category as text; booleans read True/False as the plotted labels do."""
    if isinstance(df.schema[name].dataType, T.BooleanType):
        return F.when(col(name), F.lit("True")).otherwise(F.lit("False"))
    return col(name).cast("string")


def _attach(rows: DataFrame, state: DataFrame, single: bool) -> DataFrame:
    """``rows`` with the columns of ``state`` (one row per category); see ``_known``."""
    return _joined(rows, *_known(state, single))


def _known(state: DataFrame, single: bool) -> tuple[list | None, DataFrame]:
    """``state``, evaluated once: its rows at the driver if they are SMALL_STATE at most, and a frame
    of them; else None and the frame written to the shared folder."""
    state = state.persist()
    try:
        found = state.limit(1 if single else SMALL_STATE + 1).collect()
        if len(found) <= SMALL_STATE:
            return found, state.sparkSession.createDataFrame(found, state.schema)
        return None, _freeze(state, "category-state")
    finally:
        state.unpersist()


def _joined(rows: DataFrame, found: list | None, state: DataFrame) -> DataFrame:
    """One category: its state as literals. Up to SMALL_STATE: a broadcast of just these rows, so the
    data stays where it is. More: an ordinary join."""
    if found is not None and len(found) == 1:
        fields = [f for f in state.schema.fields if f.name != "category"]
        own = F.col("category") == F.lit(found[0]["category"])
        return rows.where(own).select("*", *[_literal(found[0][f.name], f.dataType).alias(f.name) for f in fields])
    return rows.join(F.broadcast(state) if found is not None else state, "category")


def _literal(value, data_type: T.DataType) -> Column:
    if isinstance(value, (list, tuple)):
        return F.array(*[F.lit(v) for v in value]).cast(data_type)
    return F.lit(value).cast(data_type)


def _first_brackets(rows: DataFrame, weighted: bool, accuracy: int) -> DataFrame:
    """Per category: ``n`` (rows, or their weights), ``bad_weights``, and a bracket of values around
    each quartile, ``low`` and ``high`` of one array entry a quartile.

    Unweighted rows are bracketed by a quantile sketch: one of accuracy a finds a quantile up to
    1/a of the rows, and brackets reach 4/a to both sides. Weighted rows start from all values."""
    size = len(QUARTILES)
    if weighted:
        counted = F.when(F.col("w") > 0, F.col("value"))
        state = rows.groupBy("category").agg(
            F.sum(F.when(F.col("w") > 0, F.col("w"))).alias("n"), _bad_weights("w"),
            F.min(counted).alias("_lo"), F.max(counted).alias("_hi"))
        low, high = (F.array(*[F.col(c)] * size) for c in ("_lo", "_hi"))
    else:
        reach = 4.0 / accuracy
        points = [min(1.0, max(0.0, p + side * reach)) for _, p in QUARTILES for side in (-1, 1)]
        found = F.percentile_approx("value", F.array(*map(F.lit, points)), F.lit(accuracy))
        state = rows.groupBy("category").agg(
            F.sum("w").alias("n"), F.lit(0).cast("bigint").alias("bad_weights"), found.alias("_q"))
        low, high = (F.array(*[F.col("_q")[2 * i + k] for i in range(size)]) for k in (0, 1))
    return state.select("category", "n", "bad_weights", low.alias("low"), high.alias("high"))


def _magnitude(v: Column) -> Column:
    """A function that never falls as ``v`` rises, one unit for each doubling on either side of zero."""
    size = F.log2(F.abs(v)) + F.lit(1075.0)
    return F.when(v == 0, F.lit(0.0)).when(v > 0, size).otherwise(-size)


def _cell(v: Column, low: Column, high: Column) -> Column:
    """The cell of ``v`` among CELLS between low and high: equal steps between numbers of a like
    size, equal steps of their logarithms else. The ends come into the first and the last cell."""
    near = (low == high) | (F.abs(_magnitude(high) - _magnitude(low)) <= 1)
    share = F.when(near, (v - low) / F.nullif(high - low, F.lit(0.0))).otherwise(
        (_magnitude(v) - _magnitude(low)) / F.nullif(_magnitude(high) - _magnitude(low), F.lit(0.0)))
    return F.least(F.floor(F.coalesce(share, F.lit(0.0)) * CELLS), F.lit(CELLS - 1)).cast("int")


def _spans(rows: DataFrame, known_state: list | None, state: DataFrame) -> DataFrame:
    """The rows folded by category and span: one span a gap for rows outside the brackets of
    ``state``, one a cell for those inside, with the summed weight, smallest and largest value. Spans
    do not overlap, and a category has (number of quartiles) x (CELLS + 1) + 1 of them at most."""
    marked = _joined(rows, known_state, state)
    v, place, gap = F.col("value"), F.lit(None).cast("int"), F.lit(0)
    for i in reversed(range(len(QUARTILES))):
        low, high = F.get("low", F.lit(i)), F.get("high", F.lit(i))
        place = F.when((v >= low) & (v <= high), F.lit(i * CELLS) + _cell(v, low, high)).otherwise(place)
        gap = gap + F.when(v > high, 1).otherwise(0)
    return marked.groupBy("category", F.coalesce(place, -1 - gap).alias("span")).agg(
        F.sum("w").alias("w"), F.min("value").alias("first"), F.max("value").alias("last"))


def _narrowed(rows: DataFrame, known_state: list | None, state: DataFrame) -> DataFrame:
    """One round: from ``state``, each category's n, low, high and ``found`` (the values at the
    wanted ranks, null while unknown), that state anew.

    Running weights over a category's spans, a bounded number whatever its rows, give the span of
    each wanted rank. A rank is known if its span has one value, or if it is the first or last of
    its span; else its span is the next round's bracket."""
    spans = _joined(_spans(rows, known_state, state), known_state, state)
    running = Window.partitionBy("category").orderBy("first").rowsBetween(Window.unboundedPreceding, 0)
    spans = spans.withColumn("end", F.sum("w").over(running)).withColumn("start", F.col("end") - F.col("w"))
    holding = []
    for j, k in enumerate(_ranks()):
        own = (F.col("start") <= k) & (k < F.col("end"))
        known = F.when((k == F.col("start")) | (F.col("first") == F.col("last")), F.col("first")).when(
            k == F.col("end") - 1, F.col("last"))
        holding.append(F.max(F.when(own, F.struct("first", "last", known.alias("known")))).alias(f"s{j}"))
    picked = spans.groupBy("category").agg(F.first("n").alias("n"), F.first("found").alias("found"), *holding)
    known = [F.coalesce(F.get("found", F.lit(j)), F.col(f"s{j}.known")) for j in range(2 * len(QUARTILES))]
    low, high = [], []
    for i in range(len(QUARTILES)):
        both = known[2 * i].isNotNull() & known[2 * i + 1].isNotNull()
        low.append(F.coalesce(known[2 * i], F.col(f"s{2 * i}.first")))
        high.append(F.when(both, known[2 * i]).otherwise(F.coalesce(known[2 * i + 1], F.col(f"s{2 * i + 1}.last"))))
    return picked.select("category", "n", F.array(*low).alias("low"), F.array(*high).alias("high"), F.array(*known).alias("found"))


def _ranks() -> list[Column]:
    """The ranks (from 0) below and above each quartile."""
    at = [(F.col("n") - 1) * F.lit(p) for _, p in QUARTILES]
    return [side(h).cast("bigint") for h in at for side in (F.floor, F.ceil)]


def _exact_quartiles(rows: DataFrame, weighted: bool, accuracy: int, single: bool) -> DataFrame:
    """``category, n, q1, median, q3``: the values at the ranks next to each quartile, interpolated
    as NumPy does. Rounds of ``_narrowed`` go on until all ranks are known; each makes the brackets
    CELLS times narrower, and at least splits the smallest from the largest value inside."""
    found, state = _known(_first_brackets(rows, weighted, accuracy), single)
    checks = found if found is not None else state.agg(F.sum("n").alias("n"), F.sum("bad_weights").alias("bad_weights")).collect()
    _require_rows({"n": sum(r["n"] or 0 for r in checks), "bad_weights": sum(r["bad_weights"] or 0 for r in checks)})
    if weighted:
        rows = rows.where("w > 0")
    unknown = F.array_repeat(F.lit(None).cast("double"), 2 * len(QUARTILES))
    state = state.where("n > 0").drop("bad_weights").withColumn("found", unknown)
    if found is not None:
        found = [T.Row(**{**r.asDict(), "found": [None] * (2 * len(QUARTILES))}) for r in found if r["n"]]
    while True:
        found, state = _known(_narrowed(rows, found, state), single)
        is_open = F.exists("found", lambda x: x.isNull())
        if not (any(None in r["found"] for r in found) if found is not None else not state.where(is_open).isEmpty()):
            break
    out = []
    for i, (label, p) in enumerate(QUARTILES):
        h = (F.col("n") - 1) * F.lit(p)
        share, low, high = h - F.floor(h), F.get("found", F.lit(2 * i)), F.get("found", F.lit(2 * i + 1))
        # NumPy's linear interpolation, including its form for shares from one half on.
        from_low, from_high = low + (high - low) * share, high - (high - low) * (F.lit(1.0) - share)
        out.append(F.when(share >= F.lit(0.5), from_high).otherwise(from_low).alias(label))
    return state.select("category", F.col("n").cast("bigint").alias("n"), *out)


def _quartiles_of(rows: DataFrame, weighted: bool, exact: bool, accuracy: int, single: bool) -> DataFrame:
    if weighted and not exact:
        raise ValueError("weights need exact=True")
    if exact:
        return _exact_quartiles(rows, weighted, accuracy, single)
    if rows.isEmpty():
        raise ValueError("the frame holds no data for the diagram")
    probabilities = F.array(*[F.lit(p) for _, p in QUARTILES])
    found = rows.groupBy("category").agg(
        F.sum("w").alias("n"), F.percentile_approx("value", probabilities, accuracy).alias("_q"))
    return found.select("category", "n", *[F.col("_q")[i].alias(label) for i, (label, _) in enumerate(QUARTILES)])


def quartiles(
    df: DataFrame,
    value: str,
    category: str | None = None,
    weight: str | None = None,
    max_rows: int | None = None,
    exact: bool = True,
    accuracy: int = 10000,
) -> DataFrame:
    """Per-category ``n, q1, median, q3`` (the first half of D2).

    ``accuracy`` is that of the quantile sketch: the result with ``exact=False``, and the width of
    the first brackets otherwise, which decides how many rounds are needed, not the result. Weights must be whole counts, not null and not negative. A frame without rows raises
    ValueError. A floating category reads as Spark casts it to text (``1.0E7``).
    """
    rows = _box_input(df, value, category, weight, max_rows)
    return _quartiles_of(rows, weight is not None, exact, positive_int(accuracy, "accuracy"), category is None)


def _with_fences(stats: DataFrame) -> DataFrame:
    iqr = F.col("q3") - F.col("q1")
    return stats.withColumn("fence_low", F.col("q1") - F.lit(WHISKER_REACH) * iqr).withColumn(
        "fence_high", F.col("q3") + F.lit(WHISKER_REACH) * iqr
    )


def box_stats(
    df: DataFrame,
    value: str,
    category: str | None = None,
    weight: str | None = None,
    max_rows: int | None = None,
    exact: bool = True,
    accuracy: int = 10000,
) -> DataFrame:
    """``category, n, q1, median, q3, whisker_low, whisker_high`` per category.

    Whiskers are the most extreme data values within 1.5 IQR of the box, never inside the box (the
    plotting library's rule). Arguments and errors are those of ``quartiles``.
    """
    rows = _box_input(df, value, category, weight, max_rows)
    stats = _quartiles_of(rows, weight is not None, exact, positive_int(accuracy, "accuracy"), category is None)
    keys = ["category", "n", "q1", "median", "q3"]
    marked = _attach(rows.where("w > 0").drop("w"), _with_fences(stats), category is None)
    reach = marked.groupBy(*keys).agg(
        F.min(F.when(F.col("value") >= F.col("fence_low"), F.col("value"))).alias("_wl"),
        F.max(F.when(F.col("value") <= F.col("fence_high"), F.col("value"))).alias("_wh"),
    )
    return reach.select(
        *keys,
        F.least(F.col("q1"), F.coalesce("_wl", "q1")).alias("whisker_low"),
        F.greatest(F.col("q3"), F.coalesce("_wh", "q3")).alias("whisker_high"),
    )


def outliers(
    df: DataFrame,
    value: str,
    category: str | None = None,
    exact: bool = True,
    accuracy: int = 10000,
) -> DataFrame:
    """D3: the input rows lying beyond the whiskers (the box plot's fliers).

    The fences go to the rows (see ``_attach``), which are filtered where they are.
    """
    vname = resolve(df, value)
    cname = resolve(df, category) if category is not None else None
    stats = quartiles(df, vname, cname, exact=exact, accuracy=accuracy)
    fences = _with_fences(stats).select("category", "fence_low", "fence_high")
    clean = drop_nulls(df, [c for c in (cname, vname) if c])
    packed = clean.select(
        (category_text(clean, cname) if cname else F.lit(vname)).alias("category"),
        finite_double(vname).alias("_v"),
        F.struct(*[col(c) for c in df.columns]).alias("_row"),
    )
    beyond = (F.col("_v") < F.col("fence_low")) | (F.col("_v") > F.col("fence_high"))
    return _attach(packed, fences, cname is None).where(beyond).select("_row.*")


# ---------------------------------------------------------------------- scatter


def scatter_points(
    df: DataFrame,
    x: str,
    y: str,
    key: str | None = None,
    max_rows: int | None = None,
) -> DataFrame:
    """All (x, y) pairs as doubles, or a sample of ``max_rows`` where one is asked for.

    With ``key`` (kept as first column) the sample is repeatable: the rows with the smallest
    ``md5(key)`` (ties by key), a top-k that keeps at most ``max_rows`` rows per task before one
    merge. Without it, any ``max_rows`` rows. A frame without rows raises ValueError.
    """
    xn, yn = resolve(df, x), resolve(df, y)
    kn = resolve(df, key) if key is not None else None
    data = drop_nulls(df, [xn, yn])
    if data.isEmpty():
        raise ValueError("the frame holds no data for the diagram")
    out = [finite_double(xn).alias(xn), finite_double(yn).alias(yn)]
    out = out if kn is None else [col(kn), *out]
    if max_rows is None:
        return data.select(*out)
    n = positive_int(max_rows, "max_rows")
    if kn is not None:
        data = data.orderBy(F.md5(col(kn).cast("string")), col(kn))
    return data.limit(n).select(*out)
