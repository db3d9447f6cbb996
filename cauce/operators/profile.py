"""Table profiling (P9, A6-A12): schema report, null rates, frequencies, descriptive
statistics, histogram, box-plot statistics, correlations, scatter pairs.

Every report is one or a few aggregate jobs with partial aggregation; nothing collects a
column to the driver. Quantiles are exact by default, computed without sorting a whole
group in one task (see ``quantiles``); ``method="approx"`` uses a bounded sketch instead.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cauce.operators.reshape import long_to_wide
from cauce.operators.columns import numeric_columns, q
from cauce.operators.joins import broadcast_if_small
from cauce.session import persist_for_job


# --- P9 ------------------------------------------------------------------------------
def schema_report(df: DataFrame) -> DataFrame:
    """Per column: name, Spark type, non-null count and table row count (one job)."""
    cols = df.columns
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count(q(c)).alias(f"__c{i}") for i, c in enumerate(cols)],
    )
    long = counts.unpivot("__rows", [f"__c{i}" for i in range(len(cols))], "__slot", "non_null")
    names = F.create_map(*[x for i, c in enumerate(cols) for x in (F.lit(f"__c{i}"), F.lit(c))])
    types = F.create_map(
        *[x for i, f in enumerate(df.schema.fields) for x in (F.lit(f"__c{i}"), F.lit(f.dataType.simpleString()))]
    )
    return long.select(
        names[F.col("__slot")].alias("column"),
        types[F.col("__slot")].alias("dtype"),
        F.col("non_null").cast("long").alias("non_null"),
        F.col("__rows").cast("long").alias("rows"),
    )


# --- A7 ------------------------------------------------------------------------------
def null_rates(df: DataFrame, top: int | None = 20) -> DataFrame:
    """Share of nulls per column, highest first (ties by name), ``top`` rows."""
    cols = df.columns
    rates = df.agg(*[F.avg(q(c).isNull().cast("double")).alias(f"__c{i}") for i, c in enumerate(cols)])
    long = rates.unpivot([], [f"__c{i}" for i in range(len(cols))], "__slot", "null_rate")
    names = F.create_map(*[x for i, c in enumerate(cols) for x in (F.lit(f"__c{i}"), F.lit(c))])
    out = long.select(names[F.col("__slot")].alias("column"), "null_rate").orderBy(
        F.desc("null_rate"), F.asc("column")
    )
    return out.limit(top) if top else out


# --- A6 ------------------------------------------------------------------------------
def top_values(df: DataFrame, col: str, k: int = 10, as_text: bool = True) -> DataFrame:
    """Frequency table of ``col`` (nulls counted as their own value), most frequent first,
    ties by value, ``k`` rows. A top-k: only ``k`` rows per partition reach the driver."""
    v = q(col).cast("string") if as_text else q(col)
    return (
        df.groupBy(v.alias("value"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), F.asc_nulls_last("value"))
        .limit(k)
    )


# --- quantiles -----------------------------------------------------------------------
_LARGEST = sys.float_info.max


def _evenly(x: Column, by_size: Column) -> Column:
    """The scale on which an interval is cut evenly (halved, so that no difference of two values
    overflows). ``by_size``: sign and logarithm instead of the value itself; every positive double
    has a logarithm above -750. Neither ever decreases as ``x`` grows."""
    size = F.when(x > 0, F.ln(x) + 750).when(x < 0, -(F.ln(-x) + 750)).otherwise(0.0)
    return F.when(by_size, size).otherwise(x) / 2


def _bucket(buckets: int) -> Column:
    """Number of the bucket of ``__v`` within its interval: -1 its least value, ``buckets`` its largest,
    between them ``buckets`` of even width. A few operations per row, however many buckets."""
    v = F.col("__v")
    share = (_evenly(v, F.col("__by_size")) - F.col("__from")) / F.col("__width")
    return (
        F.when(v == F.col("__lo"), -1).when(v == F.col("__hi"), buckets)
        .when(F.col("__width") > 0, F.least(F.floor(share * buckets), F.lit(buckets - 1))).otherwise(0).cast("int")
    )


def _values(df: DataFrame, col: str, by: Sequence[str]) -> DataFrame:
    """(group..., ``__v``): the non-null, non-NaN values. Without ``by`` the group is a constant ``__g``."""
    base = df.select(*[q(g).alias(g) for g in by], q(col).cast("double").alias("__v"))
    if not by:
        base = base.withColumn("__g", F.lit(0))
    return base.where(F.col("__v").isNotNull() & ~F.isnan("__v"))


def quantiles(
    df: DataFrame,
    col: str,
    probs: Sequence[float],
    by: Sequence[str] = (),
    names: Sequence[str] | None = None,
    method: str = "exact",
    buckets: int = 128,
    accuracy: int = 10_000,
    max_sort_rows: int = 1_000_000,
    totals: DataFrame | None = None,
) -> DataFrame:
    """Quantiles of ``col`` per group with linear interpolation between order statistics
    (pandas/numpy default, SQL ``percentile_cont``). One row per group, one column per
    probability. ``method="approx"`` uses ``percentile_approx`` (bounded sketch of ``accuracy``); the
    exact method is ``selected_quantiles``. Groups that are null are left out."""
    names = list(names or [f"q{int(round(p * 100))}" for p in probs])
    keys = list(by) or ["__g"]
    rows = _values(df, col, by)
    if method == "approx":
        agg = rows.groupBy(*keys).agg(F.percentile_approx("__v", list(probs), accuracy).alias("__q"))
        return agg.select(*by, *[F.col("__q")[i].alias(n) for i, n in enumerate(names)])
    return selected_quantiles(rows, keys, probs, names, buckets, max_sort_rows, totals).select(*by, *names)


def selected_quantiles(
    rows: DataFrame,
    keys: Sequence[str],
    probs: Sequence[float],
    names: Sequence[str],
    buckets: int = 128,
    max_sort_rows: int = 1_000_000,
    totals: DataFrame | None = None,
) -> DataFrame:
    """Exact quantiles of ``rows`` (keys, ``__v``) by selecting ranks on the rows themselves; no table
    of their values is built:
      1. every wanted rank starts with all values of its group and no rows before it (``totals``: keys,
         ``__m`` rows, ``__lo`` least and ``__hi`` largest value, if the caller has them);
      2. an interval of more than ``max_sort_rows`` rows is cut evenly into ``buckets``, its two ends set
         apart. One pass counts the rows of each bucket exactly, with its least and largest value, which
         bound the next interval of the ranks in it; so a bucket of one value ends there. If a bucket keeps
         over half the rows and spans zero or magnitudes, it is cut by magnitude next. Passes shuffle
         bucket counts alone;
      3. an interval of one value is done. What is left of the others, at most ``max_sort_rows``
         rows each, is sorted in a window partition of its own.
    Each level divides an interval's rows by about ``buckets`` where they lie evenly, and always its width
    or its span of magnitudes: the levels are bounded by the digits of a double, whatever the values. The
    driver reads one number per level; the table of ranks (groups x probabilities rows) is checkpointed
    to cut the lineage.
    """
    from cauce.session import checkpoint_root

    keys = list(keys)
    checkpoint_root(rows.sparkSession)
    prob_arr = F.array(*[F.lit(float(p)) for p in probs])
    seg = ["__lo", "__hi"]
    ranks = ["__i", "__pos", "__r"]
    if totals is None:
        totals = rows.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("__m"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi")
        )
    targets = (
        totals.select(*keys, "__m", *seg, F.posexplode(prob_arr).alias("__i", "__p"))
        .withColumn("__pos", (F.col("__m") - 1) * F.col("__p"))
        .withColumn("__r", F.explode(F.array_distinct(F.array(F.floor("__pos"), F.ceil("__pos")))))
        .withColumn("__r", F.col("__r").cast("long"))
        .withColumn("__off", F.lit(0).cast("long"))
        .withColumn("__by_size", F.lit(False))
        .select(*keys, *ranks, *seg, "__off", "__m", "__by_size")
        .checkpoint()
    )

    def inside(segments: DataFrame) -> DataFrame:
        small, _ = broadcast_if_small(segments)
        return rows.join(small, keys).where((F.col("__v") >= F.col("__lo")) & (F.col("__v") <= F.col("__hi")))

    open_ = (F.col("__lo") < F.col("__hi")) & (F.col("__m") > max_sort_rows)
    settled = []
    first = _evenly(F.greatest("__lo", F.lit(-_LARGEST)), F.col("__by_size"))
    last = _evenly(F.least("__hi", F.lit(_LARGEST)), F.col("__by_size"))
    while targets.where(open_).count():
        settled.append(targets.where(~open_))
        targets = targets.where(open_)
        segments = targets.select(
            *keys, *seg, "__off", "__by_size", first.alias("__from"), (last - first).alias("__width")
        ).distinct()
        per = inside(segments).groupBy(*keys, *seg, "__off", _bucket(buckets).alias("__k")).agg(
            F.count(F.lit(1)).alias("__bm"), F.min("__v").alias("__bmin"), F.max("__v").alias("__bmax")
        )
        before = Window.partitionBy(*keys, *seg).orderBy("__k").rowsBetween(Window.unboundedPreceding, -1)
        per = per.withColumn("__start", F.col("__off") + F.coalesce(F.sum("__bm").over(before), F.lit(0))).drop("__off")
        cut = targets.drop("__off").join(per, keys + seg).where(
            (F.col("__r") >= F.col("__start")) & (F.col("__r") < F.col("__start") + F.col("__bm"))
        )
        spans = (
            F.when(F.col("__bmin") > 0, F.col("__bmax") / 16 > F.col("__bmin"))
            .when(F.col("__bmax") < 0, F.col("__bmin") / 16 < F.col("__bmax")).otherwise(True)
        )
        by_size = ~F.col("__by_size") & (F.col("__bm") > F.col("__m") / 2) & spans
        targets = cut.select(
            *keys, *ranks, F.col("__bmin").alias("__lo"), F.col("__bmax").alias("__hi"), F.col("__start").alias("__off"),
            F.col("__bm").alias("__m"), by_size.alias("__by_size"),
        ).checkpoint()
    for more in settled:
        targets = targets.unionByName(more)

    single = F.col("__lo") == F.col("__hi")
    done = targets.where(single).select(*keys, *ranks, F.col("__lo").alias("__v"))
    rest = targets.where(~single)
    few = inside(rest.select(*keys, *seg, "__off").distinct()).groupBy(*keys, *seg, "__off", "__v").agg(F.count(F.lit(1)).alias("__w"))
    run = Window.partitionBy(*keys, *seg).orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    few = few.withColumn("__end", F.col("__off") + F.sum("__w").over(run)).drop("__off")
    picked = rest.drop("__off").join(few, keys + seg).where(
        (F.col("__r") >= F.col("__end") - F.col("__w")) & (F.col("__r") < F.col("__end"))
    )
    picked = done.unionByName(picked.select(*keys, *ranks, "__v"))
    lo = F.min_by("__v", "__r")
    hi = F.max_by("__v", "__r")
    frac = F.first("__pos") - F.min("__r")
    per_prob = picked.groupBy(*keys, "__i").agg((lo + (hi - lo) * frac).alias("__q"))
    return per_prob.groupBy(*keys).agg(
        *[F.max(F.when(F.col("__i") == i, F.col("__q"))).alias(n) for i, n in enumerate(names)]
    )


# --- A8 ------------------------------------------------------------------------------
def describe(
    df: DataFrame, cols: Sequence[str] | None = None, method: str = "exact", **selection: int
) -> DataFrame:
    """Per numeric column: count, mean, sample std, min, 25/50/75 % quantiles, max
    (NaN and null skipped, as pandas does).

    The columns are stacked into (column number, value) rows (no shuffle): one grouped aggregate
    gives the moments of all columns (one row per column, kept: rank selection starts from its counts and
    ends), rank selection over the same rows all exact quantiles (``selection``: parameters of
    ``selected_quantiles``).
    """
    cols = list(cols or numeric_columns(df))
    long = df.select(F.posexplode(F.array(*[q(c).cast("double") for c in cols])).alias("__slot", "x"))
    stat_names = ["p25", "p50", "p75"]
    # moments with Spark's own aggregates over the stacked rows (partial per partition);
    # summing per distinct value instead would change the floating summation order
    x = F.when(~F.isnan("x"), F.col("x"))  # NaN counts as missing, as in pandas
    basic = persist_for_job(long.groupBy("__slot").agg(
        F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
        F.min(x).alias("min"), F.max(x).alias("max"),
    ))
    if method == "approx":
        qs = quantiles(long, "x", [0.25, 0.5, 0.75], by=["__slot"], names=stat_names, method="approx")
    else:
        totals = basic.where(F.col("count") > 0).select(
            "__slot", F.col("count").alias("__m"), F.col("min").alias("__lo"), F.col("max").alias("__hi")
        )
        qs = quantiles(long, "x", [0.25, 0.5, 0.75], by=["__slot"], names=stat_names, totals=totals, **selection)
    column = F.element_at(F.array(*[F.lit(c) for c in cols]), F.col("__slot") + 1).alias("column")
    out = basic.join(qs, "__slot", "left")
    return out.select(column, "count", "mean", "std", "min", "p25", "p50", "p75", "max")


# --- A9 ------------------------------------------------------------------------------
def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Equal-width histogram on [min, max]; the last bin is closed. Every bin is present
    (count 0 when empty). ``bin`` is 1-based; ``lo``/``hi`` are the bin edges.

    Two jobs: a one-row min/max aggregate (its two numbers become literals), then one
    partial count per bin; the 30-row bin list joins the counts.
    """
    x = q(col).cast("double")
    vals = df.select(x.alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    ends = vals.agg(F.min("x").alias("lo"), F.max("x").alias("hi")).first()
    spark = df.sparkSession
    if ends["lo"] is None:
        return spark.createDataFrame([], "bin int, lo double, hi double, count long")
    lo, hi = float(ends["lo"]), float(ends["hi"])
    start, width = (lo, hi - lo) if hi > lo else (lo - 0.5, 1.0)
    idx = F.floor((F.col("x") - F.lit(start)) * F.lit(float(bins)) / F.lit(width)) + 1
    counts = vals.select(F.least(idx, F.lit(bins)).cast("int").alias("bin")).groupBy("bin").count()
    all_bins = spark.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    out = all_bins.join(F.broadcast(counts), "bin", "left")
    return out.select(
        "bin",
        (F.lit(start) + (F.col("bin") - 1) * F.lit(width) / bins).alias("lo"),
        (F.lit(start) + F.col("bin") * F.lit(width) / bins).alias("hi"),
        F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count"),
    )


# --- A10 -----------------------------------------------------------------------------
def boxplot_stats(
    df: DataFrame, value: str, by: str, whisker: float = 1.5, method: str = "exact", **selection: int
) -> DataFrame:
    """Per group: n, Q1, median, Q3, whiskers (most extreme points inside
    ``whisker`` x IQR of the quartiles) and the number of outliers. Null groups and null
    values are left out. The quartiles come from rank selection, the rest from one more pass over the
    rows; the quartile table (one row per group) is broadcast after measuring."""
    data = df.where(q(by).isNotNull())
    names = ["q1", "median", "q3"]
    qs = quantiles(data, value, [0.25, 0.5, 0.75], by=[by], names=names, method=method, **selection)
    iqr = F.col("q3") - F.col("q1")
    qs = qs.withColumn("__lf", F.col("q1") - whisker * iqr).withColumn("__uf", F.col("q3") + whisker * iqr)
    qs_b, _ = broadcast_if_small(qs)
    inside = (F.col("__v") >= F.col("__lf")) & (F.col("__v") <= F.col("__uf"))
    return _values(data, value, [by]).join(qs_b, by).groupBy(by).agg(
        F.count(F.lit(1)).alias("n"),
        F.first("q1").alias("q1"),
        F.first("median").alias("median"),
        F.first("q3").alias("q3"),
        F.min(F.when(inside, F.col("__v"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("__v"))).alias("whisker_hi"),
        F.count(F.when(~inside, 1)).alias("n_outliers"),
    )


def boxplot_outliers(df: DataFrame, value: str, by: str, whisker: float = 1.5) -> DataFrame:
    """The outlier rows themselves (group, value), for drawing."""
    stats = boxplot_stats(df, value, by, whisker)
    lf = F.col("q1") - whisker * (F.col("q3") - F.col("q1"))
    uf = F.col("q3") + whisker * (F.col("q3") - F.col("q1"))
    s, _ = broadcast_if_small(stats.select(by, lf.alias("__lf"), uf.alias("__uf")))
    data = df.select(q(by).alias(by), q(value).cast("double").alias(value))
    return data.join(s, by).where((F.col(value) < F.col("__lf")) | (F.col(value) > F.col("__uf"))).drop(
        "__lf", "__uf"
    )


# --- A11 -----------------------------------------------------------------------------
def _pair_moments(batches, k: int):
    """Per partition: pairwise-complete moments of k columns, merged batch by batch.

    For every ordered pair (i, j) over rows where both are present: n, mean_i, mean_j,
    M2_i, M2_j (sums of squared deviations) and C (sum of cross deviations). Each batch is
    shifted by its own column means before squaring (no cancellation), and batches are
    merged with the parallel-moment update. Emits k*k rows per partition.
    """
    import numpy as np
    import pandas as pd

    n = np.zeros((k, k))
    mi = np.zeros((k, k))
    m2i = np.zeros((k, k))
    c = np.zeros((k, k))
    for pdf in batches:
        x = pdf.to_numpy(dtype="float64", na_value=np.nan)
        if not len(x):
            continue
        valid = ~np.isnan(x)
        m = valid.astype("float64")
        cnt = valid.sum(axis=0)
        shift = np.where(cnt > 0, np.nansum(x, axis=0) / np.maximum(cnt, 1), 0.0)
        z = np.where(valid, x - shift, 0.0)
        nb = m.T @ m                                   # rows with both i and j
        sb = z.T @ m                                   # sum of shifted x_i over those rows
        with np.errstate(invalid="ignore", divide="ignore"):
            mb = np.where(nb > 0, sb / nb, 0.0)
        m2b = (z * z).T @ m - nb * mb * mb             # M2 of x_i over rows with both
        cb = z.T @ z - nb * mb * mb.T                  # cross deviations (mean_j|i = mb.T)
        mb = mb + shift[:, None]
        tot = n + nb
        with np.errstate(invalid="ignore", divide="ignore"):
            d = np.where(tot > 0, mb - mi, 0.0)
            w = np.where(tot > 0, n * nb / tot, 0.0)
            mi = np.where(tot > 0, mi + d * nb / tot, 0.0)
        m2i = m2i + m2b + d * d * w
        c = c + cb + d * d.T * w
        n = tot
    if not n.any():
        return
    ii, jj = np.meshgrid(np.arange(k), np.arange(k), indexing="ij")
    yield pd.DataFrame({
        "i": ii.ravel(), "j": jj.ravel(), "n": n.ravel(),
        "mi": mi.ravel(), "mj": mi.T.ravel(), "m2i": m2i.ravel(), "m2j": m2i.T.ravel(), "c": c.ravel(),
    })


def correlation_long(df: DataFrame, cols: Sequence[str] | None = None, digits: int | None = 3) -> DataFrame:
    """Pearson correlation of every ordered pair of numeric columns over pairwise-complete
    rows, as (column_a, column_b, corr). A constant column gives null, not an error.

    One pass: each partition reduces its rows to k*k moment rows with numpy (Arrow
    batches), the partials are merged by a small aggregate (k*k groups). A single SQL
    aggregate would need ~3 k^2 moment buffers, far beyond what whole-stage codegen takes.
    """
    cols = list(cols or numeric_columns(df))
    k = len(cols)
    vals = df.select(*[q(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    # k*k rows per partition, read twice below: kept, so that the source is scanned once
    part = persist_for_job(vals.mapInPandas(
        lambda it: _pair_moments(it, k),
        "i int, j int, n double, mi double, mj double, m2i double, m2j double, c double",
    ))
    tot = part.groupBy("i", "j").agg(
        F.sum("n").alias("t_n"),
        (F.sum(F.col("n") * F.col("mi")) / F.sum("n")).alias("t_mi"),
        (F.sum(F.col("n") * F.col("mj")) / F.sum("n")).alias("t_mj"),
    )
    # k*k rows: bounded by the number of columns
    di, dj = F.col("mi") - F.col("t_mi"), F.col("mj") - F.col("t_mj")
    merged = part.join(F.broadcast(tot), ["i", "j"]).groupBy("i", "j").agg(
        F.first("t_n").alias("t_n"),
        F.sum(F.col("m2i") + F.col("n") * di * di).alias("t_m2i"),
        F.sum(F.col("m2j") + F.col("n") * dj * dj).alias("t_m2j"),
        F.sum(F.col("c") + F.col("n") * di * dj).alias("t_c"),
    )
    r = F.when(
        (F.col("t_n") > 1) & (F.col("t_m2i") > 0) & (F.col("t_m2j") > 0),
        F.col("t_c") / F.sqrt(F.col("t_m2i") * F.col("t_m2j")),
    )
    r = F.when(F.col("i") == F.col("j"), F.when(F.col("t_m2i") > 0, F.lit(1.0))).otherwise(r)
    names = F.array(*[F.lit(c) for c in cols])
    out = merged.select(
        F.element_at(names, F.col("i") + 1).alias("column_a"),
        F.element_at(names, F.col("j") + 1).alias("column_b"),
        (F.bround(r, digits) if digits is not None else r).alias("corr"),
    )
    return out


def correlation_matrix(df: DataFrame, cols: Sequence[str] | None = None, digits: int | None = 3) -> DataFrame:
    """The same as a square matrix: one row per column, one column per column."""
    cols = list(cols or numeric_columns(df))
    long = correlation_long(df, cols, digits)
    wide = long_to_wide(long, "column_a", "column_b", "corr", cols)
    return wide.withColumnRenamed("column_a", "column")


# --- A12 -----------------------------------------------------------------------------
def scatter_pairs(df: DataFrame, x: str, y: str) -> DataFrame:
    """Rows where both ``x`` and ``y`` are present."""
    return df.select(q(x).alias(x), q(y).alias(y)).na.drop()


def _ship_by_value() -> None:
    """Functions of this module run inside Python workers (mapInPandas / pandas UDF).
    Serialise them by value so executors need numpy/pandas only, not this package."""
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_ship_by_value()
