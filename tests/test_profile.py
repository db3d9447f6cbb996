"""Profiling operators against numpy / pandas brute force on small fixtures, including a
skewed column where one value holds a third of the rows."""

import numpy as np
import pandas as pd
import pytest

from cauce.operators import profile


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(7)
    n = 3000
    g = rng.choice(["a", "b", "c"], size=n)
    v = rng.normal(50, 20, size=n).round(2)
    v[: n // 3] = 42.0  # hot value
    w = v * 0.5 + rng.normal(0, 5, size=n)
    w[::7] = np.nan
    pdf = pd.DataFrame({"g": g, "v": v, "w": w, "k": np.ones(n)})
    sdf = spark.createDataFrame(pdf).replace(float("nan"), None)
    return pdf, sdf


def test_exact_quantiles_grouped(skewed):
    pdf, sdf = skewed
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    names = [f"p{i}" for i in range(len(probs))]
    for limit in (2_000_000, 50, 3):  # no refinement, one level, several levels
        q = profile.quantiles(sdf, "v", probs, by=["g"], names=names, buckets=4, max_sort_rows=limit)
        got = {r["g"]: [r[n] for n in names] for r in q.collect()}
        for key, grp in pdf.groupby("g"):
            assert np.allclose(got[key], np.quantile(grp["v"], probs), rtol=0, atol=1e-9), limit
    (row,) = profile.quantiles(sdf, "w", [0.5], names=["m"]).collect()
    assert row["m"] == pytest.approx(np.nanquantile(pdf["w"], 0.5), abs=1e-9)


def test_describe(skewed):
    pdf, sdf = skewed
    got = {r["column"]: r for r in profile.describe(sdf.select("v", "w")).collect()}
    ref = pdf[["v", "w"]].describe().T
    for c in ("v", "w"):
        for a, b in (("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"),
                     ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("max", "max")):
            assert got[c][a] == pytest.approx(ref.loc[c, b], rel=1e-9, abs=1e-9)


def test_histogram(skewed):
    pdf, sdf = skewed
    got = [r["count"] for r in profile.histogram(sdf, "v", 30).orderBy("bin").collect()]
    ref, _ = np.histogram(pdf["v"], bins=30)
    assert got == list(ref)


def test_boxplot(skewed):
    pdf, sdf = skewed
    got = {r["g"]: r for r in profile.boxplot_stats(sdf, "v", "g").collect()}
    for key, grp in pdf.groupby("g"):
        q1, q3 = np.quantile(grp["v"], [0.25, 0.75])
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = grp["v"][(grp["v"] >= lo) & (grp["v"] <= hi)]
        assert got[key]["whisker_lo"] == inside.min() and got[key]["whisker_hi"] == inside.max()
        assert got[key]["n_outliers"] == len(grp) - len(inside)


def test_correlation_pairwise_complete(skewed):
    pdf, sdf = skewed
    got = {(r["column_a"], r["column_b"]): r["corr"] for r in profile.correlation_long(sdf, ["v", "w", "k"], digits=None).collect()}
    ref = pdf[["v", "w", "k"]].corr()
    assert got[("v", "w")] == pytest.approx(ref.loc["v", "w"], abs=1e-12)
    assert got[("w", "v")] == got[("v", "w")]
    assert got[("v", "v")] == 1.0
    assert got[("k", "v")] is None and got[("k", "k")] is None
    m = profile.correlation_matrix(sdf, ["v", "w"]).collect()
    assert len(m) == 2


def test_reports(skewed, spark):
    pdf, sdf = skewed
    top = profile.top_values(sdf, "v", 3).collect()
    assert top[0]["value"] == "42.0" and top[0]["count"] == len(pdf) // 3
    rates = {r["column"]: r["null_rate"] for r in profile.null_rates(sdf).collect()}
    assert rates["w"] == pytest.approx(pdf["w"].isna().mean())
    schema = {r["column"]: (r["dtype"], r["non_null"]) for r in profile.schema_report(sdf).collect()}
    assert schema["w"] == ("double", int(pdf["w"].notna().sum()))
    assert profile.scatter_pairs(sdf, "v", "w").count() == int(pdf["w"].notna().sum())


def test_approx_quantiles_close(skewed):
    pdf, sdf = skewed
    (row,) = profile.quantiles(sdf, "v", [0.5], names=["m"], method="approx").collect()
    assert abs(row["m"] - np.quantile(pdf["v"], 0.5)) <= 1.0


def test_boxplot_outlier_rows(skewed):
    pdf, sdf = skewed
    stats = {r["g"]: r["n_outliers"] for r in profile.boxplot_stats(sdf, "v", "g").collect()}
    rows = profile.boxplot_outliers(sdf, "v", "g").groupBy("g").count().collect()
    assert {r["g"]: r["count"] for r in rows} == {k: v for k, v in stats.items() if v}


def test_describe_keeps_all_null_column(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (float("nan"), None)], "a double, b double")
    rows = {r["column"]: r for r in profile.describe(df).collect()}
    assert rows["a"]["count"] == 2 and rows["a"]["mean"] == 1.5
    assert rows["b"]["count"] == 0 and rows["b"]["mean"] is None and rows["b"]["p50"] is None


def test_selection_sets_hot_values_apart(spark):
    """Two thirds of the rows hold two values; magnitudes differ by hundreds of decades."""
    rng = np.random.default_rng(3)
    v = np.concatenate([np.full(1000, 5.0), np.full(1000, -2.5), 10.0 ** rng.uniform(-200, 200, 1000), [0.0, -0.0, np.nan]])
    df = spark.createDataFrame(pd.DataFrame({"v": rng.permutation(v)})).repartition(4)
    probs = [0.0, 0.2, 0.3333, 0.5, 0.67, 0.9, 0.999, 1.0]
    (row,) = profile.quantiles(df, "v", probs, names=[f"p{i}" for i in range(len(probs))], buckets=8, max_sort_rows=5).collect()
    assert np.allclose(list(row), np.quantile(v[~np.isnan(v)], probs), rtol=1e-12, atol=0)
    assert profile.quantiles(df.limit(0), "v", [0.5], names=["m"]).count() == 0


def test_selection_builds_no_value_table(spark):
    """Every aggregate over the rows is per group, interval or bucket, but for the last few rows."""
    df = spark.range(200_000).selectExpr("id % 3 as g", "cast(id as double) as v")
    before = {id(x) for x in profile_persisted()}
    profile.quantiles(df, "v", [0.5], by=["g"], names=["m"], max_sort_rows=1000).collect()
    assert all(x.count() <= 10_000 for x in profile_persisted() if id(x) not in before)


def profile_persisted():
    from cauce import session

    return list(session._persisted())


def test_describe_reads_the_rows_three_times(spark):
    """Moments, one level of bucket counts, the last few rows: no further pass over the source."""
    read, n = spark.sparkContext.accumulator(0), 20_000

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    df = spark.range(0, n, 1, 4).selectExpr("cast(id as double) as v", "id % 5 as w")
    df = df.mapInArrow(counted, "v double, w bigint")
    rows = {r["column"]: r for r in profile.describe(df, buckets=64, max_sort_rows=1000).collect()}
    assert [rows["v"][c] for c in ("count", "p25", "p50", "p75")] == [n, 4999.75, 9999.5, 14999.25]
    assert [rows["w"][c] for c in ("count", "p25", "p50", "p75")] == [n, 1.0, 2.0, 3.0]
    assert read.value == 3 * n


def test_selection_of_values_that_even_buckets_do_not_divide(spark):
    """Hot values amid others, hundreds of decades around zero, infinite ends, neighbouring and least doubles."""
    rng = np.random.default_rng(11)
    n = 2001
    cases = {
        "hot": np.concatenate([np.full(n, 42.0), rng.uniform(0, 100, n)]),
        "zero": np.concatenate([np.zeros(n), rng.choice([-1, 1], n) * 10.0 ** rng.uniform(-300, 300, n)]),
        "infinite": np.concatenate([np.full(400, -np.inf), np.full(400, np.inf), rng.normal(0, 1, n)]),
        "neighbours": 1 + rng.integers(0, 1000, n) * 2.0**-52,
        "least": rng.integers(-40, 40, n) * 5e-324,
        "far": np.concatenate([rng.uniform(0, 1, n), [-1.7e308, 1.7e308]]),
    }
    pdf = pd.concat([pd.DataFrame({"g": g, "v": rng.permutation(v)}) for g, v in cases.items()])
    df = spark.createDataFrame(pdf).repartition(4)
    probs = [0.25, 0.41, 0.5, 0.66, 0.75]
    names = [f"p{i}" for i in range(len(probs))]
    got = profile.quantiles(df, "v", probs, by=["g"], names=names, buckets=16, max_sort_rows=10)
    got = {r["g"]: [r[x] for x in names] for r in got.collect()}
    for g, v in cases.items():
        assert np.allclose(got[g], np.quantile(v, probs), rtol=1e-15, atol=0), g
