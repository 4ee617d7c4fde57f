"""Two-sample statistics against brute force, with and without buckets."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidegauge.operators import cumulative
from tidegauge.operators.cumulative import quantile_edges, thin
from tidegauge.operators.distance import wasserstein_statistics
from tidegauge.operators.profile import ReferenceProfile, build_profile
from tidegauge.operators.report import drift_report, summarise
from tidegauge.types import MonitorSpec, SlidingWindow


def np_psi(r, c, bins=10):
    r, c = r[np.isfinite(r)], c[np.isfinite(c)]
    if len(r) < 20 or len(c) < 20:
        return None
    e = np.unique(np.quantile(r, np.linspace(0, 1, bins + 1)))
    if len(e) < 3:
        return None
    e[0], e[-1] = -np.inf, np.inf
    p = np.clip(np.histogram(r, e)[0] / len(r), 1e-6, None)
    q = np.clip(np.histogram(c, e)[0] / len(c), 1e-6, None)
    return float(((q - p) * np.log(q / p)).sum())


def np_cdfs(r, c):
    grid = np.unique(np.concatenate([r, c]))
    return (
        grid,
        np.searchsorted(np.sort(r), grid, side="right") / len(r),
        np.searchsorted(np.sort(c), grid, side="right") / len(c),
    )


def np_chi2(r, c):
    cats = sorted(set(r) | set(c))
    t = np.array([[np.sum(r == k) for k in cats], [np.sum(c == k) for k in cats]], float)
    if len(cats) < 2:
        return None
    e = t.sum(1, keepdims=True) @ t.sum(0, keepdims=True) / t.sum()
    gap = np.abs(t - e)
    if len(cats) == 2:
        gap = gap - np.minimum(0.5, gap)
    return float((gap**2 / e).sum())


def np_js(r, c):
    cats = sorted(set(r) | set(c))
    p = np.array([np.mean(r == k) for k in cats])
    q = np.array([np.mean(c == k) for k in cats])
    m = (p + q) / 2
    kl = lambda a: sum(x * math.log2(x / y) for x, y in zip(a, m) if x > 0)
    return min(max(0.5 * kl(p) + 0.5 * kl(q), 0.0), 1.0)


@pytest.fixture(scope="module")
def pdf():
    rng = np.random.default_rng(5)
    n = 6000
    day = rng.integers(1, 13, n)
    x = rng.normal(50, 5, n) + np.where(day > 9, 4.0, 0.0)
    x[rng.random(n) < 0.03] = np.nan
    x[rng.random(n) < 0.01] = np.inf
    # a third of all rows carries one value
    hot = np.where(rng.random(n) < 0.34, 7.0, rng.exponential(10, n))
    steps = rng.integers(0, 4, n).astype(float)
    kind = rng.choice(["a", "b", "c", "d"], n, p=[0.4, 0.3, 0.2, 0.1])
    kind = np.where((day > 9) & (kind == "d"), "e", kind)
    flag = rng.random(n) < np.where(day > 10, 0.5, 0.3)
    seg = rng.choice(["s1", "s2", None], n, p=[0.6, 0.3, 0.1])
    return pd.DataFrame(dict(id=np.arange(n), day=day, x=x, hot=hot, steps=steps, kind=kind, flag=flag, seg=seg, const=1.0))


@pytest.fixture(scope="module")
def table(spark, pdf):
    return spark.createDataFrame(pdf).withColumn("day", F.col("day").cast("int")).cache()


SPEC = MonitorSpec(num=("x", "hot", "steps", "const"), cat=("kind", "flag"), threshold=0.05, min_obs=100)
WINDOW = SlidingWindow("day", first=8, last=12, width=2)


@pytest.fixture(params=["one bucket", "few buckets", "many buckets", "subdivided"])
def rows_per_bucket(request, monkeypatch):
    """Different sizes of the ordered work must give the same numbers."""
    if request.param == "subdivided":
        monkeypatch.setattr(cumulative, "MAX_BUCKETS", 8)
    return {"one bucket": 10**6, "few buckets": 150, "many buckets": 15, "subdivided": 40}[request.param]


def test_report_matches_brute_force(spark, table, pdf, rows_per_bucket):
    profile = build_profile(table.where("day <= 6"), SPEC, rows_per_bucket=rows_per_bucket)
    got = {
        (r.seg, r.window, r.feature): r
        for r in drift_report(table, profile, by=["seg"], window=WINDOW, rows_per_bucket=rows_per_bucket).collect()
    }
    ref = pdf[pdf.day <= 6]
    assert len(got) == 2 * 5 * 6
    for (seg, end, f), r in got.items():
        cur = pdf[(pdf.seg == seg) & (pdf.day > end - 2) & (pdf.day <= end)]
        assert r.n_cur == len(cur) and r.n_ref == len(ref)
        a, b = ref[f].dropna().to_numpy(), cur[f].dropna().to_numpy()
        if f in SPEC.num:
            effect = np_psi(a, b)
            _, fa, fb = np_cdfs(a, b)
            stat = float(np.abs(fa - fb).max())
        else:
            a, b = a.astype(str), b.astype(str)
            effect, stat = np_js(a, b) * 2.5, np_chi2(a, b)
        assert r.stat == pytest.approx(stat, abs=1e-10)
        assert r.measurable is (effect is not None)
        assert (r.effect is None) if effect is None else r.effect == pytest.approx(effect, abs=1e-9)
        assert r.drift is bool(r.measurable and r.p_value < 0.05 / 6 and r.effect > 0.05)
    assert any(r.drift for r in got.values()) and not all(r.drift for r in got.values())


def test_wasserstein_matches_brute_force(table, pdf, rows_per_bucket):
    spec = MonitorSpec(num=("x", "hot", "steps"))
    profile = build_profile(table.where("day <= 6"), spec, rows_per_bucket=rows_per_bucket)
    rows = wasserstein_statistics(table.where("day > 6"), profile, ["day"], rows_per_bucket=rows_per_bucket).collect()
    assert len(rows) == 6 * 3
    for r in rows:
        a, b = pdf[pdf.day <= 6][r.feature], pdf[pdf.day == r.day][r.feature]
        a, b = a[np.isfinite(a)].to_numpy(), b[np.isfinite(b)].to_numpy()
        grid, fa, fb = np_cdfs(a, b)
        assert r.wasserstein == pytest.approx(float((np.abs(fa - fb)[:-1] * np.diff(grid)).sum()), abs=1e-8)


def test_wasserstein_metric_in_report(table):
    spec = SPEC.but(num=("x",), cat=(), metric="wasserstein", threshold=1.0)
    profile = build_profile(table.where("day <= 6"), spec)
    late, early = drift_report(table.where("day > 9"), profile).first(), drift_report(table.where("day = 7"), profile).first()
    assert late.effect == pytest.approx(4.0, abs=0.5) and late.drift
    assert early.effect < 1.0 and not early.drift


def test_quantile_edges_are_exact_in_buckets(spark, pdf):
    df = spark.createDataFrame(pdf[["hot"]].rename(columns={"hot": "value"}))
    cuts = sorted(np.quantile(pdf.hot, [0.1, 0.3, 0.31, 0.6, 0.9]))
    from tidegauge.functions.clean import bisect_sql

    counts = (
        df.withColumn("g", F.lit("a")).withColumn("bucket", F.expr(bisect_sql("value", cuts)))
        .groupBy("g", "bucket", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    for bins in (3, 10, 37):
        edges = quantile_edges(counts, ["g"], bins=bins, bucketed=True).first()["edges"]
        assert np.allclose(edges, np.unique(np.quantile(pdf.hot, np.linspace(0, 1, bins + 1))), atol=1e-12)


def test_cut_points_follow_size():
    grid = [float(i) for i in range(1000)]
    assert thin(grid, 10, 100) == []
    assert len(thin(grid, 1000, 100)) == 9
    wide = thin(grid, 10**9, 1000)
    assert len(wide) == 1000 and wide.sub == 1000


def test_small_and_missing_are_not_measurable(spark, table):
    profile = build_profile(table.where("day <= 6"), SPEC)
    tiny = drift_report(table.where("day > 6").limit(50), profile).collect()
    assert len(tiny) == 6 and not any(r.measurable or r.drift for r in tiny)
    assert all(r.effect is None and r.p_value is None for r in tiny)
    absent = {r.feature: r for r in drift_report(table.where("day > 6").drop("x", "kind"), profile).collect()}
    assert not absent["x"].measurable and not absent["kind"].measurable and absent["hot"].measurable
    s = summarise(drift_report(table.where("day > 9"), profile)).first()
    assert s.n_drift == len(s.features) and s.n_not_measurable == 1  # the constant
    assert s.features[0] == "kind" or s.features[0] == "x"


def test_bonferroni_counts_unmeasurable_features():
    assert SPEC.alpha_corrected == pytest.approx(0.05 / 6)


def test_missing_reference_column_and_empty_monitor(table):
    with pytest.raises(KeyError):
        build_profile(table, MonitorSpec(num=("nope",)))
    with pytest.raises(ValueError):
        MonitorSpec()


def test_result_does_not_depend_on_partitioning(table):
    profile = build_profile(table.where("day <= 6"), SPEC)
    key = lambda d: sorted((r.feature, round(r.effect or 0, 10), round(r.stat or 0, 10)) for r in d.collect())
    a = key(drift_report(table.where("day > 9").repartition(1), profile))
    b = key(drift_report(table.where("day > 9").repartition(13, "hot"), profile))
    assert a == b


def test_profile_is_frozen_and_survives_storage(spark, table, tmp_path):
    profile = build_profile(table.where("day <= 6"), SPEC)
    with pytest.raises(ValueError):
        profile.but(bins=20)
    assert profile.but(threshold=9.0).spec.threshold == 9.0 and profile.spec.threshold == 0.05
    profile.save(str(tmp_path / "p"))
    again = ReferenceProfile.load(spark, str(tmp_path / "p"))
    assert again.numeric == profile.numeric and again.cat_support == profile.cat_support
    key = lambda p: sorted((r.feature, r.effect, r.stat) for r in drift_report(table.where("day > 9"), p).collect())
    for x, y in zip(key(profile), key(again)):
        assert x[0] == y[0] and x[1] == pytest.approx(y[1]) and x[2] == pytest.approx(y[2])


def test_psi_against_itself_and_monotone_in_shift(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(0, 1, 4000)
    ref = spark.createDataFrame(pd.DataFrame({"v": base}))
    profile = build_profile(ref, MonitorSpec(num=("v",)))
    effect = lambda x: drift_report(spark.createDataFrame(pd.DataFrame({"v": x})), profile).first().effect
    assert effect(base) == pytest.approx(0.0, abs=1e-12)
    values = [effect(rng.normal(d, 1, 4000)) for d in (0.1, 0.5, 1.0, 2.0)]
    assert values == sorted(values) and values[-1] > 1.0


@pytest.mark.parametrize("trust", [True, False])
def test_bracketed_edges_equal_numpy(spark, table, pdf, rows_per_bucket, trust):
    sizes = cumulative.sketch_features(table, ["x", "hot", "steps", "const"], rows_per_bucket=rows_per_bucket)
    if not trust:
        # a sketch that misleads must cost time, not correctness
        for _, cuts in sizes.values():
            cuts.grid = [v + 3.0 for v in cuts.grid]
    for bins in (4, 10):
        got = cumulative.reference_edges(table, list(sizes), bins=bins, sizes=sizes)
        for f, (edges, counts) in got.items():
            x = pdf[f].to_numpy()
            x = x[np.isfinite(x)]
            want = np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)))
            assert np.allclose(edges, want, atol=1e-12) and sum(counts) in (0, len(x))
            if len(want) > 2:
                want[0], want[-1] = -np.inf, np.inf
                assert counts == list(np.histogram(x, want)[0])


@pytest.mark.parametrize("shape", ["long tail", "two scales", "even"])
def test_ranges_of_large_columns_are_even(spark, shape):
    """More buckets than one sketch tells apart: each holds at most twice the mean, however values are spread."""
    from tidegauge.functions.clean import with_buckets
    from tidegauge.operators.cumulative import MAX_BUCKETS, sketch_features

    rng = np.random.default_rng(2)
    x = {"long tail": np.exp(rng.normal(0, 6, 60_000)), "even": rng.random(60_000)}.get(shape)
    if x is None:
        x = np.concatenate([rng.random(30_000) * 1e-9, rng.random(30_000) * 1e9])
    df = spark.createDataFrame(pd.DataFrame({"x": x}))
    n, cuts = sketch_features(df, ["x"], rows_per_bucket=20)["x"]
    assert n == 60_000 and len(cuts) > 2 * MAX_BUCKETS and cuts.sub == 1 and list(cuts) == sorted(set(cuts))
    held = [r["count"] for r in with_buckets(df, {"x": cuts}).groupBy("x__b").count().collect()]
    assert sum(held) == 60_000 and max(held) <= 2 * 60_000 / (len(cuts) + 1)


def test_a_repeated_value_is_not_divided(spark):
    from tidegauge.operators.cumulative import sketch_features

    df = spark.createDataFrame(pd.DataFrame({"x": np.r_[np.zeros(5000), np.arange(5000)]}))
    n, cuts = sketch_features(df, ["x"], rows_per_bucket=2)["x"]
    assert n == 10_000 and list(cuts) == sorted(set(cuts)) and len(cuts) > 1500
