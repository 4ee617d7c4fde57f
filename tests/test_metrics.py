"""Performance metrics against brute force."""

import numpy as np
import pandas as pd
import pytest

from tidegauge.operators import metrics
from tidegauge.operators.capability import cpk, ppm_out_of_spec
from tidegauge.types import SlidingWindow


def brute(y, p):
    pos, neg = p[y == 1], p[y == 0]
    auc = np.mean((pos[:, None] > neg) + 0.5 * (pos[:, None] == neg))
    ap = 0.0
    for s in np.unique(p)[::-1]:
        z = p >= s
        ap += ((p == s) & (y == 1)).sum() / (y == 1).sum() * ((y == 1) & z).sum() / z.sum()
    best = (0.5, -1.0)
    for t in np.unique(np.quantile(p, np.linspace(0.5, 0.9995, 200))):
        m = np_mcc(y, p >= t)
        if m > best[1]:
            best = (t, m)
    q = np.clip(p, 1e-7, 1 - 1e-7)
    return auc, ap, best, float(-np.mean(y * np.log(q) + (1 - y) * np.log(1 - q)))


def np_mcc(y, z):
    tp, fp, fn, tn = (float(x.sum()) for x in ((y == 1) & z, (y == 0) & z, (y == 1) & ~z, (y == 0) & ~z))
    d = (tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)
    return 0.0 if d == 0 else (tp * tn - fp * fn) / np.sqrt(d)


@pytest.fixture(scope="module")
def pdf():
    rng = np.random.default_rng(2)
    n = 3000
    y = (rng.random(n) < 0.1).astype(int)
    p = np.clip(rng.normal(0.3 + 0.2 * y, 0.15, n), 0, 1).round(3)
    p[rng.random(n) < 0.33] = 0.25
    return pd.DataFrame(dict(day=rng.integers(1, 7, n), y=y, p=p))


@pytest.mark.parametrize("rows_per_bucket", [10**6, 40])
def test_metrics_match_brute_force(spark, pdf, rows_per_bucket):
    df = spark.createDataFrame(pdf)
    got = {r.day: r for r in metrics.performance(df, ["day"], digits=None, rows_per_bucket=rows_per_bucket).collect()}
    assert len(got) == 6
    for d, r in got.items():
        sub = pdf[pdf.day == d]
        auc, ap, (t, m), loss = brute(sub.y.to_numpy(), sub.p.to_numpy())
        assert r.roc_auc == pytest.approx(auc) and r.pr_auc == pytest.approx(ap)
        assert r.mcc == pytest.approx(m) and r.threshold == pytest.approx(t) and r.logloss == pytest.approx(loss)


def test_windows_are_sums_of_days(spark, pdf):
    df = spark.createDataFrame(pdf)
    got = {r.window: r for r in metrics.performance(df, window=SlidingWindow("day", 3, 6, width=3), digits=None).collect()}
    assert set(got) == {3, 4, 5, 6}
    for d, r in got.items():
        sub = pdf[(pdf.day > d - 3) & (pdf.day <= d)]
        auc, ap, (t, m), _ = brute(sub.y.to_numpy(), sub.p.to_numpy())
        assert r.n == len(sub) and r.roc_auc == pytest.approx(auc) and r.mcc == pytest.approx(m)


def test_ties_by_hand(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.3), (1, 0.2), (0, 0.1)], "y int, p double")
    counts, bucketed = metrics.score_counts(df.selectExpr("*", "0 as g"), ["g"])
    row = metrics.ranking_metrics(metrics.ranked(counts, ["g"], bucketed), ["g"]).first()
    assert row.pr_auc == pytest.approx(0.75556, abs=1e-5)
    assert row.roc_auc == pytest.approx(0.72222, abs=1e-5)


@pytest.mark.parametrize("pos, neg, estimable", [(7, 100, False), (8, 100, True), (50, 0, False)])
def test_not_estimable_is_null_never_zero(spark, pos, neg, estimable):
    rows = [(1, 0.5 + i / 1000) for i in range(pos)] + [(0, 0.4 + i / 1000) for i in range(neg)]
    r = metrics.performance(spark.createDataFrame(rows, "y int, p double")).first()
    assert r.estimable is estimable and r.n == pos + neg and r.n_pos == pos
    for c in ("pr_auc", "roc_auc", "mcc", "logloss", "threshold"):
        assert (r[c] is not None) is estimable


def test_constant_score(spark):
    rows = [(i % 3 == 0, 0.2) for i in range(60)]
    df = spark.createDataFrame([(int(a), b) for a, b in rows], "y int, p double")
    r = metrics.performance(df).first()
    assert r.roc_auc == 0.5 and r.mcc == 0.0 and r.threshold == 0.2


def test_extended_metrics(spark, pdf):
    r = metrics.extended_metrics(spark.createDataFrame(pdf)).first()
    y, z = pdf.y.to_numpy(), (pdf.p >= 0.5).to_numpy()
    assert r.prevalence == round(y.mean(), 5)
    assert r.accuracy == pytest.approx((y == z).mean(), abs=1e-5)
    assert r.accuracy_trivial == pytest.approx((y == 0).mean(), abs=1e-5)
    tp, fp, fn = (y & z).sum(), (~y.astype(bool) & z).sum(), (y.astype(bool) & ~z).sum()
    assert r.f1_at_half == pytest.approx(2 * tp / (2 * tp + fp + fn), abs=1e-5)
    one_class = metrics.extended_metrics(spark.createDataFrame([(0, 0.1), (0, 0.7)], "y int, p double")).first()
    assert one_class.accuracy is None


def test_capability(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(110, 1.15, 5000)
    df = spark.createDataFrame(pd.DataFrame({"v": np.append(x, [np.nan, np.inf])}))
    row = df.agg(cpk("v", 105, 115).alias("c"), ppm_out_of_spec("v", 105, 115).alias("p")).first()
    want = min((115 - x.mean()) / (3 * x.std(ddof=1)), (x.mean() - 105) / (3 * x.std(ddof=1)))
    assert row.c == pytest.approx(want) and row.c > 1.33
    assert row.p == pytest.approx(((x < 105) | (x > 115)).mean() * 1e6)
    few = spark.createDataFrame([(1.0,)] * 29, "v double").agg(cpk("v", 0, 2)).first()[0]
    flat = spark.createDataFrame([(1.0,)] * 40, "v double").agg(cpk("v", 0, 2)).first()[0]
    assert few is None and flat is None
