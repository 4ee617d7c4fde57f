"""Split calibration, block boundaries, homogeneity and contract rules."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.test_measure import np_js, np_psi
from tidegauge.functions.special import chi2_ppf
from tidegauge.operators import calibrate as cal
from tidegauge.types import Contract, MonitorSpec

SPEC = MonitorSpec(num=("a", "b"), cat=("c",))


@pytest.fixture(scope="module")
def pdf():
    rng = np.random.default_rng(11)
    n = 4003
    # a third of all rows share one axis value, so blocks begin inside ties
    day = np.where(rng.random(n) < 0.34, 7, rng.integers(1, 15, n))
    a = rng.normal(0, 1, n)
    a[rng.random(n) < 0.05] = np.nan
    return pd.DataFrame(
        dict(id=rng.permutation(n), day=day, a=a, b=rng.lognormal(0, 1, n), c=rng.choice(["u", "v", "w"], n))
    )


@pytest.fixture(scope="module")
def table(spark, pdf):
    return spark.createDataFrame(pdf).cache()


@pytest.mark.parametrize("rows_per_bucket", [10**6, 120])
@pytest.mark.parametrize("blocks", [2, 5])
def test_block_effects_match_sorted_blocks(table, pdf, blocks, rows_per_bucket):
    got = {
        (r.pair, r.feature): r
        for r in cal.block_split_effects(table, SPEC, "day", "id", blocks=blocks, rows_per_bucket=rows_per_bucket).collect()
    }
    ordered = pdf.sort_values(["day", "id"])
    size = len(ordered) // blocks
    assert len(got) == (blocks - 1) * 3
    for (pair, f), r in got.items():
        x, y = (ordered[f].iloc[(pair + k) * size : (pair + k + 1) * size].dropna().to_numpy() for k in (0, 1))
        want = np_js(x, y) * 2.5 if f == "c" else np_psi(x, y)
        assert (r.n0, r.n1) == (len(x), len(y))
        assert r.effect == pytest.approx(want, abs=1e-9)


@pytest.mark.parametrize("rows_per_bucket", [10**6, 120])
def test_homogeneity_halves_per_feature(table, pdf, rows_per_bucket):
    got = {r.feature: r for r in cal.homogeneity_by_feature(table, ["a", "b"], key="id", axis="day", rows_per_bucket=rows_per_bucket).collect()}
    ordered = pdf.sort_values(["day", "id"])
    for f in ("a", "b"):
        x = ordered[f].dropna().to_numpy()
        h = len(x) // 2
        floor = chi2_ppf(0.95, 9) * (1 / h + 1 / (len(x) - h))
        assert got[f].n == len(x)
        assert got[f].h == pytest.approx(round(np_psi(x[:h], x[h:]) / floor, 2), abs=0.011)


def test_random_floor_is_near_the_closed_form(table):
    effects = cal.random_split_effects(table, SPEC.but(cat=()), "id", repetitions=30)
    row = cal.random_floor(effects).first()
    expected = chi2_ppf(0.95**0.5, 9) * (4 / 4003)
    assert row.n_repetitions == 30
    assert 0.5 < row.aa_floor / expected < 1.6
    assert row.aa_median <= row.aa_floor <= row.aa_max


def test_grid_mode_is_close_to_exact(table):
    exact = cal.random_floor(cal.random_split_effects(table, SPEC, "id", repetitions=15)).first()
    grid = cal.random_floor(cal.random_split_effects(table, SPEC, "id", repetitions=15, cells=512)).first()
    assert grid.aa_median == pytest.approx(exact.aa_median, rel=0.2)
    assert grid.aa_floor == pytest.approx(exact.aa_floor, rel=0.25)


def test_contamination_is_seen_by_blocks_not_by_random_splits(spark):
    rng = np.random.default_rng(3)
    n = 4000
    x = rng.normal(0, 1, n)
    mixed = np.where(np.arange(n) >= n // 2, x + 1.0, x)
    df = spark.createDataFrame(pd.DataFrame(dict(id=np.arange(n), t=np.arange(n) // 10, clean=x, mixed=mixed)))
    block = {r.feature: r for r in cal.homogeneity_by_feature(df, ["clean", "mixed"], key="id", axis="t").collect()}
    random = {
        r.feature: r
        for r in cal.homogeneity_by_feature(df, ["clean", "mixed"], key="id", mode="random", repetitions=30).collect()
    }
    assert block["clean"].h < 2 and block["clean"].verdict == "homogeneous"
    assert block["mixed"].h > 20 and block["mixed"].verdict == "CONTAMINATED"
    assert random["mixed"].h < 2
    record = cal.calibrate(df, MonitorSpec(num=("clean", "mixed")), key="id", axis="t", mode="block").first()
    assert record.contaminated and record.aa_floor is None and record.suggested_threshold is not None


def test_block_mode_requires_an_axis(table):
    with pytest.raises(ValueError):
        cal.calibrate(table, SPEC, key="id", mode="block")


def test_regime_comparison(spark):
    def record(n, k):
        half = n // 2
        floor = chi2_ppf(0.95 ** (1 / k), 9) * (1 / half + 1 / (n - half))
        return (n, floor, floor * 3, "homogeneous")

    schema = "n_reference int, analytic_floor double, suggested_threshold double, verdict string"
    small, large = (spark.createDataFrame([record(*x)], schema) for x in ((27_000, 9), (160_000, 160)))
    row = cal.compare_regimes(small, large).first()
    assert row.threshold_in_floors > 10 and row.regime == "blind" and row.floor_ratio < 1
    back = cal.compare_regimes(large, small).first()
    assert back.regime == "perpetual alarm"


def make(**changes):
    base = dict(
        version="1", origin="test", num=("a",), cat=(), floor=0.005, analytic_floor=0.004, block_floor=None, homogeneity=None,
        threshold=0.02, alpha=0.05, min_obs=200, suite_pass=13, suite_total=13,
    )
    return Contract(**{**base, **changes})


def test_contract_rules():
    make()
    assert make(floor=None).guard_config().floor == 0.004
    for bad in (dict(threshold=0.004), dict(suite_pass=11), dict(alpha=None), dict(floor=None, analytic_floor=None)):
        with pytest.raises(ValueError):
            make(**bad)
    spec = make(ranges={"a": (0, 1)}).monitor_spec()
    assert spec.threshold == 0.02 and spec.ranges == {"a": (0, 1)}


def test_operational_floor_uses_the_median_window(spark):
    df = spark.createDataFrame([(100,), (300,), (200,)], "n long")
    row = cal.operational_floor(df, n_ref=1000, k_features=1).first()
    assert row.n_window == 200
    assert row.floor == pytest.approx(chi2_ppf(0.95, 9) * (1 / 1000 + 1 / 200))
    assert row.threshold == pytest.approx(3 * row.floor)


def test_axis_may_be_a_timestamp(spark, pdf):
    df = spark.createDataFrame(pdf).withColumn("ts", F.timestamp_seconds(F.col("day") * 86400))
    a = cal.block_split_effects(df, SPEC, "ts", "id", blocks=3).orderBy("pair", "feature").collect()
    b = cal.block_split_effects(df, SPEC, "day", "id", blocks=3).orderBy("pair", "feature").collect()
    assert a == b


def ordered_last(frame):
    """Rows by axis and tie, those without axis behind the others."""
    return frame.sort_values(["t", "id"], na_position="last", kind="stable")


def test_rows_without_axis_come_last(spark):
    rng = np.random.default_rng(5)
    n = 4000
    frame = pd.DataFrame(dict(id=np.arange(n), x=rng.normal(size=n) + np.arange(n) / n, t=rng.integers(0, 50, n).astype(float)))
    frame.loc[rng.random(n) < 0.25, "t"] = np.nan
    df = spark.createDataFrame(frame).withColumn("t", F.when(~F.isnan("t"), F.col("t")))
    spec = MonitorSpec(num=("x",))
    got = cal.block_split_effects(df, spec, "t", "id", blocks=4).orderBy("pair").collect()
    parts = [p["x"].to_numpy() for p in np.array_split(ordered_last(frame), 4)]
    assert [(r.n0, r.n1) for r in got] == [(1000, 1000)] * 3
    for r, a, b in zip(got, parts, parts[1:]):
        assert r.effect == pytest.approx(np_psi(a, b), rel=1e-9)
    h = cal.homogeneity_by_feature(df, ["x"], key="id", axis="t").first()
    both = ordered_last(frame)["x"].to_numpy()
    assert h.n == n and h.h == pytest.approx(round(np_psi(both[:2000], both[2000:]) / (chi2_ppf(0.95, 9) * 2 / 2000), 2), abs=0.011)


def test_no_column_qualifies(table):
    out = cal.homogeneity_by_feature(table.limit(50), list(SPEC.num), key="id", axis="day")
    assert out.columns == ["feature", "n", "h", "verdict"] and out.count() == 0
    assert cal.homogeneity_audit(table.limit(50), axis="day", key="id", features=list(SPEC.num), repetitions=2).count() == 0


def test_audit_measures_every_column(spark):
    names = [f"c{i}" for i in range(64)]
    df = spark.range(600).select("id", (F.col("id") % 30).alias("t"), *[(F.col("id") * (7 + i) % 101).cast("double").alias(n) for i, n in enumerate(names)])
    out = cal.homogeneity_audit(df, axis="t", key="id", features=names, repetitions=2)
    assert {r.feature for r in out.select("feature").collect()} == set(names)
