"""Closed-form values and row-level rules."""

import math

import pytest
from pyspark.sql import functions as F

from tidegauge.functions import stats
from tidegauge.functions.clean import bisect_sql, finite, infer_features, number
from tidegauge.functions.special import chi2_ppf, chi2_sf, kendall_tail
from tidegauge.operators.wear import wear_trend


def test_chi2_tail_closed_forms():
    for x in (0.1, 1.0, 5.0, 20.0, 80.0):
        assert chi2_sf(x, 2) == pytest.approx(math.exp(-x / 2), rel=1e-12)
        assert chi2_sf(x, 4) == pytest.approx(math.exp(-x / 2) * (1 + x / 2), rel=1e-12)
        assert chi2_sf(x, 1) == pytest.approx(math.erfc(math.sqrt(x / 2)), rel=1e-11)


def test_chi2_quantiles_and_published_sizes():
    assert chi2_ppf(0.95, 9) == pytest.approx(16.918977604620448, rel=1e-12)
    # published: the window size at which 0.1 is pure noise
    assert [round(chi2_ppf(0.95, b - 1) * 2 / 0.1) for b in (5, 10, 20)] == [190, 338, 603]
    assert chi2_ppf(0.95, 9) * 2 / 40_000 == pytest.approx(0.000846, abs=1e-6)


def test_kendall_tail_by_enumeration():
    from itertools import permutations

    for n in (4, 5, 6):
        scores = [sum(p[i] < p[j] for i in range(n) for j in range(i + 1, n)) for p in permutations(range(n))]
        pairs = n * (n - 1) // 2
        for c in range(pairs + 1):
            low = min(c, pairs - c)
            exact = min(1.0, 2 * sum(s <= low for s in scores) / len(scores))
            assert kendall_tail(n, c) == pytest.approx(1.0 if 2 * low == pairs else exact)


def test_coercion(spark):
    df = spark.createDataFrame([("1.5",), ("x",), ("NaN",), ("Infinity",), (None,)], "s string")
    rows = df.select(number("s").alias("n"), finite("s").alias("f")).collect()
    assert [r.n for r in rows] == [1.5, None, None, math.inf, None]
    assert [r.f for r in rows] == [1.5, None, None, None, None]


def test_bisect_counts_cuts_not_above(spark):
    cuts = [0.0, 1.0, 2.5, 7.0]
    xs = [-1.0, 0.0, 0.5, 1.0, 2.5, 6.9, 7.0, 9.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r[0] for r in df.select(F.expr(bisect_sql("x", cuts))).collect()]
    assert got == [sum(c <= x for c in cuts) for x in xs]


def test_feature_inference(spark):
    schema = spark.createDataFrame([(1, 2.0, "a", True)], "i int, d double, s string, b boolean").schema
    assert infer_features(schema) == (["i", "d"], ["s", "b"])


@pytest.mark.parametrize(
    "p, effect, expected",
    [(1e-30, 0.004, False), (0.30, 0.85, False), (1e-12, 0.42, True), (None, 0.9, False), (float("nan"), 0.9, False)],
)
def test_alarm_predicate(spark, p, effect, expected):
    df = spark.createDataFrame([(p, effect)], "p double, e double")
    assert df.select(stats.alarm("p", "e", 5e-4, 0.05)).first()[0] is expected


def test_coverage_threshold(spark):
    df = spark.createDataFrame([(0.95,), (0.10,), (0.0,)], "c double")
    high, low, none = [r[0] for r in df.select(stats.coverage_threshold("c", 0.01)).collect()]
    assert 0 < high < low < none == pytest.approx(0.1)


def test_floor_needs_enough_rows(spark):
    df = spark.createDataFrame([(19, 500), (20, 500)], "n int, m int")
    small, ok = [r[0] for r in df.select(stats.analytic_floor("n", "m")).collect()]
    assert small is None
    assert ok == pytest.approx(chi2_ppf(0.95, 9) * (1 / 20 + 1 / 500))


def test_split_hash_is_balanced_and_uncorrelated(spark):
    df = spark.range(20_000).select("id", *[stats.split_side("id", F.lit(r)).alias(f"s{r}") for r in range(4)])
    row = df.agg(*[F.avg(f"s{r}") for r in range(4)], F.avg(F.col("s0") * F.col("s1")), F.avg(F.col("s2") * F.col("s3"))).first()
    for share in row[:4]:
        assert share == pytest.approx(0.5, abs=0.015)
    for both in row[4:]:
        assert both == pytest.approx(0.25, abs=0.015)


SERIES = {
    "ramp": ([0.004, 0.007, 0.011, 0.016, 0.022, 0.029, 0.037, 0.046], True),
    "noise": ([0.021, 0.008, 0.019, 0.011, 0.024, 0.009, 0.017, 0.013], False),
    "step": ([0.005, 0.006, 0.005, 0.007, 0.31, 0.29, 0.33, 0.30], False),
    "short": ([0.1, 0.2, 0.3, 0.4, 0.5], False),
    "flat": ([0.1] * 8, False),
}


def test_wear_cases(spark):
    rows = [(k, i, x) for k, (xs, _) in SERIES.items() for i, x in enumerate(xs)]
    df = spark.createDataFrame(rows, "k string, w int, e double")
    out = {r.k: r for r in wear_trend(df, ["k"], "w", "e").collect() if r.w == len(SERIES[r.k][0]) - 1}
    assert {k: r.wear for k, r in out.items()} == {k: want for k, (_, want) in SERIES.items()}
    assert out["ramp"].tau == pytest.approx(1.0)
    assert out["ramp"].p_value == pytest.approx(2 / math.factorial(8))
    assert out["ramp"].max_rise == pytest.approx(9 / 42)
    # published by hand for the step: tau about 0.691, p about 0.018
    assert out["step"].tau == pytest.approx(0.691, abs=5e-4)
    assert out["step"].p_value == pytest.approx(0.018, abs=1e-3)
    assert out["flat"].p_value is None
