"""Planted drift from data to decision, the model, and the streams."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidegauge.operators import model as m
from tidegauge.operators.calibrate import calibrate
from tidegauge.operators.metrics import performance
from tidegauge.operators.profile import build_profile
from tidegauge.operators.report import drift_report, summarise
from tidegauge.plans.monitor import backfill
from tidegauge.session import scratch_path
from tidegauge.streaming import adwin
from tidegauge.streaming import window_monitor as wm
from tidegauge.types import GuardConfig, MonitorSpec, SlidingWindow

NUM = ("torque", "deviation", "pressure", "temperature", "cycle", "angle")
CAT = ("rim", "shift", "supplier", "cell")
RANGES = {"torque": (90, 130), "deviation": (0, 20), "pressure": (25, 45), "temperature": (10, 45), "cycle": (8, 40), "angle": (200, 460)}


def process_table(seed=7, per_day=600, days=130):
    """One row per part; a campaign (60-89), an offset sensor in one cell (90-119), a
    unit change (125-130)."""
    rng = np.random.default_rng(seed)
    n = per_day * days
    day = np.repeat(np.arange(1, days + 1), per_day)
    campaign = (day >= 60) & (day <= 89)
    u = rng.random(n)
    usual = np.searchsorted(np.cumsum([0.30, 0.30, 0.25]), u)
    shifted = np.searchsorted(np.cumsum([0.05, 0.08, 0.07]), u)
    rim = np.where(campaign, shifted, usual)
    cell = rng.integers(1, 5, n)
    shift = np.searchsorted([0.40, 0.75], rng.random(n))
    supplier = np.searchsorted([0.5, 0.8], rng.random(n))
    real = rng.normal(110, 1.15, n)
    faulty = (cell == 2) & (day >= 90) & (day <= 119)
    real = np.where(faulty, real + 3.5 * rng.uniform(0.75, 1.0, n), real)
    torque = np.where(faulty, real - 3.5, real)
    pressure = rng.normal(35, 1.6, n) * np.where(day >= 125, 6.894757, 1.0)
    temperature = rng.normal(24, 2.2, n) + 3.0 * (shift == 2)
    base = np.array([18.0, 19.5, 21.0, 25.5])[rim]
    cycle = rng.normal(base, 1.4)
    logit = (
        -3.05 + 0.62 * np.abs(real - 110) + 0.030 * (temperature - 24) + 0.055 * (cycle - base) + 0.35 * (supplier == 2) + 0.30 * (shift == 2)
    )
    return pd.DataFrame(
        dict(
            id=np.arange(n), day=day, torque=torque, deviation=np.abs(torque - 110), pressure=pressure, temperature=temperature,
            cycle=cycle, angle=rng.normal(360, 18, n) + 0.8 * (real - 110), rim=np.array(["R16", "R17", "R18", "R20"])[rim],
            shift=np.array(list("ABC"))[shift], supplier=np.array(["S1", "S2", "S3"])[supplier],
            cell=[f"C{c}" for c in cell], failed=(rng.random(n) < 1 / (1 + np.exp(-logit))).astype(int), real=real,
        )
    )


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(process_table()).cache()


@pytest.fixture(scope="module")
def fitted(table):
    return m.train(table.where("day < 30"), num=NUM, cat=CAT, label="failed")


@pytest.fixture(scope="module")
def record(table):
    spec = MonitorSpec(num=NUM, cat=CAT)
    return calibrate(table.where("day < 30"), spec, key="id", axis="day", repetitions=20, cells=500).first()


@pytest.fixture(scope="module")
def profile(table, record):
    spec = MonitorSpec(num=NUM, cat=CAT, threshold=record.suggested_threshold, ranges=RANGES)
    return build_profile(table.where("day < 30"), spec)


def test_calibration(record):
    assert record.k_features == 6 and record.verdict == "homogeneous" and not record.contaminated
    assert 0.3 < record.aa_ratio < 3.0
    assert record.suggested_threshold > record.aa_floor


def test_silence_then_alarm(table, profile):
    window = SlidingWindow("day", 45, 80, width=3, step=35)
    s = {r.window: r for r in summarise(drift_report(table, profile, window=window), ["window"]).collect()}
    assert s[45].n_drift == 0
    assert s[80].n_drift > 0 and "rim" in s[80].features


def test_every_window_is_decided_as_planted(table, fitted, record, profile):
    scored = fitted.score(table.where("day >= 28"))
    config = GuardConfig(floor=record.aa_floor, threshold=record.suggested_threshold)
    window = SlidingWindow("day", 30, 130, width=3, step=5)
    rows = backfill(scored, profile, window, config, segment="cell", label="failed", score="p").where("cell = 'C2'").collect()
    got = {r.window: r for r in rows}
    assert set(got) == set(range(30, 131, 5))
    assert all(got[d].exit_code == 0 for d in range(30, 60, 5))
    assert all(got[d].exit_code != 10 for d in got), "nothing here may be answered by retraining"
    assert {got[d].cause for d in (70, 75, 80, 85)} == {"business"}
    assert sum(got[d].exit_code == 20 and got[d].cause == "hardware" for d in (95, 100, 105, 110, 115)) >= 3
    assert got[130].exit_code == 20 and got[130].cause == "pipeline"


def test_segment_performance_collapses_only_under_the_fault(table, fitted):
    scored = fitted.score(table.where("cell = 'C2' and (day between 43 and 45 or day between 108 and 110)"))
    auc = {r.late: r.roc_auc for r in performance(scored.withColumn("late", F.col("day") > 100), ["late"], label="failed").collect()}
    assert auc[False] > auc[True] + 0.05


def test_model_details(spark, tmp_path):
    rng = np.random.default_rng(4)
    n = 3000
    x, z = rng.normal(0, 1, n), rng.normal(0, 1, n)
    k = rng.choice(["a", "b", None], n, p=[0.5, 0.4, 0.1])
    y = (rng.random(n) < 1 / (1 + np.exp(-(-3 + 1.5 * x + (k == "b"))))).astype(int)
    x[rng.random(n) < 0.1] = np.nan
    df = spark.createDataFrame(pd.DataFrame(dict(x=x, z=z, k=k, y=y)))
    fit = m.train(df, num=("x", "z"), cat=("k",), label="y")
    assert fit.indicators == ("x",) and fit.modes == {"k": "a"} and fit.medians["x"] == pytest.approx(np.nanmedian(x), abs=0.01)
    scored = fit.score(df)
    assert scored.columns == ["x", "z", "k", "y", "p"]
    auc = performance(scored, label="y").first().roc_auc
    assert auc > 0.75
    # balanced weights centre the scores although positives are rare
    assert scored.agg(F.avg("p")).first()[0] == pytest.approx(0.45, abs=0.12)
    unseen = fit.score(df.limit(5).withColumn("k", F.lit("never seen"))).collect()
    assert all(0 < r.p < 1 for r in unseen)
    fit.save(str(tmp_path / "m"))
    again = m.TrainedModel.load(spark, str(tmp_path / "m")).score(df.limit(20)).collect()
    for a, b in zip(again, fit.score(df.limit(20)).collect()):
        assert a.p == pytest.approx(b.p)
    with pytest.raises(ValueError, match="one class"):
        m.train(df.where("y = 0"), num=("x",), label="y")


def test_held_out_rows_are_scored_once_by_each_model(spark):
    from tidegauge.operators import model as m

    seen = spark.sparkContext.accumulator(0)

    def counted(x):
        seen.add(1)
        return x

    rows = spark.range(400).select("id", (F.col("id") % 37 / 37.0).alias("x"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    champion = m.train(rows, num=("x",), label="y")
    holdout = rows.withColumn("x", F.udf(counted, "double").asNondeterministic()("x"))
    audit, _ = m.champion_challenger(rows, holdout, num=("x",), label="y", champion=champion)
    assert audit.first()["gain"] == 0 and seen.value == 2 * 400


def test_champion_challenger(spark):
    rng = np.random.default_rng(9)
    n = 2000
    x = rng.normal(0, 1, n)
    df = spark.createDataFrame(pd.DataFrame(dict(x=x, noise=rng.normal(0, 1, n), y=(rng.random(n) < 1 / (1 + np.exp(-2 * x))).astype(int), t=np.arange(n))))
    old, new = df.where("t < 1200"), df.where("t >= 1200")
    weak = m.train(old, num=("noise",), label="y")
    audit, promoted = m.champion_challenger(old, new, num=("x",), label="y", champion=weak)
    assert audit.first().outcome == "promoted" and promoted is not None
    audit, kept = m.champion_challenger(old, new, num=("noise",), label="y", champion=promoted)
    assert audit.first().outcome == "kept champion" and kept is None
    audit, none = m.champion_challenger(old, new, num=("x",), label="y", champion=weak, authorised=False)
    assert audit.first().exit_code == 20 and none is None
    audit, done = m.champion_challenger(old, new, num=("x",), label="y", champion=None, authorised=False, forced=True)
    assert audit.first().forced and done is not None
    audit, none = m.champion_challenger(old, new.limit(5), num=("x",), label="y", champion=weak)
    assert audit.first().exit_code == 30 and none is None


def test_stream_counts_equal_batch(spark):
    table = process_table(seed=3, per_day=150, days=30)[["id", "day", "torque", "rim"]]
    df = spark.createDataFrame(table).withColumn("ts", F.timestamp_seconds(F.col("day") * 86400 + F.col("id") % 80_000))
    profile = build_profile(df.where("day <= 12"), MonitorSpec(num=("torque",), cat=("rim",), min_obs=100))
    source, sink = scratch_path(spark, "in"), scratch_path(spark, "out")
    for lo, hi in ((1, 9), (10, 20), (21, 30)):
        df.where(F.col("day").between(lo, hi)).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(source)
    wm.run_available(wm.unit_count_stream(stream, profile, "ts", origin_day=0), sink, sink + "_cp")
    counts = spark.read.parquet(sink)
    days = {r.day for r in counts.select("day").distinct().collect()}
    assert days == set(range(1, 29)), "the watermark holds back the last open units"
    window = SlidingWindow("day", 14, 28)
    streamed = {(r.window, r.feature): r for r in wm.report_from_counts(counts, profile, window).collect()}
    batch = {(r.window, r.feature): r for r in drift_report(df, profile, window=window).collect()}
    assert set(streamed) == set(batch)
    for k, r in streamed.items():
        assert r.n_cur == batch[k].n_cur and r.effect == pytest.approx(batch[k].effect, abs=1e-12)
    resumed = wm.unit_count_stream(stream, profile, "ts", origin_day=0)
    wm.run_available(resumed, sink, sink + "_cp")
    assert spark.read.parquet(sink).count() == counts.count(), "a restart repeats nothing"


def test_change_points(spark):
    rng = np.random.default_rng(6)
    n = 20_000
    unit = np.arange(n) // 100
    steady = rng.normal(0, 1, n)
    moved = steady + np.where(unit >= 120, 1.0, 0.0)
    frame = pd.concat([pd.DataFrame(dict(k=k, unit=unit, x=x)) for k, x in (("steady", steady), ("moved", moved))])
    rows = adwin.change_points(spark.createDataFrame(frame), ["k"], "unit", "x").collect()
    hits = {k: sorted(r.unit for r in rows if r.k == k) for k in ("steady", "moved")}
    assert hits["steady"] == [] and hits["moved"] and 120 <= hits["moved"][0] <= 125


def test_cut_bound_by_hand():
    n = np.array([1000.0, 1000.0])
    s = np.array([0.0, 100.0])
    q = np.array([100.0, 110.0])
    variance = 210 / 2000 - (100 / 2000) ** 2
    log_term = math.log(2 * math.log(2000) / 0.002)
    bound = math.sqrt(2 * 0.002 * variance * log_term) + 2 / 3 * log_term * 0.002
    assert adwin.cut_found(n, s, q, 0.002, 5) is (0.1 > bound)
    assert not adwin.cut_found(n, s * 0.3, q, 0.002, 5)
