"""The chained decision stream: counting, measuring and closing windows, apart from its two queries."""

import datetime as dt
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from tidegauge.operators.profile import build_profile
from tidegauge.streaming import decisions as ds
from tidegauge.types import MonitorSpec, SlidingWindow

ORIGIN_DAY = 19722
DAY = ds.DAY_MS


class State:
    """A state variable held in a dictionary."""

    def __init__(self):
        self.held = {}

    def exists(self):
        return () in self.held

    def get(self):
        return self.held[()]

    def update(self, value):
        self.held[()] = value

    def containsKey(self, key):  # noqa: N802
        return key in self.held

    def getValue(self, key):  # noqa: N802
        return self.held[key]

    def updateValue(self, key, value):  # noqa: N802
        self.held[key] = value

    def removeKey(self, key):  # noqa: N802
        del self.held[key]


class Handle:
    def __init__(self):
        self.timers = []

    def getMapState(self, *_):  # noqa: N802
        return State()

    getValueState = getMapState

    def registerTimer(self, at):  # noqa: N802
        self.timers.append(at)


class Clock:
    def __init__(self, watermark):
        self.watermark = watermark

    def getCurrentWatermarkInMs(self):  # noqa: N802
        return self.watermark


def merger(window, per_segment=True, key=(0,)):
    made = ds.WindowMerger(ds.Reference(MonitorSpec(num=("x",), min_obs=5), {"x": (50, 50)}, {}), window, ORIGIN_DAY, per_segment)
    made.init(Handle())
    return made


def rows(*counts):
    return iter([pd.DataFrame([(0, s, d, ds.ROWS, "", "", n) for s, d, n in counts], columns=[c.split()[0] for c in ds.COUNTS.split(", ")])])


def closed(frames):
    return sorted((r.segment, int(r.window), int(r.n_rows)) for f in frames for r in f.itertuples())


def test_windows_close_in_order_for_every_known_monitor():
    m = merger(SlidingWindow("day", first=3, last=9, width=3, step=2))
    m.handleInitialState((0,), pd.DataFrame({"segment": ["a", "silent"]}), Clock(0))
    assert m.handle.timers == [m.end_of(3)]
    assert not list(m.handleInputRows((0,), rows(("a", 1, 10), ("a", 3, 5), ("b", 4, 7), (None, 3, 99)), Clock(0)))
    # the watermark passes the ends of windows 3 and 5 at once
    assert closed(m.handleExpiredTimer((0,), Clock(m.end_of(6)), None)) == [
        ("a", 3, 15), ("a", 5, 5), ("b", 3, 0), ("b", 5, 7), ("silent", 3, 0), ("silent", 5, 0),
    ]
    assert m.handle.timers[-1] == m.end_of(7)
    assert set(k[0] for k in m.days.held) == set()  # window 7 needs days 5 to 7 only
    # day 6 has ended, day 7 has not
    (late,) = m.handleInputRows((0,), rows(("a", 6, 2), ("a", 6, 1), (None, 6, 4), ("a", 7, 8)), Clock(m.end_of(6)))
    assert sorted((str(r.segment), int(r.window), int(r.n_late)) for r in late.itertuples()) == [("None", 6, 4), ("a", 6, 3)]
    assert closed(m.handleExpiredTimer((0,), Clock(m.end_of(30)), None)) == [
        ("a", 7, 8), ("a", 9, 8), ("b", 7, 0), ("b", 9, 0), ("silent", 7, 0), ("silent", 9, 0),
    ]
    assert len(m.handle.timers) == 2  # no timer behind the last window


def test_late_rows_of_all_are_told_once():
    m = merger(SlidingWindow("day", first=3, last=9))
    late = list(m.handleInputRows((5,), rows((None, 1, 4)), Clock(m.end_of(2))))
    assert late == []  # bucket 0 says it


def test_no_window_before_its_day_ends():
    m = merger(SlidingWindow("day", first=3, last=9))
    list(m.handleInputRows((0,), rows(("a", 3, 9)), Clock(0)))
    assert list(m.handleExpiredTimer((0,), Clock(m.end_of(3) - 1), None)) == []
    assert closed(m.handleExpiredTimer((0,), Clock(m.end_of(3)), None)) == [("a", 3, 9)]


def test_auc_over_cells():
    rng = np.random.default_rng(3)
    y, p = rng.integers(0, 2, 300), np.round(rng.random(300), 2)
    counts = Counter((ds.SCORED, "pos" if a else "neg", str(round(b * ds.SCORE_CELLS))) for a, b in zip(y, p))
    pairs = [(a > b) + 0.5 * (a == b) for a in p[y == 1] for b in p[y == 0]]
    assert ds.auc(counts) == (round(float(np.mean(pairs)), 5), 300)
    assert ds.auc({(ds.SCORED, "neg", "4"): 50}) == (None, 50) and ds.auc({}) == (None, 0)
    few = {(ds.SCORED, "pos", "4"): 7, (ds.SCORED, "neg", "2"): 90}
    assert ds.auc(few) == (None, 97)  # fewer than eight positives


def test_equal_counts_are_no_drift_and_shifted_ones_are():
    ref = ds.Reference(MonitorSpec(num=("x",), cat=("c",), min_obs=20, threshold=0.05, ranges={"x": (0, 1)}), {"x": (100, 100, 100)}, {"c": {"a": 150, "b": 150}})
    calm = {(ds.ROWS, "", ""): 60, **{(ds.BIN, "x", str(i)): 20 for i in range(3)}, (ds.CATEGORY, "c", "a"): 30, (ds.CATEGORY, "c", "b"): 30}
    assert ds.evidence_of(ref, calm, {}, False)[:5] == (60, 0, 0.0, None, None)
    gone = {**calm, (ds.BIN, "x", "0"): 60, (ds.BIN, "x", "1"): 0, (ds.BIN, "x", "2"): 0, (ds.CATEGORY, "c", "new"): 60, (ds.SEEN, "x", ""): 60, (ds.OUT, "x", ""): 6}
    n, drift, effect, worst, fraction, *_ = ds.evidence_of(ref, gone, {}, False)
    assert (n, drift, worst, fraction) == (60, 2, None, None) and effect > 1  # a tenth is not severe yet
    assert ds.evidence_of(ref, {**gone, (ds.OUT, "x", ""): 7}, {}, False)[3] == "x"
    assert ds.evidence_of(ref, {**gone, (ds.ROWS, "", ""): 19}, {}, False)[:3] == (19, 0, None)
    assert ds.evidence_of(ref, gone, {}, True)[:2] == (0, 0)  # a monitor without rows of its own


def test_batches_are_counted_where_they_lie(spark, monkeypatch):
    start = dt.datetime(2024, 1, 1)
    made = [(start + dt.timedelta(hours=7 * i), f"s{i % 3}" if i % 5 else None, float(i % 4) if i % 7 else None, "u" if i % 2 else None, i % 2, (i % 10) / 10) for i in range(200)]
    made.append((None, "s1", 1.0, "u", 1, 0.5))  # no time: counted nowhere
    df = spark.createDataFrame(made, "ts timestamp, seg string, x double, c string, y int, p double")
    profile = build_profile(df, MonitorSpec(num=("x",), cat=("c",), bins=4, ranges={"x": (0.5, 2.5)}))
    want = Counter()
    edges = profile.edges["x"]
    for ts, seg, x, c, y, p in made[:-1]:
        day = (ts - start).days + 1
        slots = [(ds.ROWS, "", ""), (ds.SCORED, "pos" if y else "neg", str(round(p * ds.SCORE_CELLS)))]
        if x is not None:
            slots += [(ds.BIN, "x", str(sum(x >= e for e in edges[1:-1]))), (ds.SEEN, "x", "")] + ([(ds.OUT, "x", "")] if not 0.5 <= x <= 2.5 else [])
        slots += [(ds.CATEGORY, "c", c)] if c else []
        for slot in slots:
            for bucket in range(2):
                want[None, bucket, day, *slot] += 1
            if seg:
                want[seg, None, day, *slot] += 1
    for held in (500_000, 3):
        monkeypatch.setattr(ds, "COMBINED_ROWS", held)
        counted = ds.unit_counts(df, profile.spec, profile.edges, "ts", origin_day=ORIGIN_DAY, segment="seg", label="y", score="p", buckets=2).collect()
        got, homes = Counter(), {}
        for r in counted:
            got[r.segment, r.bucket if r.segment is None else None, r.day, r.kind, r.feature, r.slot] += r.n
            if r.segment is not None:
                assert homes.setdefault(r.segment, r.bucket) == r.bucket
        assert got == want


@pytest.mark.parametrize("corrected, below, above", [(True, 0.0015, 0.0017), (False, 0.0007, 0.0008)])
def test_chi_squared_of_two_categories(corrected, below, above):
    """9.956 with Yates' correction has the tail 0.0016, 11.429 without has 0.00072."""
    for alpha, told in ((below, False), (above, True)):
        ref = ds.Reference(MonitorSpec(cat=("c",), alpha=alpha), {}, {})
        assert ref.test(np.array([30, 15]), np.array([10, 25]), corrected) == told
        assert not ref.test(np.array([3, 0]), np.array([5, 0]), corrected)
