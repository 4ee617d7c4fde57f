"""Wide inputs, joins, checks, sources and the time axis."""

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import checks, prepare, windows
from tidegauge.operators.joins import join_one_to_one, key_set_difference
from tidegauge.operators.plant import label_events, sensor_offset, unit_change
from tidegauge.operators.ranges import range_violations, worst_violation
from tidegauge.sources import io
from tidegauge.types import Contract, SlidingWindow

COLS = [f"L{line}_S{s}_D{d}" for line in range(3) for s in (2 * line, 2 * line + 1) for d in (10 * s + 1, 10 * s + 2)]


@pytest.fixture(scope="module")
def dates(spark):
    rows = []
    for i in range(12):
        values = [None if (i + j) % 3 == 0 or i == 5 else float(100 * i + j) for j in range(len(COLS))]
        if i == 7:
            values[1] = float("nan")
        rows.append((i, *values))
    return spark.createDataFrame(rows, "Id bigint, " + ", ".join(f"{c} float" for c in COLS))


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 4 == 0) for i in range(12)], "Id bigint, r boolean").selectExpr("Id", "cast(r as tinyint) as Response")


def test_time_axis(dates, labels):
    rows = {r.Id: r for r in prepare.time_axis(dates, labels).collect()}
    assert len(rows) == 12
    undated = rows[5]
    assert undated.t_min is None and undated.n_stations == 0 and undated.week == -1 and undated.fortnight == -1
    r = rows[4]
    seen = [j for j in range(len(COLS)) if (4 + j) % 3]
    assert r.t_min == 400 + seen[0] and r.t_max == 400 + seen[-1] and r.duration == seen[-1] - seen[0]
    assert r.week == 4 and r.fortnight == 2
    stations = {j // 2 for j in seen}
    assert r.n_stations == len(stations) == sum(r[c] for c in r.asDict() if c.startswith("vis_"))
    assert rows[7].t_max == 710.0 and rows[7].t_min == 700.0  # NaN is a missing time, not the largest


def test_time_order_puts_undated_last(dates, labels):
    ids = [r.Id for r in prepare.in_time_order(prepare.time_axis(dates, labels)).collect()]
    assert ids[-1] == 5 and ids[:5] == [0, 1, 2, 3, 4]


def test_places_in_time_order_cover_all_rows(spark):
    from tidegauge.plans.catalog import QUERIES

    rows = [(i, None if i % 7 == 0 else float((i * 37) % 50)) for i in range(2000)]
    got = prepare.numbered_in_time_order(spark.createDataFrame(rows, "Id long, t_min double")).collect()
    wanted = sorted(rows, key=lambda r: (r[1] is None, r[1] or 0.0, r[0]))
    assert [(r.Id, r.t_min) for r in sorted(got, key=lambda r: r.place)] == wanted
    assert sorted(r.place for r in got) == list(range(1, 2001))
    every = QUERIES["time_order_places"](spark, "/root/testdata/sf0.001").collect()
    undated = [r.place for r in every if r.t_min is None]
    assert undated and min(undated) == len(every) - len(undated) + 1


def test_duplicate_keys_are_refused(spark, dates, labels):
    twice = labels.unionByName(labels.limit(1))
    with pytest.raises(Exception, match="duplicate key"):
        join_one_to_one(dates, twice, ["Id"], "left").collect()
    with pytest.raises(Exception, match="duplicate key"):
        join_one_to_one(dates.unionByName(dates.limit(1)), labels, ["Id"], "inner").collect()
    assert join_one_to_one(dates, labels.where("Id < 3"), ["Id"], "left").where("Response is null").count() == 9


def test_duplicate_keys_are_refused_whatever_is_read(spark, dates, labels):
    twice = labels.unionByName(labels.limit(1))
    doubled = dates.unionByName(dates.limit(1))
    bare = labels.select("Id").unionByName(labels.select("Id").limit(1))
    for left, right in ((dates, twice), (doubled, labels), (dates, bare), (doubled.select("Id"), labels.select("Id"))):
        for how in ("left", "inner"):
            joined = join_one_to_one(left, right, ["Id"], how)
            for read in (joined.count, joined.select("Id").collect, joined.agg(F.max("Id")).collect):
                with pytest.raises(Exception, match="duplicate key"):
                    read()
    with pytest.raises(Exception, match="duplicate key"):
        prepare.time_axis(dates, twice).groupBy("week").count().collect()
    plan = join_one_to_one(dates, labels, ["Id"])._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_topology_and_selection(spark):
    df = spark.range(500).select(
        F.when(F.col("id") % 2 == 0, F.col("id").cast("double")).alias("L0_S0_F1"),
        (F.col("id") * 2.0).alias("L0_S0_F3"),
        F.lit(1.0).alias("L0_S1_F5"),
        F.when(F.col("id") < 10, 1.0 * F.col("id")).alias("L1_S2_F7"),
        (F.col("id") * 0.5).alias("L1_S3_F9"),
        (F.col("id") * 3.0).alias("other"),
    )
    profile = prepare.feature_profile(df, df.columns)
    got = {r.feature: r for r in profile.collect()}
    assert got["L0_S0_F1"].coverage == 0.5 and got["L1_S2_F7"].variance == 0.0 and got["L0_S1_F5"].variance == 0.0
    chosen = [r.feature for r in prepare.select_features(profile, target=3, per_station=1).collect()]
    assert set(chosen) == {"L0_S0_F3", "L1_S3_F9", "other"}  # one per station, then topped up
    assert prepare.topology(profile.select("feature")).count() == 5


def test_artefact_checks(spark, dates, labels):
    meta = prepare.time_axis(dates, labels).withColumn("pos", F.col("Id"))
    good = {r.check: r for r in checks.artefact_checks(meta, dates, min_weeks=5, min_stations=6, rate=(0.1, 0.5), position="pos").collect()}
    assert all(r.ok for r in good.values()), good
    bad = checks.artefact_checks(meta.withColumn("pos", -F.col("Id")), dates.where("Id > 0"), position="pos")
    failed = {r.check for r in bad.where("not ok").collect()}
    assert {"same keys", "time order", "presence columns", "enough weeks", "failure rate in range"} <= failed
    with pytest.raises(ValueError):
        checks.require(bad)


def test_order_violations_cross_blocks(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([1, 2, 5, 4, 6, 3, 7])], "p int, v double")
    for block in (1, 2, 3, 100):
        assert checks.order_violations(df, "p", "v", block=block).first().n == 2


def test_key_sets(spark):
    a, b = spark.range(5), spark.range(2, 7)
    got = {(r.id, r.side) for r in key_set_difference(a, b, ["id"]).collect()}
    assert got == {(0, "left"), (1, "left"), (5, "right"), (6, "right")}


def test_ranges(spark):
    df = spark.createDataFrame([("1", 5.0), ("x", 50.0), ("9", float("nan")), ("10", 10.0)], "a string, b double")
    got = {r.feature: r for r in range_violations(df, {"a": (1, 9), "b": (0, 20), "zz": (0, 1)}).collect()}
    assert got["a"].fraction == pytest.approx(1 / 3) and got["b"].n == 3 and "zz" not in got
    assert worst_violation(range_violations(df, {"a": (1, 9), "b": (0, 20)})).first().worst_feature == "a"


def test_sliding_windows_cover_inclusive_ends(spark):
    df = spark.range(1, 21).select(F.col("id").cast("int").alias("day"))
    for step, width in ((1, 3), (5, 3), (2, 7)):
        w = SlidingWindow("day", first=6, last=20, width=width, step=step)
        got = {r.window: r.n for r in windows.assign_windows(df, w).groupBy("window").agg(F.count(F.lit(1)).alias("n")).collect()}
        want = {e: sum(e - width < d <= e for d in range(1, 21)) for e in range(6, 21, step)}
        assert got == want


def test_planting(spark):
    df = spark.range(200).select("id", (F.col("id") % 20).cast("int").alias("day"), F.lit(10.0).alias("v"), (F.col("id") % 2).alias("seg"))
    out = unit_change(df, "v", "day", 15, 2.0)
    assert {(r.day >= 15, r.v) for r in out.collect()} == {(False, 10.0), (True, 20.0)}
    out = sensor_offset(df, "v", "day", 5, 9, 4.0, segment=F.col("seg") == 1, key="id", compensated="real")
    for r in out.collect():
        if r.seg == 1 and 5 <= r.day <= 9:
            assert r.real - r.v == pytest.approx(4.0) and 13.0 <= r.real <= 14.0
        else:
            assert r.v == r.real == 10.0
    events = [{"name": "a", "start": 2, "end": 4}, {"name": "b", "start": 4, "end": 6}]
    got = {r.day: r.event for r in label_events(df, "day", events).select("day", "event").distinct().collect()}
    assert got[4] == "a" and got[6] == "b" and got[7] is None


def test_sources(spark, tmp_path, dates, labels):
    p = str(tmp_path / "t.parquet")
    io.write_parquet(prepare.time_axis(dates, labels), p, order=["t_min", "Id"], partitions=3)
    back = io.read_meta(spark, p, where="week >= 3", columns=["Id", "week", "t_min"])
    assert back.columns == ["Id", "week", "t_min"] and back.count() == 12 - 3 - 1
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(week), GreaterThanOrEqual(week,3)]" in plan
    c = str(tmp_path / "d.csv")
    dates.coalesce(1).write.option("header", True).csv(c)
    wide = io.read_wide_csv(spark, c, columns=["Id", COLS[0]], limit=5)
    assert dict(wide.dtypes) == {"Id": "bigint", COLS[0]: "float"} and wide.count() == 5
    with pytest.raises(ValueError):
        io.read_window(spark, "x.xlsx")
    io.write_results(back, str(tmp_path / "r"), "json")
    assert spark.read.json(str(tmp_path / "r")).count() == 8


def test_contract_round_trip(spark, tmp_path):
    c = Contract(
        version="1.0", origin="test", num=("a", "b"), cat=("c",), floor=0.005, analytic_floor=0.004, block_floor=0.006, homogeneity=1.1,
        threshold=0.02, alpha=0.05, min_obs=200, contexts={"x": (1, 5)}, ranges={"a": (0.0, 2.5)}, suite_pass=3, suite_total=3,
    )
    io.save_contract(spark, c, str(tmp_path / "c"))
    again = io.load_contract(spark, str(tmp_path / "none"), fallback=str(tmp_path / "c"))
    assert again.contexts == {"x": (1, 5)} and again.ranges == {"a": (0.0, 2.5)} and again.num == ("a", "b")
    assert again.guard_config() == c.guard_config() and again.lineage["spark"] == spark.version and again.created_at
    with pytest.raises(FileNotFoundError):
        io.load_contract(spark, str(tmp_path / "none"))


def test_history(spark, tmp_path):
    p = str(tmp_path / "h")
    schema = "monitor string, day bigint, exit_code int"
    io.append_decisions(spark.createDataFrame([("a", 1, 0), ("b", 1, 20)], schema), p, ["monitor"])
    io.append_decisions(spark.createDataFrame([("a", 2, 10)], schema), p, ["monitor"])
    got = {r.monitor: (r.day, r.exit_code) for r in io.last_decision(io.read_history(spark, p), ["monitor"], "day").collect()}
    assert got == {"a": (2, 10), "b": (1, 20)}


def test_kept_periods(spark):
    rows = [(p,) for p, n in ((1, 2), (2, 10), (3, 11), (4, 9), (5, 10), (6, 12), (7, 3)) for _ in range(n)]
    got = {r.p: r.is_reference for r in windows.kept_periods(spark.createDataFrame(rows, "p int"), "p").collect()}
    assert got == {2: True, 3: True, 4: True, 5: True, 6: False}
