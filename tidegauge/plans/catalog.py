"""The registered queries: every operator applied to the given tables.

``events`` is the monitored table: days 1-15 are the reference, later days the
windows; ``value`` and ``k`` (from the JSON properties) are numeric features,
``event_type`` a category, ``seg`` the segment. ``orders`` stands in for parts on a
line and ``lineitem`` for wide process data.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions import stats
from tidegauge.operators import calibrate as cal
from tidegauge.operators import checks, metrics, plant, prepare
from tidegauge.operators.capability import capability_table, cpk, ppm_out_of_spec
from tidegauge.operators.distance import (
    bin_counts,
    categorical_statistics,
    numeric_statistics,
    psi_from_bins,
    wasserstein_statistics,
)
from tidegauge.operators.joins import join_one_to_one, key_set_difference, members, non_members, suffixed_join
from tidegauge.operators.policy import cooled_down, decide, diagnose, guard_table, remembered
from tidegauge.operators.profile import ReferenceProfile, build_profile
from tidegauge.operators.ranges import range_violations, worst_violation
from tidegauge.operators.report import drift_report, summarise
from tidegauge.operators.wear import wear_trend
from tidegauge.operators.windows import (
    assign_windows,
    day_axis,
    interval_label,
    kept_periods,
    presence_drift,
)
from tidegauge.plans.monitor import backfill, decide_next, decide_window, window_evidence
from tidegauge.session import materialise, metadata_table, scratch_path
from tidegauge.sources import io
from tidegauge.sources.io import last_decision, read_window
from tidegauge.types import Contract, GuardConfig, MonitorSpec, SlidingWindow

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ORIGIN = "2024-01-01"
ORIGIN_DAY = 19722  # days from 1970-01-01 to the day before ORIGIN
REFERENCE_DAYS = 15
WINDOW = SlidingWindow("day", first=18, last=30, width=3, step=1)
RANGES = {"value": (0.0, 200.0), "k": (0.0, 94.0), "absent": (0.0, 1.0)}
SPEC = MonitorSpec(num=("value", "k"), cat=("event_type",), threshold=0.02, ranges=RANGES)
NUMERIC = SPEC.but(cat=())
CATEGORICAL = SPEC.but(num=())
GUARDS = GuardConfig(floor=0.006, threshold=0.02, k=2, n=4, cooldown=3, contexts={"campaign": (19, 20)})
EVENTS = [
    {"name": "campaign", "start": 19, "end": 21, "must_alarm": True, "exit_code": 0},
    {"name": "sensor", "start": 22, "end": 25, "must_alarm": False, "exit_code": 20},
    {"name": "recovered", "start": 26, "end": 27, "must_alarm": False, "exit_code": 0},
    {"name": "unit change", "start": 28, "end": 30, "must_alarm": True, "exit_code": 20},
]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def r6(c: Column | str, digits: int = 6) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, digits) + F.lit(0.0)


def long(c: str) -> Column:
    return F.col(c).cast("bigint").alias(c)


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return read_window(spark, f"{d}/{name}.parquet")


def events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").alias("k"),
        day_axis("ts", ORIGIN).alias("day"),
        (F.col("user_id") % 4).alias("seg"),
    )


def reference(spark: SparkSession, d: str) -> DataFrame:
    return events(spark, d).where(F.col("day") <= REFERENCE_DAYS)


def current(spark: SparkSession, d: str) -> DataFrame:
    return events(spark, d).where(F.col("day") > REFERENCE_DAYS)


def planted(spark: SparkSession, d: str) -> DataFrame:
    """Events with a campaign, an offset sensor and a unit change planted."""
    df = events(spark, d)
    df = plant.category_shift(df, "event_type", "day", 19, 21, "view", 0.6, key="event_id")
    df = plant.sensor_offset(
        df, "value", "day", 22, 25, 3.5, segment=F.col("seg") == 2, key="event_id", compensated="real_value"
    )
    df = plant.unit_change(df, "value", "day", 28)
    return scored(df)


def scored(df: DataFrame) -> DataFrame:
    """A deterministic score in (0, 1) that ranks errors above other events, except
    in the faulty segment of the planted table."""
    base = ((F.col("event_id") * 7919) % 1000) / 1000.0 * 0.6
    lift = F.when((F.col("event_type") == "error") & ~((F.col("seg") == 2) & F.col("day").between(22, 25)), 0.25).otherwise(0.05)
    return df.withColumn("y", F.when(F.col("event_type") == "error", 1).otherwise(0)).withColumn("p", base + lift)


def profile_of(spark: SparkSession, d: str, spec: MonitorSpec = SPEC) -> ReferenceProfile:
    return build_profile(reference(spark, d), spec)


def one(df: DataFrame) -> DataFrame:
    return df.withColumn("g", F.lit(0))


# --- sources ---------------------------------------------------------------
@query
def pruned_scan(spark, d):
    df = read_window(
        spark, f"{d}/lineitem.parquet", columns=["l_returnflag", "l_quantity"],
        where=(F.col("l_quantity") > 40) & (F.col("l_discount") < 0.03),
    )
    return df.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), r6(F.sum("l_quantity")).alias("quantity"))


@query
def last_decision_per_monitor(spark, d):
    log = table(spark, d, "events").select("user_id", "event_id", "event_type", "value")
    return last_decision(log, ["user_id"], "event_id").select("user_id", "event_id", "event_type", r6("value").alias("value"))


# --- projections and filters -----------------------------------------------
@query
def coerced_numbers(spark, d):
    from tidegauge.functions.clean import finite, number

    raw = table(spark, d, "events").select(
        F.when(F.col("event_id") % 10 == 0, F.lit("n/a")).when(F.col("event_id") % 10 == 1, F.lit("Infinity"))
        .otherwise(F.get_json_object("props", "$.k")).alias("x"), "event_type"
    )
    return raw.groupBy("event_type").agg(
        F.count(number("x")).alias("n_number"), F.count(finite("x")).alias("n_finite"), F.sum(finite("x")).alias("total")
    )


@query
def range_violation(spark, d):
    out = range_violations(events(spark, d), RANGES, window=WINDOW)
    return out.select("window", "feature", "n", r6("fraction").alias("fraction"))


@query
def worst_range_feature(spark, d):
    out = worst_violation(range_violations(planted(spark, d), RANGES, window=WINDOW), ["window"])
    return out.select("window", "worst_feature", r6("worst_fraction").alias("worst_fraction"))


@query
def absolute_deviation(spark, d):
    dev = plant.absolute_deviation("value", 50.0)
    return events(spark, d).groupBy("event_type").agg(r6(F.avg(dev)).alias("mean_dev"), r6(F.max(dev)).alias("max_dev"))


WIDE = {
    "L0_S0_F0": "l_quantity",
    "L0_S0_F2": "CASE WHEN l_linenumber <> 1 THEN l_extendedprice END",
    "L0_S1_F4": "l_discount",
    "L1_S24_F6": "CASE WHEN l_orderkey % 25 = 0 THEN l_tax END",
    "L1_S24_F8": "CAST(l_linenumber AS DOUBLE)",
    "L1_S25_F10": "CAST(1 AS DOUBLE)",
    "L2_S26_F12": "CASE WHEN l_orderkey % 2 = 0 THEN l_quantity * l_discount END",
    "aux": "CAST(l_partkey AS DOUBLE)",
}


def wide_lines(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(*[F.expr(e).alias(n) for n, e in WIDE.items()])


DATES = {
    "L0_S0_D1": (0.0, "Id % 7 <> 0"),
    "L0_S0_D2": (1.5, "Id % 5 <> 0"),
    "L0_S1_D4": (3.25, "Id % 3 <> 0"),
    "L1_S24_D6": (8.5, "Id % 2 <> 0"),
    "L1_S25_D8": (20.75, "Id % 11 = 0"),
    "L2_S30_D10": (40.5, "Id % 13 = 0"),
}


def part_dates(spark: SparkSession, d: str) -> DataFrame:
    """Wide times in hundredths of a week, one row per order."""
    t = F.datediff(F.to_date("o_orderdate"), F.to_date(F.lit("1995-01-01"))) * 14.25
    base = table(spark, d, "orders").select(F.col("o_orderkey").alias("Id"), t.alias("t"))
    return base.select(
        "Id", *[F.when(F.expr(ok), F.col("t") + F.lit(off)).cast("float").alias(n) for n, (off, ok) in DATES.items()]
    )


def part_labels(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("Id"), F.when(F.col("o_orderkey") % 171 == 7, 1).otherwise(0).cast("tinyint").alias("Response")
    )


def meta(spark: SparkSession, d: str) -> DataFrame:
    return prepare.time_axis(part_dates(spark, d), part_labels(spark, d))


@query
def column_topology(spark, d):
    profile = prepare.feature_profile(wide_lines(spark, d), list(WIDE))
    joined = profile.join(F.broadcast(prepare.topology(profile.select("feature"))), "feature", "left")
    return joined.select("feature", long("line"), long("station_no"), long("number"), "station", "n_valid")


@query
def row_first_last(spark, d):
    cols = list(DATES)
    rows = part_dates(spark, d).select(prepare.first_of(cols).alias("a"), prepare.last_of(cols).alias("b"), "Id")
    return rows.groupBy((F.col("Id") % 30).alias("g")).agg(
        F.count("a").alias("n_dated"), r6(F.min("a")).alias("first"), r6(F.max("b")).alias("last"), r6(F.sum(F.col("b") - F.col("a")), 4).alias("crossing")
    )


@query
def station_presence(spark, d):
    stations = prepare.stations_of(list(DATES))
    rows = part_dates(spark, d).select("Id", *[prepare.present(c).cast("int").alias(s) for s, c in stations.items()])
    n = sum((F.col(s) for s in stations), F.lit(0))
    return rows.withColumn("n_stations", n).groupBy("n_stations").agg(
        F.count(F.lit(1)).alias("parts"), *[F.sum(s).alias(s.lower()) for s in stations]
    ).select(long("n_stations"), "parts", *[s.lower() for s in stations])


@query
def time_bucket(spark, d):
    m = meta(spark, d)
    return m.groupBy(long("week"), long("fortnight")).agg(F.count(F.lit(1)).alias("n"))


@query
def sliding_windows(spark, d):
    daily = events(spark, d).groupBy("day").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("v"))
    return assign_windows(daily, WINDOW).groupBy("window").agg(F.sum("n").alias("n"), r6(F.sum("v"), 4).alias("v"))


@query
def segment_windows(spark, d):
    daily = events(spark, d).groupBy("day", "seg").agg(F.count(F.lit(1)).alias("n"))
    return assign_windows(daily, WINDOW).groupBy("window", "seg").agg(F.sum("n").alias("n"))


def event_catalogue(spark: SparkSession) -> DataFrame:
    rows = [(e["name"], e["start"], e["end"], i, e["must_alarm"], e["exit_code"]) for i, e in enumerate(EVENTS)]
    return metadata_table(spark, rows, "name string, start int, end int, ord int, must_alarm boolean, exit_code int")


@query
def event_label(spark, d):
    daily = events(spark, d).groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    out = interval_label(daily, event_catalogue(spark), "day", "start", "end", "name", "ord")
    return out.select(long("day"), "n", F.col("name").alias("event"))


@query
def context_label(spark, d):
    from tidegauge.operators.windows import context_expression

    daily = events(spark, d).groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    return daily.select(long("day"), "n", context_expression("day", GUARDS.contexts).alias("context"))


@query
def coverage_threshold(spark, d):
    profile = prepare.feature_profile(wide_lines(spark, d), list(WIDE))
    return profile.select("feature", r6("coverage").alias("coverage"), r6(stats.coverage_threshold("coverage", 0.01)).alias("threshold"))


@query
def alarm_predicate(spark, d):
    rows = events(spark, d).groupBy("user_id").agg(
        F.avg(F.when(F.col("event_type") == "error", 0.0).when(F.col("event_type") == "view", 0.01)).alias("p"),
        (F.avg("value") / 100).alias("e"),
    )
    return rows.select("user_id", stats.alarm("p", "e", 0.0051, 0.5).alias("alarm"))


# --- joins -----------------------------------------------------------------
@query
def joined_one_to_one(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "n_chars")
    out = join_one_to_one(docs, table(spark, d, "labels"), ["doc_id"], "left")
    return out.select("doc_id", "lang", long("n_chars"), long("quality"), long("toxic"))


@query
def inner_one_to_one(spark, d):
    m = meta(spark, d).select("Id", "week", "t_min")
    feats = table(spark, d, "orders").select(F.col("o_orderkey").alias("Id"), "o_totalprice")
    out = join_one_to_one(m, feats, ["Id"], "inner")
    return out.groupBy(long("week")).agg(F.count(F.lit(1)).alias("n"), r6(F.sum("o_totalprice"), 2).alias("price"))


@query
def suffixed_tables(spark, d):
    ev = events(spark, d)
    a = ev.where("day <= 15").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    b = ev.where("day > 15").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return suffixed_join(a, b, ["event_type"], ("_ref", "_cur"))


@query
def category_alignment(spark, d):
    ev = planted(spark, d)
    side = F.col("day") <= REFERENCE_DAYS
    return ev.groupBy(F.col("event_type").alias("category")).agg(F.count_if(side).alias("n_ref"), F.count_if(~side).alias("n_cur"))


@query
def membership(spark, d):
    ev = events(spark, d)
    kept = kept_periods(ev, "day").where("is_reference")
    inside = members(ev, kept, ["day"]).agg(F.count(F.lit(1)).alias("n")).select(F.lit("in").alias("part"), "n")
    return inside.unionByName(non_members(ev, kept, ["day"]).agg(F.count(F.lit(1)).alias("n")).select(F.lit("out").alias("part"), "n"))


@query
def key_set_diff(spark, d):
    return key_set_difference(
        table(spark, d, "documents").select("doc_id"), table(spark, d, "labels").select("doc_id"), ["doc_id"]
    )


# --- two-sample measurement --------------------------------------------------
@query
def reference_edges(spark, d):
    p = profile_of(spark, d, NUMERIC)
    rows = [(f, i, e) for f, es in p.edges.items() for i, e in enumerate(es)]
    return metadata_table(spark, rows, "feature string, i bigint, edge double").select("feature", "i", r6("edge").alias("edge"))


@query
def bin_histogram(spark, d):
    out = bin_counts(events(spark, d), profile_of(spark, d, NUMERIC), [], WINDOW)
    return out.select("window", "feature", long("bin"), "n")


@query
def psi(spark, d):
    p = profile_of(spark, d, NUMERIC)
    out = psi_from_bins(bin_counts(one(current(spark, d)), p, ["g"]), p, ["g"])
    return out.select("feature", "n_cur_finite", r6("psi").alias("psi"))


@query
def js_divergence(spark, d):
    out = categorical_statistics(planted(spark, d), profile_of(spark, d, CATEGORICAL), [], WINDOW)
    return out.select("window", "feature", r6("js").alias("js"))


@query
def wasserstein(spark, d):
    out = wasserstein_statistics(events(spark, d), profile_of(spark, d, NUMERIC), [], WINDOW)
    return out.select("window", "feature", r6("wasserstein", 5).alias("wasserstein"))


@query
def ks_statistic(spark, d):
    out = numeric_statistics(events(spark, d), profile_of(spark, d, NUMERIC), [], WINDOW)
    return out.select("window", "feature", r6("ks").alias("ks"))


@query
def ks_pvalue(spark, d):
    p = profile_of(spark, d, NUMERIC)
    out = numeric_statistics(planted(spark, d), p, ["seg"], WINDOW)
    n_ref = F.when(F.col("feature") == "value", p.numeric["value"].n_valid).otherwise(p.numeric["k"].n_valid)
    return out.select("seg", "window", "feature", r6(stats.ks_pvalue("ks", n_ref, "n_cur_valid")).alias("p_value"))


@query
def chi2_statistic(spark, d):
    out = categorical_statistics(planted(spark, d), profile_of(spark, d, CATEGORICAL), [], WINDOW)
    return out.select("window", "feature", r6("chi2", 4).alias("chi2"), long("dof"))


def flagged(spark: SparkSession, d: str) -> DataFrame:
    return events(spark, d).withColumn("is_error", (F.col("event_type") == "error"))


@query
def chi2_two_categories(spark, d):
    df = flagged(spark, d)
    p = build_profile(df.where(F.col("day") <= REFERENCE_DAYS), MonitorSpec(cat=("is_error",)))
    out = categorical_statistics(df, p, [], WINDOW)
    return out.select("window", r6("chi2", 5).alias("chi2"), long("dof"))


@query
def chi2_pvalue(spark, d):
    out = categorical_statistics(events(spark, d), profile_of(spark, d, CATEGORICAL), ["seg"], WINDOW)
    return out.select("seg", "window", r6(stats.chi2_pvalue("chi2", "dof")).alias("p_value"))


def rounded_report(rep: DataFrame, *keys: str) -> DataFrame:
    return rep.select(
        *keys, "feature", "kind", r6("stat", 5).alias("stat"), r6("p_value").alias("p_value"), r6("effect").alias("effect"),
        "measurable", "n_ref", "n_cur", "drift",
    )


@query
def drift_report_windows(spark, d):
    rep = drift_report(planted(spark, d), profile_of(spark, d), window=WINDOW)
    return rounded_report(rep, "window")


@query
def drift_report_segments(spark, d):
    rep = drift_report(planted(spark, d), profile_of(spark, d), by=["seg"], window=WINDOW)
    return rounded_report(rep, "seg", "window")


@query
def drift_report_wasserstein(spark, d):
    spec = NUMERIC.but(metric="wasserstein", threshold=1.0)
    out = drift_report(planted(spark, d), profile_of(spark, d, spec), window=WINDOW)
    return out.select(
        "window", "feature", r6("stat", 5).alias("stat"), r6("p_value").alias("p_value"), r6("effect", 5).alias("effect"), "measurable", "n_cur", "drift"
    )


@query
def drift_summary(spark, d):
    s = summarise(drift_report(planted(spark, d), profile_of(spark, d), window=WINDOW), ["window"])
    return s.select(
        "window", "n_cur", "n_drift", "n_not_measurable", r6("effect_max").alias("effect_max"),
        F.array_join("features", ",").alias("features"),
    )


@query
def presence_spread(spark, d):
    m = meta(spark, d)
    flags = [c for c in m.columns if c.startswith("vis_")]
    out = presence_drift(m.where("week >= 0"), "week", flags)
    return out.select("station", *[r6(c).alias(c) for c in ("lowest", "highest", "spread")])


# --- calibration -----------------------------------------------------------
@query
def analytic_floor(spark, d):
    counts = assign_windows(events(spark, d).groupBy("day").agg(F.count(F.lit(1)).alias("n")), WINDOW)
    n = counts.groupBy("window").agg(F.sum("n").alias("n"))
    n_ref = reference(spark, d).count()
    return n.select(
        "window", "n",
        r6(stats.analytic_floor(F.lit(n_ref), "n")).alias("floor"),
        r6(stats.analytic_floor(F.lit(n_ref), "n", k_features=6)).alias("floor_6"),
    )


@query
def threshold_slack(spark, d):
    n_ref = reference(spark, d).count()
    counts = current(spark, d).groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    out = cal.threshold_slack(counts, F.lit(n_ref), "n", threshold=0.1, bins=[5, 10, 20, 50])
    return out.select(
        long("day"), "n", long("bins"), r6("floor").alias("floor"), r6("n_p95", 4).alias("n_p95"),
        r6("n_mean", 4).alias("n_mean"), r6("slack", 4).alias("slack"),
    )


REPETITIONS = 12


@query
def aa_random_floor(spark, d):
    eff = cal.random_split_effects(reference(spark, d), SPEC, "event_id", repetitions=REPETITIONS)
    out = cal.random_floor(eff)
    return out.select(*[r6(c).alias(c) for c in ("aa_floor", "aa_median", "aa_max")], "n_repetitions")


@query
def aa_effects(spark, d):
    eff = cal.random_split_effects(reference(spark, d), SPEC, "event_id", repetitions=REPETITIONS, seed=3)
    return eff.select(long("rep"), "feature", "kind", "n0", "n1", r6("effect").alias("effect"))


@query
def aa_random_floor_grid(spark, d):
    eff = cal.random_split_effects(reference(spark, d), SPEC, "event_id", repetitions=REPETITIONS, cells=256)
    return cal.random_floor(eff).select(*[r6(c).alias(c) for c in ("aa_floor", "aa_median", "aa_max")], "n_repetitions")


@query
def aa_block_floor(spark, d):
    out = cal.block_floor(cal.block_split_effects(reference(spark, d), SPEC, "day", "event_id", blocks=4))
    return out.select(r6("block_floor").alias("block_floor"), "worst_pair")


@query
def block_effects(spark, d):
    out = cal.block_split_effects(reference(spark, d), SPEC, "day", "event_id", blocks=4)
    return out.select(long("pair"), "feature", "n0", "n1", r6("effect").alias("effect"))


@query
def calibration_record(spark, d):
    out = cal.calibrate(reference(spark, d), SPEC, key="event_id", axis="day", repetitions=REPETITIONS, blocks=2)
    return out.select(
        "n_reference", long("k_features"), long("bins"), "aa_floor", "aa_median", "aa_max", "n_repetitions", "block_floor",
        "worst_pair", "analytic_floor", "aa_ratio", "homogeneity", "verdict", "suggested_threshold", "contaminated",
    )


def drifting(spark: SparkSession, d: str) -> DataFrame:
    """A reference with a second regime of ``value`` in its last three days."""
    return reference(spark, d).withColumn("value", F.when(F.col("day") > 12, F.col("value") + 50.0).otherwise(F.col("value")))


@query
def homogeneity_index(spark, d):
    out = cal.calibrate(drifting(spark, d), SPEC, key="event_id", axis="day", mode="block", blocks=3)
    return out.select("block_floor", "worst_pair", "homogeneity", "verdict", "suggested_threshold", "contaminated")


@query
def homogeneity_by_feature(spark, d):
    out = cal.homogeneity_by_feature(drifting(spark, d), ["value", "k"], key="event_id", axis="day")
    return out.select("feature", "n", "h", "verdict")


@query
def homogeneity_audit(spark, d):
    audit = cal.homogeneity_audit(
        drifting(spark, d), axis="day", key="event_id", features=["value", "k"], repetitions=REPETITIONS, min_values=400
    )
    return audit.select("feature", "n", "h_block", "h_random", "verdict")


@query
def audit_summary(spark, d):
    audit = cal.homogeneity_audit(
        drifting(spark, d), axis="day", key="event_id", features=["value", "k"], repetitions=REPETITIONS, min_values=400
    )
    out = cal.audit_summary(audit)
    return out.select(
        "n_features", "n_contaminated", r6("h_block_median", 2).alias("h_block_median"), r6("h_random_median", 2).alias("h_random_median"),
        "n", r6("floor").alias("floor"), r6("slack", 4).alias("slack"),
    )


@query
def operational_floor(spark, d):
    counts = current(spark, d).groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    n_ref = reference(spark, d).count()
    out = cal.operational_floor(counts, n_ref=n_ref, k_features=2, aa_ratio=0.93)
    return out.select("n_ref", "n_window", r6("floor").alias("floor"), r6("threshold").alias("threshold"))


def segment_calibrations(rows: DataFrame) -> DataFrame:
    """A calibration row per segment from its own row counts."""
    n = rows.groupBy("seg").agg(F.count(F.lit(1)).alias("n_reference"))
    floor = stats.analytic_floor(F.floor(F.col("n_reference") / 2), F.col("n_reference") - F.floor(F.col("n_reference") / 2), k_features=2)
    return n.withColumn("analytic_floor", floor).withColumn("suggested_threshold", F.col("analytic_floor") * 3).withColumn(
        "verdict", F.when(F.col("seg") == 3, cal.CONTAMINATED).otherwise(cal.HOMOGENEOUS)
    )


@query
def regime_comparison(spark, d):
    ev = events(spark, d)
    out = cal.compare_regimes(segment_calibrations(ev.where("event_type in ('error', 'signup')")), segment_calibrations(ev), ["seg"])
    return out.select("seg", "threshold_in_floors", "floor_ratio", r6("calibrated_for_n", 3).alias("calibrated_for_n"), "regime", "contaminated")


@query
def contract_violations(spark, d):
    n = events(spark, d).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("value") < 100).alias("ok"))
    contracts = n.select(
        "event_type",
        F.when(F.col("event_type") != "view", F.lit(0.02)).alias("threshold"),
        F.lit(0.05).alias("alpha"), F.lit(200).alias("min_obs"),
        (stats.analytic_floor("n", "n") * F.when(F.col("event_type") == "click", 10.0).otherwise(0.1)).alias("floor"),
        F.when(F.col("event_type") == "error", F.col("n")).otherwise(F.col("ok")).alias("suite_total"), F.col("ok").alias("suite_pass"),
    )
    return cal.contract_violations(contracts, "event_type")


@query
def edge_periods(spark, d):
    days = F.datediff(F.col("o_orderdate"), F.lit("1992-01-01").cast("date"))
    weeks = table(spark, d, "orders").select(F.floor(days / 7).cast("long").alias("week"))
    return kept_periods(weeks, "week").select("week", "n", "is_reference")


# --- performance -----------------------------------------------------------
@query
def roc_auc(spark, d):
    out = metrics.performance(planted(spark, d), ["seg"], window=WINDOW, threshold=0.5)
    return out.select("seg", "window", "n", "n_pos", "roc_auc", "estimable")


@query
def average_precision(spark, d):
    out = metrics.performance(scored(events(spark, d)), ["day"], threshold=0.5, digits=6)
    return out.select(long("day"), "n_pos", F.col("pr_auc").alias("average_precision"))


@query
def mcc(spark, d):
    out = metrics.performance(scored(events(spark, d)), ["day"], threshold=0.45)
    return out.select(long("day"), "mcc")


@query
def best_mcc_threshold(spark, d):
    out = metrics.performance(scored(events(spark, d)), ["seg"], digits=6)
    return out.select("seg", "mcc", "threshold")


@query
def log_loss(spark, d):
    rows = scored(events(spark, d)).withColumn("signal", metrics.log_loss_signal())
    return rows.groupBy("day").agg(r6(F.avg("signal")).alias("logloss")).select(long("day"), "logloss")


@query
def performance_by_window(spark, d):
    return metrics.performance(planted(spark, d), window=WINDOW)


@query
def extended_metrics(spark, d):
    return metrics.extended_metrics(scored(events(spark, d)), ["seg"])


@query
def threshold_drift(spark, d):
    out = metrics.threshold_drift(scored(events(spark, d)), "day")
    return out.select(long("day"), "mcc_fixed", "mcc_own", "own_threshold", "gain")


@query
def capability_index(spark, d):
    return table(spark, d, "lineitem").groupBy("l_linestatus").agg(r6(cpk("l_quantity", -20.0, 80.0)).alias("cpk"))


@query
def ppm(spark, d):
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(r6(ppm_out_of_spec("l_quantity", 3.0, 45.0), 3).alias("ppm"))


@query
def capability(spark, d):
    ev = plant.label_events(planted(spark, d), "day", EVENTS, "scenario").withColumn("scenario", F.coalesce("scenario", F.lit("baseline")))
    out = capability_table(ev, "value", -150.0, 250.0, ["scenario"])
    return out.select("scenario", "n", r6("mean").alias("mean"), r6("cpk").alias("cpk"), r6("ppm", 3).alias("ppm"), "conforming")


@query
def weekly_rates(spark, d):
    out = prepare.weekly_rates(meta(spark, d), "week", "Response", "n_stations")
    return out.select(long("week"), "n", r6("rate").alias("rate"), r6("mean_stations").alias("mean_stations"))


# --- model -----------------------------------------------------------------
MODEL_NUM, MODEL_CAT = ("l_quantity", "l_extendedprice", "l_discount", "l_tax"), ("l_returnflag",)


def labelled_lines(spark: SparkSession, d: str) -> DataFrame:
    base = table(spark, d, "lineitem")
    return base.withColumn(
        "late", F.when((F.col("l_quantity") * (1 - F.col("l_discount")) + F.col("l_linenumber") > 32) | (F.col("l_suppkey") % 9 == 0), 1).otherwise(0)
    )


@query
def logistic_scores(spark, d):
    from tidegauge.operators.model import train

    rows = labelled_lines(spark, d)
    model = train(rows.where("l_shipdate < '1999-01-01'"), num=MODEL_NUM, cat=MODEL_CAT, label="late")
    later = model.score(rows.where("l_shipdate >= '1999-01-01'"))
    return metrics.performance(later, ["l_returnflag"], label="late", score="p")


@query
def champion_challenger(spark, d):
    from tidegauge.operators import model as m

    rows = labelled_lines(spark, d)
    champion = m.train(rows.where("l_shipdate < '1997-01-01'"), num=("l_tax",), label="late")
    audit, _ = m.champion_challenger(
        rows.where("l_shipdate < '1999-01-01'"), rows.where("l_shipdate >= '1999-01-01'"),
        num=MODEL_NUM, cat=MODEL_CAT, label="late", champion=champion,
    )
    return audit


@query
def published_model(spark, d):
    """Six runs of the retraining job, then the late rows scored by the pointer."""
    from tidegauge.plans import retrain as job

    registry = scratch_path(spark, "registry")
    rows = labelled_lines(spark, d)
    early, mid = rows.where("l_shipdate < '1997-01-01'"), rows.where("l_shipdate >= '1997-01-01' and l_shipdate < '1999-01-01'")
    late = rows.where("l_shipdate >= '1999-01-01'")
    decided = materialise(decide(daily_evidence(spark, d), ["seg"], "day", GUARDS))
    # the monitor's history up to its last retraining, and up to the window before it
    said = decided.where("exit_code = 10").agg(F.max(F.struct("day", "seg")).alias("m")).select("m.*")
    one_monitor = decided.join(said.select("seg", F.col("day").alias("until")), "seg").where("day <= until")
    before = one_monitor.where("day < until and exit_code <> 10")
    how = dict(axis="day", cat=MODEL_CAT, label="late")
    job.retrain(early, mid, None, registry, num=("l_tax",), **how)  # nothing decided yet
    job.retrain(early, mid, before, registry, num=("l_tax",), **how)  # the last decision does not authorise it
    job.retrain(early, mid, one_monitor, registry, num=("l_tax",), **how)  # the first model
    job.retrain(mid, late.where("late = 0"), one_monitor, registry, num=MODEL_NUM, **how)  # no positives to judge by
    job.retrain(mid, late, one_monitor, registry, num=("l_discount",), **how)  # no better
    job.retrain(mid, late, before, registry, num=MODEL_NUM, forced=True, **how)  # better, and forced
    runs = job.attempts(spark, registry).groupBy("exit_code", "outcome", "forced", "champion_version", "version").agg(F.count(F.lit(1)).alias("n"))
    used = job.score_published(late, registry).groupBy("model_version").agg(F.count("p").alias("n"))
    scored_rows = used.select(F.lit(0).alias("exit_code"), F.lit("scored").alias("outcome"), F.lit(False).alias("forced"), F.lit(None).cast("bigint").alias("champion_version"), F.col("model_version").alias("version"), "n")
    return runs.unionByName(scored_rows).select(long("exit_code"), "outcome", "forced", "champion_version", "version", "n")


# --- guards ----------------------------------------------------------------
def daily_evidence(spark: SparkSession, d: str) -> DataFrame:
    """Evidence per segment and day from plain daily aggregates of the events."""
    g = events(spark, d).groupBy("seg", "day").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("value") > 120).alias("high"),
        F.count_if(F.col("event_type") == "error").alias("errors"),
        F.sum(F.col("event_id") % 97).alias("mix"),
    )
    return g.select(
        "seg",
        F.col("day").cast("bigint").alias("day"),
        F.when(F.col("mix") % 11 == 0, 5).otherwise(500).cast("bigint").alias("n_rows"),
        (F.col("mix") % 3).cast("bigint").alias("n_drift"),
        ((F.col("mix") % 29) / 100.0).alias("effect_max"),
        F.when(F.col("mix") % 17 == 1, F.lit("value")).alias("worst_feature"),
        F.when(F.col("mix") % 17 == 1, 0.5).when(F.col("mix") % 17 == 2, 0.05).alias("worst_fraction"),
        F.when(F.col("mix") % 7 != 0, 0.80).alias("auc_global"),
        (F.lit(0.50) + (F.col("mix") % 5) * 0.07).alias("auc_segment"),
        F.when(F.col("mix") % 2 == 0, ((F.col("mix") % 13) - 1) / 100.0).alias("gain"),
    )


@query
def cause(spark, d):
    return diagnose(daily_evidence(spark, d), "day", GUARDS).select("seg", "day", "cause")


@query
def persistence(spark, d):
    rows = diagnose(daily_evidence(spark, d), "day", GUARDS).where(F.col("n_rows") >= GUARDS.min_obs)
    out = remembered(rows, ["seg"], "day", GUARDS)
    return out.select("seg", "day", long("n_alarmed"), long("n_windows"), "persistent")


@query
def cause_confirmed(spark, d):
    rows = diagnose(daily_evidence(spark, d), "day", GUARDS).where(F.col("n_rows") >= GUARDS.min_obs)
    return remembered(rows, ["seg"], "day", GUARDS).select("seg", "day", "cause", "previous_cause", "cause_confirmed")


@query
def cooldown(spark, d):
    rows = daily_evidence(spark, d).where("n_drift = 2")
    out = cooled_down(rows.select("seg", "day"), ["seg"], "day", GUARDS.cooldown)
    return out.select("seg", long("day"), "retrains", long("previous_retrain"))


@query
def decisions(spark, d):
    out = decide(daily_evidence(spark, d), ["seg"], "day", GUARDS)
    return out.select("seg", "day", "action", long("exit_code"), "cause", "reason")


@query
def guard_results(spark, d):
    return guard_table(decide(daily_evidence(spark, d), ["seg"], "day", GUARDS), ["seg"], "day")


@query
def decision_next(spark, d):
    ev = daily_evidence(spark, d)
    history = decide(ev.where("day <= 20"), ["seg"], "day", GUARDS)
    out = decide_next(ev.where("day > 20"), history, ["seg"], "day", GUARDS)
    return out.select("seg", "day", "action", long("exit_code"), "cause", "reason")


@query
def decision_after_reset(spark, d):
    ev = daily_evidence(spark, d)
    resets = ev.where("day = 12 and seg < 2").select("seg", F.col("day").alias("reset_at"))
    out = decide(ev, ["seg"], "day", GUARDS, resets=resets)
    return out.select("seg", "day", long("exit_code"), "reason")


def effect_series(spark: SparkSession, d: str) -> DataFrame:
    g = events(spark, d).groupBy("user_id", "day").agg(F.sum(F.col("event_id") % 1009).alias("m"))
    slow = F.col("day") * 40 + F.col("m") % 60
    return g.select("user_id", F.col("day").cast("bigint").alias("day"), F.when(F.col("user_id") % 3 == 0, slow).otherwise(F.col("m") % 50).cast("double").alias("effect"))


@query
def wear_signal(spark, d):
    out = wear_trend(effect_series(spark, d), ["user_id"], "day", "effect", points=8)
    return out.select("user_id", "day", long("points"), r6("tau").alias("tau"), r6("max_rise").alias("max_rise"))


@query
def wear_guard(spark, d):
    out = wear_trend(effect_series(spark, d), ["user_id"], "day", "effect", points=8)
    return out.groupBy("user_id").agg(F.count_if("wear").alias("n_wear"), r6(F.min("p_value")).alias("lowest_p"))


@query
def monitor_backfill(spark, d):
    out = backfill(
        planted(spark, d), profile_of(spark, d), WINDOW, GUARDS, segment="seg", label="y", score="p",
    )
    return out.select("seg", "window", "action", long("exit_code"), "cause", "reason")


@query
def decide_one_window(spark, d):
    contract = Contract(
        version="1", origin="events", num=SPEC.num, cat=SPEC.cat, floor=GUARDS.floor, analytic_floor=None, block_floor=None, homogeneity=None,
        threshold=SPEC.threshold, alpha=SPEC.alpha, min_obs=SPEC.min_obs, bins=SPEC.bins, k=GUARDS.k, n=GUARDS.n, cooldown=GUARDS.cooldown,
        contexts=GUARDS.contexts, ranges=RANGES,
    )
    contract_path, history_path = scratch_path(spark, "contract"), scratch_path(spark, "history")
    io.save_contract(spark, contract, contract_path)
    rows, profile = planted(spark, d), profile_of(spark, d)
    names = dict(segment="seg", label="y", score="p")
    before = backfill(rows, profile, SlidingWindow("day", first=18, last=29, width=3, step=1), GUARDS, **names)
    io.append_decisions(before, history_path, ["seg"])
    decide_window(rows, profile, contract_path, history_path, axis="day", at=30, **names)
    out = io.read_history(spark, history_path)
    return out.select(long("seg"), "window", "action", long("exit_code"), "cause", "reason")


@query
def evidence_by_window(spark, d):
    out = window_evidence(planted(spark, d), profile_of(spark, d), WINDOW, segment="seg", label="y", score="p")
    return out.select(
        "seg", "window", "n_rows", "n_drift", r6("effect_max").alias("effect_max"), "worst_feature",
        r6("worst_fraction").alias("worst_fraction"), "auc_global", "auc_segment",
    )


# --- preparation -----------------------------------------------------------
@query
def topk_per_group(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "n_chars")
    out = prepare.top_per_group(docs, ["lang"], [F.col("n_chars").desc(), F.col("doc_id").asc()], 6)
    return out.select("lang", "doc_id", long("n_chars"))


@query
def feature_profile(spark, d):
    out = prepare.feature_profile(wide_lines(spark, d), list(WIDE))
    return out.select("feature", "n_valid", r6("coverage").alias("coverage"), r6("variance", 4).alias("variance"))


@query
def feature_selection(spark, d):
    profile = prepare.feature_profile(wide_lines(spark, d), list(WIDE))
    out = prepare.select_features(profile, target=5, per_station=1)
    return out.select("feature", "station", "quota")


@query
def selected_columns(spark, d):
    df = wide_lines(spark, d).withColumn("Id", F.lit(1)).withColumn("Response", F.lit(0))
    out = prepare.load_selected(df, "Id", ["L0_S0_F0", "L0_S1_F4"], "Response")
    return out.agg(F.count(F.lit(1)).alias("n"), r6(F.sum(F.col("L0_S0_F0").cast("double")), 2).alias("quantity"))


@query
def time_axis(spark, d):
    m = meta(spark, d)
    return m.select(
        "Id", r6(F.col("t_min").cast("double")).alias("t_min"), r6(F.col("t_max").cast("double")).alias("t_max"), long("n_stations"),
        r6(F.col("duration").cast("double")).alias("duration"), long("week"), long("fortnight"), long("Response"),
    )


# --- files -----------------------------------------------------------------
@query
def metadata_round_trip(spark, d):
    path = scratch_path(spark, "meta.parquet")
    io.write_parquet(meta(spark, d), path, order=["t_min", "Id"])
    back = io.read_meta(spark, path, columns=["week", "n_stations", "t_max"])
    return back.groupBy(long("week")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_stations").alias("stations"), r6(F.max("t_max").cast("double")).alias("latest")
    )


@query
def features_round_trip(spark, d):
    path = scratch_path(spark, "features.parquet")
    io.write_parquet(table(spark, d, "orders"), path, order=["o_orderkey"])
    back = io.read_features(spark, path, columns=["o_orderstatus", "o_totalprice"], where="o_totalprice > 100000")
    return back.groupBy(F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("n"), r6(F.sum("o_totalprice"), 2).alias("price"))


@query
def wide_csv_round_trip(spark, d):
    path = scratch_path(spark, "wide.csv")
    io.write_results(part_dates(spark, d), path)
    back = io.read_wide_csv(spark, path)
    long_rows = back.unpivot(["Id"], list(DATES), "feature", "t")
    return long_rows.groupBy("feature").agg(F.count("t").alias("n"), r6(F.sum(F.col("t").cast("double")), 2).alias("total"))


@query
def results_round_trip(spark, d):
    counts = events(spark, d).groupBy(F.col("day").cast("bigint").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    out = []
    for fmt in ("csv", "json"):
        path = scratch_path(spark, f"results.{fmt}")
        io.write_results(counts, path, fmt)
        reader = spark.read.option("header", True) if fmt == "csv" else spark.read
        back = reader.schema("day bigint, n bigint").format(fmt).load(path)
        out.append(back.select(F.lit(fmt).alias("format"), "day", "n"))
    return out[0].unionByName(out[1])


@query
def contract_round_trip(spark, d):
    n = reference(spark, d).count()
    floor = stats.floor_quantile(10, 2) * (1.0 / (n // 2) + 1.0 / (n - n // 2))
    contract = Contract(
        version="1", origin="events", num=NUMERIC.num, cat=(), floor=None, analytic_floor=floor, block_floor=None, homogeneity=None,
        threshold=3 * floor, alpha=SPEC.alpha, min_obs=SPEC.min_obs,
    )
    path = scratch_path(spark, "contract")
    io.save_contract(spark, contract, path)
    back = io.load_contract(spark, path)
    spec, guards = back.monitor_spec(), back.guard_config()
    rows = [(f, round(guards.floor, 9), round(spec.threshold, 9), spec.bins, guards.k, guards.n) for f in spec.num]
    return metadata_table(spark, rows, "feature string, floor double, threshold double, bins bigint, k bigint, n bigint")


@query
def undated_last(spark, d):
    """All undated rows, with their places behind all others."""
    out = prepare.numbered_in_time_order(meta(spark, d).select("Id", "t_min")).where("t_min IS NULL")
    return out.select(long("place"), "Id", r6(F.col("t_min").cast("double")).alias("t_min"))


@query
def time_order_places(spark, d):
    out = prepare.numbered_in_time_order(meta(spark, d).select("Id", "t_min"))
    return out.select(long("place"), "Id", r6(F.col("t_min").cast("double")).alias("t_min"))


@query
def artefact_checks(spark, d):
    m = meta(spark, d)
    feats = table(spark, d, "orders").select(F.col("o_orderkey").alias("Id"))
    out = checks.artefact_checks(m, feats, min_stations=5, min_weeks=15, position="Id")
    return out.select("check", "ok", r6("observed").alias("observed"))


@query
def expectations(spark, d):
    ev = planted(spark, d)
    day, seg2 = F.col("day"), F.col("seg") == 2
    faulty = seg2 & day.between(22, 25)
    gap = F.col("real_value") - F.col("value")
    out = checks.expectations(
        ev,
        [
            checks.Expectation("reference prevalence", F.avg(F.when(day <= 15, F.col("y"))), 0.05, 0.45),
            checks.Expectation("campaign mix", F.avg(F.when(day.between(19, 21), F.when(F.col("event_type") == "view", 1.0).otherwise(0.0))), 0.6, None, strict=False),
            checks.Expectation("sensor reads low", F.avg(F.when(faulty, gap)), 2.65, 4.35),
            checks.Expectation("other segments untouched", F.max(F.when(~seg2 & day.between(22, 25), F.abs(gap))), None, 0.01),
            checks.Expectation("unit change leaves range", F.avg(F.when(day >= 28, F.when(F.col("value") > 200, 1.0).otherwise(0.0))), 0.95, None),
            checks.Expectation("apparent shift small", F.abs(F.avg(F.when(faulty, F.col("value"))) - F.avg(F.when(day <= 15, F.col("value")))), None, 10.0),
        ],
    )
    return out.select("check", "ok", r6("observed").alias("observed"))


# --- planting --------------------------------------------------------------
@query
def planted_drift(spark, d):
    g = planted(spark, d).groupBy("day", "seg").agg(
        F.count(F.lit(1)).alias("n"), r6(F.sum("value"), 3).alias("value"), r6(F.sum("real_value"), 3).alias("real_value"),
        F.count_if(F.col("event_type") == "view").alias("views"),
    )
    return g.select(long("day"), "seg", "n", "value", "real_value", "views")


@query
def event_rows(spark, d):
    rows = plant.label_events(events(spark, d), "day", EVENTS)
    return rows.groupBy("event").agg(F.count(F.lit(1)).alias("n"))


@query
def detection_score(spark, d):
    out = decide(daily_evidence(spark, d), ["seg"], "day", GUARDS)
    return plant.detection_score(out, "day", event_catalogue(spark))


# --- streaming -------------------------------------------------------------
def event_stream(spark: SparkSession, d: str) -> DataFrame:
    schema = table(spark, d, "events").schema
    raw = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    return raw.withColumn("k", F.get_json_object("props", "$.k"))


@query
def stream_window_monitor(spark, d):
    from tidegauge.streaming import window_monitor as wm

    p = profile_of(spark, d)
    counts = wm.unit_count_stream(event_stream(spark, d), p, "ts", origin_day=ORIGIN_DAY)
    sink = scratch_path(spark, "unit_counts")
    wm.run_available(counts, sink, sink + "_checkpoint")
    # the input is finished, so the units after the watermark are complete as well
    closed = read_window_dir(spark, sink).unionByName(wm.open_units(spark, sink + "_checkpoint", origin_day=ORIGIN_DAY))
    out = wm.report_from_counts(closed, p, WINDOW)
    return out.select("window", "feature", "kind", "n_cur", r6("effect").alias("effect"), "measurable", "over")


def read_window_dir(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("day bigint, feature string, slot string, n bigint").parquet(path)


@query
def stream_guards(spark, d):
    from tidegauge.streaming import guards as g

    evidence = daily_evidence(spark, d)
    source, sink = scratch_path(spark, "evidence"), scratch_path(spark, "guard_decisions")
    # a monitor's windows arrive in order, a few days per micro-batch
    for first in range(1, 31, 10):
        evidence.where(F.col("day").between(first, first + 9)).coalesce(1).write.mode("append").parquet(source)
    with g.state_store(spark, partitions=8):
        stream = spark.readStream.schema(evidence.schema).option("maxFilesPerTrigger", 1).parquet(source)
        q = (
            g.guard_stream(stream, ["seg"], "day", GUARDS).writeStream.outputMode("append").format("parquet")
            .option("path", sink).option("checkpointLocation", sink + "_checkpoint").trigger(availableNow=True).start()
        )
        q.awaitTermination()
    out = spark.read.schema("seg bigint, day bigint, exit_code int, cause string, reason string").parquet(sink)
    return out.select("seg", "day", long("exit_code"), "cause", "reason")


STREAM_COLUMNS = ["ts", "value", "k", "event_type", "seg", "y", "p"]


def decided_stream(spark: SparkSession, d: str, rows: DataFrame, arrival: Column, **how) -> DataFrame:
    """Rows sent in order of ``arrival``, a file a micro-batch, then a tick far behind the last window."""
    from tidegauge.streaming import decisions as ds
    from tidegauge.streaming.guards import state_store

    source, sink = scratch_path(spark, "sent"), scratch_path(spark, "decisions")
    for n in range(3):
        rows.where(arrival == n).select(*STREAM_COLUMNS).coalesce(1).write.mode("append").parquet(source)
    tick = F.date_add(F.lit(ORIGIN).cast("date"), WINDOW.last + 5).cast("timestamp")
    kinds = {f.name: f.dataType for f in rows.schema}
    first = rows.limit(1).select(*[tick.cast(kinds[c]).alias(c) if c == "ts" else F.lit(None).cast(kinds[c]).alias(c) for c in STREAM_COLUMNS])
    first.coalesce(1).write.mode("append").parquet(source)
    profile = profile_of(spark, d)
    with state_store(spark, partitions=4):
        stream = spark.readStream.schema(rows.select(*STREAM_COLUMNS).schema).option("maxFilesPerTrigger", 1).parquet(source)
        decided = ds.decision_stream(stream, profile, WINDOW, GUARDS, time="ts", origin_day=ORIGIN_DAY, segment="seg", label="y", score="p", buckets=4, **how)
        q = (
            decided.writeStream.outputMode("append").format("parquet").option("path", sink)
            .option("checkpointLocation", sink + "_checkpoint").trigger(availableNow=True).start()
        )
        q.awaitTermination()
    return spark.read.schema(ds.DECISIONS).parquet(sink)


@query
def stream_decisions(spark, d):
    rows = planted(spark, d).where(F.col("day") > REFERENCE_DAYS)
    out = decided_stream(spark, d, rows, F.floor((F.col("day") - 16) / 5), monitors=rows.select(F.col("seg").alias("segment")).distinct())
    return out.where("n_late IS NULL").select(F.col("segment").cast("bigint").alias("seg"), "window", "n_rows", long("exit_code"), "cause", "reason")


@query
def stream_late_windows(spark, d):
    """Segment 1 sends nothing on days 20 to 23, some rows of day 18 come too late, monitor 9 never sends."""
    sent = planted(spark, d).where((F.col("day") > REFERENCE_DAYS) & ~((F.col("seg") == 1) & F.col("day").between(20, 23)))
    late = (F.col("day") == 18) & (F.col("event_id") % 7 == 3)
    named = sent.select(F.col("seg").alias("segment")).distinct()
    monitors = named.unionByName(named.limit(1).select(F.lit(9).cast("bigint").alias("segment")))
    out = decided_stream(
        spark, d, sent, F.when(late, 2).otherwise(F.floor((F.col("day") - 16) / 5)), monitors=monitors, per_segment=True
    )
    return out.select(F.col("segment").cast("bigint").alias("seg"), "window", "n_rows", long("exit_code"), "cause", "reason", "n_late")


def collapsing(spark: SparkSession, d: str) -> DataFrame:
    """Events with a sure score on the right side of 0.5, until day 20: then segment 2's
    scores keep their side and lose their confidence, and segment 1's turn wrong."""
    hour = F.col("day") * 24 + F.hour("ts")
    rows = events(spark, d).withColumn("hour", hour).withColumn("y", F.when(F.col("event_type") == "error", 1).otherwise(0))
    sure = (F.lit(0.30) + (F.col("event_id") * 7919) % 1000 / 1000.0 * 0.15) * F.when((F.col("day") >= 20) & (F.col("seg") == 2), 0.1).otherwise(1.0)
    side = F.when(F.col("y") == 1, 1).otherwise(-1) * F.when((F.col("day") >= 20) & (F.col("seg") == 1), -1).otherwise(1)
    return rows.withColumn("p", F.lit(0.5) + side * sure)


def sequential_signals() -> dict[str, tuple[Column, float]]:
    """The two signals of a scored row with their ranges: a wrong label, and how wrong its score was."""
    wrong = F.when(F.col("p").isNotNull() & F.col("y").isNotNull(), ((F.col("p") >= 0.5) != (F.col("y") == 1)).cast("double"))
    return {"error": (wrong, 1.0), "logloss": (metrics.log_loss_signal(), -math.log(metrics.CLIP))}


@query
def adwin(spark, d):
    from tidegauge.streaming.adwin import signal_changes

    return signal_changes(collapsing(spark, d), ["seg"], "hour", sequential_signals())


@query
def stream_adwin(spark, d):
    """The same change points from a stream, a file of ten days a micro-batch."""
    from tidegauge.streaming.adwin import change_stream
    from tidegauge.streaming.guards import state_store

    rows = collapsing(spark, d)
    columns = ["ts", "seg", "y", "p"]
    source, sink = scratch_path(spark, "sent"), scratch_path(spark, "changes")
    for first in range(1, 31, 10):
        rows.where(F.col("day").between(first, first + 9)).select(*columns).coalesce(1).write.mode("append").parquet(source)
    kinds = {f.name: f.dataType for f in rows.schema}
    last = F.date_add(F.lit(ORIGIN).cast("date"), 40).cast("timestamp").cast(kinds["ts"]).alias("ts")
    rows.limit(1).select(last, *[F.lit(None).cast(kinds[c]).alias(c) for c in columns[1:]]).coalesce(1).write.mode("append").parquet(source)
    with state_store(spark, partitions=4):
        stream = spark.readStream.schema(rows.select(*columns).schema).option("maxFilesPerTrigger", 1).parquet(source)
        changes = change_stream(stream, ["seg"], "ts", sequential_signals(), origin_hour=ORIGIN_DAY * 24)
        q = (
            changes.writeStream.outputMode("append").format("parquet").option("path", sink)
            .option("checkpointLocation", sink + "_checkpoint").trigger(availableNow=True).start()
        )
        q.awaitTermination()
    return spark.read.schema("seg bigint, signal string, hour bigint").parquet(sink)
