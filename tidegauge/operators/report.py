"""Drift reports over any number of windows and segments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions import stats
from tidegauge.operators.cumulative import ROWS_PER_BUCKET
from tidegauge.operators.distance import (
    categorical_statistics,
    numeric_statistics,
    wasserstein_statistics,
)
from tidegauge.operators.joins import keyed_join, known_groups
from tidegauge.operators.profile import ReferenceProfile
from tidegauge.operators.windows import assign_windows, narrow_axis
from tidegauge.types import CATEGORY_SCALE, MIN_VALUES, SlidingWindow

GROUP = "__group"


def drift_report(
    cur: DataFrame,
    profile: ReferenceProfile,
    by: Sequence[str] = (),
    window: SlidingWindow | None = None,
    *,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """One row per group (window, segment) and monitored feature."""
    spec, spark = profile.spec, cur.sparkSession
    if window:
        cur = narrow_axis(cur, window)
    by = list(by)
    single = not by and not window
    if single:
        cur, by = cur.withColumn(GROUP, F.lit(0)), [GROUP]
    out_by = [*by, *(["window"] if window else [])]
    cur = known_groups(cur, by)
    used = {*by, *spec.num, *spec.cat, *([window.axis] if window else [])}
    cur = cur.select(*[c for c in cur.columns if c in used])

    units = [window.axis] if window else []
    sizes = cur.groupBy(*by, *units).agg(F.count(F.lit(1)).alias("n_cur"))
    if window:
        sizes = assign_windows(sizes, window).groupBy(*out_by).agg(F.sum("n_cur").alias("n_cur"))
    features = profile.feature_table(spark)
    # every group reports every feature, measured or not
    names = F.array(*[F.lit(f) for f in (*spec.num, *spec.cat)])
    frame = sizes.select(*out_by, "n_cur", F.explode(names).alias("feature")).join(
        F.broadcast(features), "feature"
    )

    parts = []
    if spec.num:
        stat = numeric_statistics(cur, profile, by, window, rows_per_bucket=rows_per_bucket)
        effect = F.col("psi")
        if spec.metric == "wasserstein":
            stat = keyed_join(
                stat, wasserstein_statistics(cur, profile, by, window, rows_per_bucket=rows_per_bucket),
                [*out_by, "feature"], "left",
            )
            effect = F.col("wasserstein")
        parts.append(
            keyed_join(frame.where("kind = 'num'"), stat, [*out_by, "feature"], "left")
            .withColumn("stat", F.col("ks"))
            .withColumn("p_value", stats.ks_pvalue("ks", "n_ref_valid", "n_cur_valid"))
            .withColumn("effect", effect)
        )
    if spec.cat:
        stat = categorical_statistics(cur, profile, by, window)
        parts.append(
            keyed_join(frame.where("kind = 'cat'"), stat, [*out_by, "feature"], "left")
            .withColumn("stat", F.col("chi2"))
            .withColumn("p_value", stats.chi2_pvalue(F.col("chi2"), F.col("dof")))
            .withColumn("effect", F.col("js") * CATEGORY_SCALE)
        )
    columns = [*out_by, "feature", "kind", "n_cur", "n_ref_valid", "n_cur_valid", "stat", "p_value", "effect"]
    rows = parts[0].select(*columns)
    for p in parts[1:]:
        rows = rows.unionByName(p.select(*columns))

    gate = F.coalesce(
        (F.col("n_cur") >= spec.min_obs)
        & (F.col("n_ref_valid") >= MIN_VALUES)
        & (F.col("n_cur_valid") >= MIN_VALUES),
        F.lit(False),
    )
    out = rows.select(
        *out_by,
        "feature",
        "kind",
        F.when(gate, F.col("stat")).alias("stat"),
        F.when(gate, F.col("p_value")).alias("p_value"),
        F.when(gate, F.col("effect")).alias("effect"),
        (gate & F.col("effect").isNotNull()).alias("measurable"),
        F.lit(profile.n_rows).cast("long").alias("n_ref"),
        "n_cur",
    )
    out = out.withColumn(
        "drift",
        F.col("measurable") & stats.alarm("p_value", "effect", spec.alpha_corrected, spec.threshold),
    )
    return out.drop(GROUP) if single else out


def summarise(report: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per group: counts, largest measurable effect, drifted features by effect."""
    drifted = F.collect_list(
        F.when(F.col("drift"), F.struct((-F.col("effect")).alias("e"), F.col("feature").alias("f")))
    )
    return report.groupBy(*by).agg(
        F.max("n_ref").alias("n_ref"),
        F.max("n_cur").alias("n_cur"),
        F.count_if("drift").alias("n_drift"),
        F.count_if(~F.col("measurable")).alias("n_not_measurable"),
        F.max(F.when(F.col("measurable"), F.col("effect"))).alias("effect_max"),
        F.transform(F.array_sort(drifted), lambda x: x.f).alias("features"),
    )
