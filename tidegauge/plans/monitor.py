"""End-to-end jobs: measure, backfill, decide one window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.operators.metrics import performance
from tidegauge.operators.policy import decide, seeded_decide, with_all_evidence
from tidegauge.operators.profile import ReferenceProfile
from tidegauge.operators.ranges import range_violations, worst_violation
from tidegauge.operators.report import drift_report, summarise
from tidegauge.operators.windows import narrow_axis
from tidegauge.session import materialise
from tidegauge.sources.io import append_decisions, load_contract, read_history
from tidegauge.types import RETRAIN, GuardConfig, SlidingWindow

MIN_SEGMENT_ROWS = 50


def measure(cur: DataFrame, profile: ReferenceProfile, window: SlidingWindow) -> tuple[DataFrame, DataFrame]:
    """Report and summary of every window; nothing is decided."""
    report = drift_report(cur, profile, window=window)
    return report, summarise(report, ["window"])


def window_evidence(
    cur: DataFrame,
    profile: ReferenceProfile,
    window: SlidingWindow,
    *,
    segment: str | None = None,
    label: str | None = None,
    score: str | None = None,
) -> DataFrame:
    """Evidence rows of every window (and segment): drift, violations, AUCs."""
    _, summary = measure(cur, profile, window)
    rows = summary.select(
        "window", F.col("n_cur").alias("n_rows"), "n_drift", "effect_max", "features"
    )
    if profile.spec.ranges:
        worst = worst_violation(range_violations(narrow_axis(cur, window), profile.spec.ranges, window=window), ["window"])
        rows = rows.join(worst, "window", "left")
    if label and score:
        overall = performance(cur, label=label, score=score, window=window)
        rows = rows.join(overall.select("window", F.col("roc_auc").alias("auc_global")), "window", "left")
        if segment:
            local = performance(cur, [segment], label=label, score=score, window=window)
            auc = F.when(F.col("n") > MIN_SEGMENT_ROWS, F.col("roc_auc"))
            rows = rows.join(local.select(segment, "window", auc.alias("auc_segment")), "window", "left")
    return with_all_evidence(rows)


def backfill(
    cur: DataFrame,
    profile: ReferenceProfile,
    window: SlidingWindow,
    config: GuardConfig,
    *,
    segment: str | None = None,
    label: str | None = None,
    score: str | None = None,
    event: Column | None = None,
) -> DataFrame:
    """Every window of every segment decided in one job, in window order.

    ``event`` labels each window with the planted or known event it ends in.
    """
    evidence = window_evidence(cur, profile, window, segment=segment, label=label, score=score)
    keys = [segment] if segment and label and score else []
    if not keys:
        evidence, keys = evidence.withColumn("monitor", F.lit("all")), ["monitor"]
    # windows x segments rows; the cascade reads them several times
    decisions = decide(materialise(evidence), keys, "window", config)
    return decisions.withColumn("event", event) if event is not None else decisions


def decide_next(
    evidence: DataFrame, history: DataFrame | None, keys: Sequence[str], axis: str, config: GuardConfig
) -> DataFrame:
    """Decide new windows with the memory of earlier decisions.

    Alarms, causes and the last retraining are all restored; INSUFFICIENT rows leave
    no trace. Past windows re-enter as evidence, so the cascade itself is one plan;
    only rows that are not in the history yet are returned.
    """
    if history is None:
        return decide(evidence, keys, axis, config)
    past = history.where(F.col("evidence").isNotNull())
    memory = past.select(
        *keys, F.col(axis),
        F.lit(config.min_obs).cast("bigint").alias("n_rows"),
        F.col("evidence.n_drift").alias("n_drift"),
        F.col("cause").alias("__cause"),
        (F.col("exit_code") == RETRAIN).alias("__retrained"),
    )
    last = memory.where("__retrained").groupBy(*keys).agg(F.max(axis).cast("bigint").alias("__last"))
    fresh = with_all_evidence(evidence).join(history.select(*keys, axis), [*keys, axis], "left_anti")
    return seeded_decide(fresh, memory, last, keys, axis, config)


def decide_window(
    current: DataFrame,
    profile: ReferenceProfile,
    contract_path: str,
    history_path: str,
    *,
    axis: str,
    at: int,
    width: int = 3,
    segment: str | None = None,
    label: str | None = None,
    score: str | None = None,
) -> DataFrame:
    """One window, from the contract to the recorded decision.

    Loads the contract, measures the window that ends at ``at``, restores the memory
    from the history (if there is one), decides, and appends the new decisions. Their
    ``exit_code`` is what a scheduler acts on. Running the job again appends nothing:
    windows that the history holds are not decided twice.
    """
    spark = current.sparkSession
    contract = load_contract(spark, contract_path)
    if contract.monitor_spec() != profile.spec:
        raise ValueError("the profile was built for another contract")
    keys = [segment] if segment and label and score else ["monitor"]
    window = SlidingWindow(axis, first=at, last=at, width=width)
    evidence = window_evidence(current, profile, window, segment=segment, label=label, score=score)
    if keys == ["monitor"]:
        evidence = evidence.withColumn("monitor", F.lit("all"))
    evidence = materialise(evidence)
    try:
        history = read_history(spark, history_path)
    except AnalysisException:
        history = None
    if history is not None:  # keys come back from folder names
        history = history.withColumns({k: F.col(k).cast(evidence.schema[k].dataType) for k in keys})
    decided = materialise(decide_next(evidence, history, keys, "window", contract.guard_config()))
    append_decisions(decided, history_path, keys)
    return decided
