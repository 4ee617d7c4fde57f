"""Cause diagnosis and the guard cascade over a table of window evidence.

Evidence columns: the monitor keys, an axis, ``n_rows``, ``n_drift``,
``effect_max``, ``worst_feature``/``worst_fraction`` (range violations),
``auc_global``, ``auc_segment``, ``gain`` (all nullable but the counts).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.operators.windows import context_expression
from tidegauge.types import (
    ACTION_NAMES,
    BLOCK,
    BLOCKING_CAUSES,
    CAUSE_BUSINESS,
    CAUSE_HARDWARE,
    CAUSE_MODEL,
    CAUSE_NONE,
    CAUSE_PIPELINE,
    CAUSE_UNDEFINED,
    INSUFFICIENT,
    NOTHING,
    RETRAIN,
    GuardConfig,
)

# fixed values: signatures of the causes
SEVERE_FRACTION = 0.10
CALM_FACTOR = 10.0
CALM_FEATURES = 1
LIFT_RATIO = 0.35
SEGMENT_AUC = 0.55
PRESERVED_GAP = 0.05

# What a passed guard says, for reports.
GUARD_LABELS = {
    "lasting": "alarms in enough of the latest windows",
    "cause_repeated": "the same cause found several times running",
    "outside_context": "not inside an announced phase of operation",
    "above_noise": "effect clears what noise alone can reach",
    "challenger_gains": "a retrained model does better on later rows",
    "trainable_cause": "a cause that training can remove",
}

EVIDENCE_COLUMNS = {
    "effect_max": "double", "worst_feature": "string", "worst_fraction": "double",
    "auc_global": "double", "auc_segment": "double", "gain": "double",
}


def with_all_evidence(evidence: DataFrame) -> DataFrame:
    """Add the optional evidence columns that are missing, as NULL."""
    for name, kind in EVIDENCE_COLUMNS.items():
        if name not in evidence.columns:
            evidence = evidence.withColumn(name, F.lit(None).cast(kind))
    return evidence


def calm(config: GuardConfig) -> Column:
    """Input distributions quiet enough for a localised fault to be instrumental."""
    e = F.col("effect_max")
    small = e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")) | (e < CALM_FACTOR * config.threshold)
    return (F.col("n_drift") <= CALM_FEATURES) & small


def lift_ratio() -> Column:
    """Discrimination left in the segment relative to the whole window."""
    return F.greatest(F.col("auc_segment") - 0.5, F.lit(0.0)) / F.greatest(F.col("auc_global") - 0.5, F.lit(1e-6))


def cause(axis: str, config: GuardConfig) -> Column:
    """The first signature that holds, cheapest and most conclusive first."""
    both = F.col("auc_global").isNotNull() & F.col("auc_segment").isNotNull()
    context = context_expression(axis, config.contexts)
    drifted = F.col("n_drift") > 0
    return (
        F.when(F.col("worst_fraction") > SEVERE_FRACTION, CAUSE_PIPELINE)
        .when(context.isNotNull(), CAUSE_BUSINESS)
        .when(both & (lift_ratio() < LIFT_RATIO) & (F.col("auc_segment") < SEGMENT_AUC) & calm(config), CAUSE_HARDWARE)
        .when(drifted & both & (F.col("auc_global") - F.col("auc_segment") < PRESERVED_GAP), CAUSE_BUSINESS)
        .when(drifted, CAUSE_MODEL)
        .otherwise(CAUSE_NONE)
    )


def cause_evidence(axis: str, config: GuardConfig) -> Column:
    """One line saying what the diagnosis rests on."""
    context = context_expression(axis, config.contexts)
    drifted = F.col("n_drift").cast("string")
    return (
        F.when(
            F.col("cause") == CAUSE_PIPELINE,
            F.format_string("%.0f%% of `%s` outside its engineering range", F.col("worst_fraction") * 100, F.col("worst_feature")),
        )
        .when((F.col("cause") == CAUSE_BUSINESS) & context.isNotNull(), F.concat(F.lit("inside planned context "), context))
        .when(
            F.col("cause") == CAUSE_HARDWARE,
            F.format_string(
                "segment AUC %.3f against %.3f overall, input distributions calm", F.col("auc_segment"), F.col("auc_global")
            ),
        )
        .when(F.col("cause") == CAUSE_BUSINESS, F.concat(drifted, F.lit(" drifted feature(s), performance preserved")))
        .when(F.col("cause") == CAUSE_MODEL, F.concat(drifted, F.lit(" drifted feature(s), no physical signature")))
        .otherwise("no actionable drift")
    )


def diagnose(evidence: DataFrame, axis: str, config: GuardConfig) -> DataFrame:
    out = with_all_evidence(evidence)
    return out.withColumn("cause", cause(axis, config)).withColumn("cause_evidence", cause_evidence(axis, config))


def remembered(measured: DataFrame, keys: Sequence[str], axis: str, config: GuardConfig) -> DataFrame:
    """Alarm memory and cause memory over the measurable windows of each monitor."""
    order = Window.partitionBy(*keys).orderBy(axis)
    last_n = order.rowsBetween(-(config.n - 1), 0)
    last_causes = order.rowsBetween(-(config.cause_confirmations - 1), 0)
    alarm = F.col("n_drift") > 0
    return (
        measured.withColumn("alarmed", alarm)
        .withColumn("n_alarmed", F.sum(F.when(alarm, 1).otherwise(0)).over(last_n))
        .withColumn("n_windows", F.count(F.lit(1)).over(last_n))
        .withColumn("persistent", F.col("n_alarmed") >= config.k)
        .withColumn(
            "cause_confirmed",
            F.sum(F.when(F.col("cause") == CAUSE_MODEL, 1).otherwise(0)).over(last_causes) >= config.cause_confirmations,
        )
        .withColumn("previous_cause", F.lag("cause").over(order))
    )


def cooled_down(candidates: DataFrame, keys: Sequence[str], axis: str, cooldown: int, last_retrain: str | None = None) -> DataFrame:
    """``keys, axis, retrains, previous_retrain`` for each window that passed all other guards.

    Whether a candidate retrains depends on the retraining before it, so the
    candidates of one monitor (at most one per window) are folded in order.
    ``last_retrain`` names a column holding an earlier retraining, if any.
    """
    start = F.max(last_retrain).cast("bigint") if last_retrain else F.lit(None).cast("bigint")
    grouped = candidates.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.col(axis).cast("bigint"))).alias("axes"), start.alias("start")
    )
    folded = grouped.select(
        *keys,
        F.expr(
            f"""aggregate(axes,
                 named_struct('last', start, 'done', cast(array() as array<struct<a:bigint,retrains:boolean,previous:bigint>>)),
                 (acc, a) -> CASE WHEN acc.last IS NULL OR a - acc.last >= {cooldown}
                   THEN named_struct('last', a, 'done', concat(acc.done, array(named_struct('a', a, 'retrains', true, 'previous', acc.last))))
                   ELSE named_struct('last', acc.last, 'done', concat(acc.done, array(named_struct('a', a, 'retrains', false, 'previous', acc.last)))) END,
                 acc -> acc.done)"""
        ).alias("steps"),
    )
    return folded.select(*keys, F.explode("steps").alias("s")).select(
        *keys, F.col("s.a").alias(axis), F.col("s.retrains").alias("retrains"), F.col("s.previous").alias("previous_retrain")
    )


def decide(
    evidence: DataFrame,
    keys: Sequence[str],
    axis: str,
    config: GuardConfig,
    *,
    resets: DataFrame | None = None,
    last_retrain: str | None = None,
) -> DataFrame:
    """One decision per window: 0 -> 5 -> no alarm -> 1 -> 3 -> 2 -> 1b -> 4 -> 2b -> retrain.

    Windows below ``min_obs`` rows are INSUFFICIENT and leave no memory. ``resets``
    (``keys, reset_at``) clears a monitor's memory from that axis value on.
    ``guards`` holds only the guards that were reached.
    """
    return _cascade(diagnose(evidence, axis, config), keys, axis, config, resets=resets, last_retrain=last_retrain)


def seeded_decide(
    fresh: DataFrame, memory: DataFrame, last: DataFrame, keys: Sequence[str], axis: str, config: GuardConfig
) -> DataFrame:
    """Decide ``fresh`` rows after the remembered windows in ``memory``.

    ``memory``: ``keys, axis, n_rows, n_drift, __cause``; ``last``: ``keys, __last``.
    """
    new = diagnose(fresh, axis, config).withColumn("__old", F.lit(False))
    old = with_all_evidence(memory.drop("__retrained").withColumnRenamed("__cause", "cause")).withColumn("__old", F.lit(True))
    rows = new.unionByName(old, allowMissingColumns=True).join(last, list(keys), "left")
    decided = _cascade(rows, keys, axis, config, last_retrain="__last", replayed="__old")
    return decided


def _cascade(
    rows: DataFrame,
    keys: Sequence[str],
    axis: str,
    config: GuardConfig,
    *,
    resets: DataFrame | None = None,
    last_retrain: str | None = None,
    replayed: str | None = None,
) -> DataFrame:
    keys = list(keys)
    memory_keys = list(keys)
    if resets is not None:
        marks = resets.groupBy(*keys).agg(F.collect_set("reset_at").alias("__resets"))
        rows = rows.join(marks, keys, "left").withColumn(
            "__epoch", F.coalesce(F.size(F.filter("__resets", lambda r: r <= F.col(axis))), F.lit(0))
        ).drop("__resets")
        memory_keys = [*keys, "__epoch"]
    enough = F.col("n_rows") >= config.min_obs
    measured = remembered(rows.where(enough), memory_keys, axis, config)
    if replayed:
        measured = measured.where(~F.col(replayed))
        rows = rows.where(~F.col(replayed))

    effective = config.floor_factor * config.floor
    e = F.col("effect_max")
    measured = (
        measured.withColumn("above_floor", F.coalesce(~F.isnan(e) & (F.abs(e) < float("inf")) & (e > effective), F.lit(False)))
        .withColumn("context_ok", F.col("cause") != CAUSE_BUSINESS)
        .withColumn("cause_is_ml", ~F.col("cause").isin(*BLOCKING_CAUSES))
        .withColumn("shadow_ok", F.coalesce(F.col("gain") >= config.min_gain, F.lit(True)))
        .withColumn(
            "stage",
            F.when(~F.col("cause_is_ml"), "blocked")
            .when(~F.col("alarmed"), "no alarm")
            .when(~F.col("persistent"), "not persistent")
            .when(~F.col("above_floor"), "below floor")
            .when(~F.col("context_ok"), "known context")
            .when((F.col("cause") == CAUSE_MODEL) & ~F.col("cause_confirmed"), "cause unconfirmed")
            .when(~F.col("shadow_ok"), "shadow failed")
            .otherwise("candidate"),
        )
    )
    folded = cooled_down(measured.where("stage = 'candidate'"), memory_keys, axis, config.cooldown, last_retrain)
    measured = measured.join(
        folded.withColumnRenamed(axis, "__axis"),
        [measured[k] == folded[k] for k in memory_keys] + [F.col(axis).cast("bigint") == F.col("__axis")],
        "left",
    ).select(measured["*"], "retrains", "previous_retrain")
    stage = F.when(F.col("stage") != "candidate", F.col("stage")).when(F.col("retrains"), "authorised").otherwise("cooldown")

    def reached(name: str, value: Column, condition: Column) -> Column:
        return F.when(condition, F.struct(F.lit(name).alias("key"), value.alias("value")))

    late = F.col("stage").isin("cause unconfirmed", "shadow failed", "candidate")
    last = F.col("stage").isin("shadow failed", "candidate")
    cooled = (F.col("stage") == "candidate") & F.col("previous_retrain").isNotNull()
    always = F.lit(True)
    guards = F.map_from_entries(
        F.array_compact(
            F.array(
                reached("measurable", F.lit(True), always),
                reached("lasting", F.col("persistent"), always),
                reached("above_noise", F.col("above_floor"), always),
                reached("outside_context", F.col("context_ok"), always),
                reached("trainable_cause", F.col("cause_is_ml"), always),
                reached("cause_repeated", F.col("cause_confirmed"), late),
                reached("challenger_gains", F.col("shadow_ok"), last),
                reached("cooled_down", F.coalesce("retrains", F.lit(False)), cooled),
            )
        )
    )
    code = F.when(F.col("stage") == "blocked", BLOCK).when(F.col("retrains"), RETRAIN).otherwise(NOTHING)
    names = F.create_map(*[x for k, v in ACTION_NAMES.items() for x in (F.lit(k), F.lit(v))])
    evidence_struct = F.struct(
        "n_drift", "effect_max", "n_alarmed", "n_windows", F.lit(effective).alias("effective_threshold"),
        "cause_evidence", "previous_cause", "gain", "auc_global", "auc_segment",
    )
    decided = measured.select(
        *keys, axis, names[code].alias("action"), code.alias("exit_code"), "cause", stage.alias("reason"),
        guards.alias("guards"), evidence_struct.alias("evidence"),
    )
    kinds = dict(zip(decided.columns, [f.dataType for f in decided.schema]))
    insufficient = rows.where(~F.coalesce(enough, F.lit(False))).select(
        *keys, axis,
        F.lit(ACTION_NAMES[INSUFFICIENT]).alias("action"),
        F.lit(INSUFFICIENT).alias("exit_code"),
        F.lit(CAUSE_UNDEFINED).alias("cause"),
        F.lit("window too small to be judged").alias("reason"),
        F.create_map(F.lit("measurable"), F.lit(False)).alias("guards"),
        F.lit(None).cast(kinds["evidence"]).alias("evidence"),
    )
    return decided.unionByName(insufficient)


def guard_table(decisions: DataFrame, keys: Sequence[str], axis: str) -> DataFrame:
    """``keys, axis, guard, result``: reached guards with their label and outcome."""
    labels = F.create_map(*[x for k, v in GUARD_LABELS.items() for x in (F.lit(k), F.lit(v))])
    rows = decisions.select(*keys, axis, F.explode("guards").alias("g", "ok"))
    return rows.select(
        *keys, axis, labels[F.col("g")].alias("guard"), F.when(F.col("ok"), "pass").otherwise("BLOCK").alias("result")
    ).where("guard is not null")
