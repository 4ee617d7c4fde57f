"""Model performance on scored rows, for every window and segment at once.

All metrics are functions of positive/negative counts per distinct score, so the
scored rows are shuffled once and ranked in buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.clean import finite, quoted, with_buckets
from tidegauge.operators.cumulative import (
    ROWS_PER_BUCKET,
    cumulate,
    interpolated,
    pick_positions,
    sketch_features,
)
from tidegauge.operators.joins import known_groups
from tidegauge.operators.windows import assign_windows, narrow_axis
from tidegauge.types import SlidingWindow

MIN_POSITIVES = 8
CLIP = 1e-7
GRID_FIRST, GRID_LAST, GRID_SIZE = 0.50, 0.9995, 200
ALL = "__all"


def score_counts(
    scored: DataFrame,
    by: Sequence[str],
    label: str = "y",
    score: str = "p",
    *,
    window: SlidingWindow | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> tuple[DataFrame, bool]:
    """``by, bucket, value, pos, neg, n`` per distinct score, and whether it is bucketed.

    With overlapping windows the counts are taken per axis unit and then summed.
    """
    units = [window.axis] if window else []
    cuts = sketch_features(scored, [score], rows_per_bucket=rows_per_bucket)[score][1]
    rows = scored.select(*by, *units, finite(quoted(score)).alias("value"), F.col(label).cast("int").alias("y")).where(
        "value is not null and y is not null"
    )
    counts = with_buckets(rows, {"value": cuts}).withColumnRenamed("value__b", "bucket").groupBy(
        *by, *units, "bucket", "value"
    ).agg(
        F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg"), F.count(F.lit(1)).alias("n")
    )
    if window:
        counts = assign_windows(counts, window).groupBy(*by, "window", "bucket", "value").agg(
            *[F.sum(c).alias(c) for c in ("pos", "neg", "n")]
        )
    return counts, bool(cuts)


def log_loss_signal(label: str = "y", score: str = "p") -> Column:
    """Per-row log-loss, the continuous signal for sequential detectors."""
    p = F.greatest(F.least(F.col(score).cast("double"), F.lit(1 - CLIP)), F.lit(CLIP))
    y = F.col(label).cast("double")
    return -(y * F.ln(p) + (1 - y) * F.ln(1 - p))


def mcc(tp: Column, fp: Column, fn: Column, tn: Column) -> Column:
    """Matthews correlation; 0 when a margin is empty."""
    tp, fp, fn, tn = (c.cast("double") for c in (tp, fp, fn, tn))
    margin = (tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)
    return F.when(margin == 0, 0.0).otherwise((tp * tn - fp * fn) / F.sqrt(margin))


def ranked(counts: DataFrame, by: Sequence[str], bucketed: bool) -> DataFrame:
    return cumulate(counts, by, "value", ["pos", "neg", "n"], bucketed=bucketed)


def ranking_metrics(rank: DataFrame, by: Sequence[str]) -> DataFrame:
    """``by, n, n_pos, roc_auc, pr_auc, logloss`` and the confusion at 0.5."""
    p_all, n_all = F.col("pos_all"), F.col("neg_all")
    tp = p_all - F.col("pos_before")
    fp = n_all - F.col("neg_before")
    auc = F.col("pos") * (F.col("neg_before") + F.col("neg") / 2.0)
    ap = F.col("pos") * (tp / (tp + fp))
    clipped = F.greatest(F.least(F.col("value"), F.lit(1 - CLIP)), F.lit(CLIP))
    loss = -(F.col("pos") * F.ln(clipped) + F.col("neg") * F.ln(1 - clipped))
    high = F.col("value") >= 0.5
    g = rank.groupBy(*by).agg(
        F.sum("n").alias("n"),
        F.sum("pos").alias("n_pos"),
        F.sum("neg").alias("n_neg"),
        F.sum(auc).alias("auc"),
        F.sum(ap).alias("ap"),
        F.sum(loss).alias("loss"),
        F.sum(F.when(high, F.col("pos")).otherwise(0)).alias("tp_half"),
        F.sum(F.when(high, F.col("neg")).otherwise(0)).alias("fp_half"),
    )
    return g.select(
        *by, "n", "n_pos",
        F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0), F.col("auc") / (F.col("n_pos") * F.col("n_neg"))).alias("roc_auc"),
        F.when(F.col("n_pos") > 0, F.col("ap") / F.col("n_pos")).alias("pr_auc"),
        (F.col("loss") / F.col("n")).alias("logloss"),
        "tp_half", "fp_half",
    )


def threshold_grid(rank: DataFrame, by: Sequence[str]) -> DataFrame:
    """``by, threshold, mcc`` on the score quantile grid of each group.

    A threshold between two neighbouring scores selects everything from the upper
    one on, so its confusion is read off the running counts.
    """
    step = (GRID_LAST - GRID_FIRST) / (GRID_SIZE - 1)
    picked = pick_positions(
        rank, by, "value", count=GRID_SIZE, start=GRID_FIRST, step=step, scale="(n_all - 1)",
        position=f"({GRID_FIRST!r}D + i * {step!r}D) * (n_all - 1)",
        carry=["pos_before", "neg_before", "pos_all", "neg_all"],
    )
    t = interpolated()
    upper = t > F.col("lo")
    pos_before = F.when(upper, F.col("pos_before_hi")).otherwise(F.col("pos_before_lo"))
    neg_before = F.when(upper, F.col("neg_before_hi")).otherwise(F.col("neg_before_lo"))
    tp, fp = F.col("pos_all_lo") - pos_before, F.col("neg_all_lo") - neg_before
    return picked.select(*by, t.alias("threshold"), mcc(tp, fp, pos_before, neg_before).alias("mcc"))


def best_threshold(grid: DataFrame, by: Sequence[str]) -> DataFrame:
    """Highest MCC per group, lowest threshold first among equals."""
    best = F.min(F.struct((-F.col("mcc")).alias("m"), F.col("threshold").alias("t")))
    return grid.groupBy(*by).agg(best.alias("b")).select(
        *by, F.col("b.t").alias("threshold"), (-F.col("b.m")).alias("best_mcc")
    )


def confusion_at(counts: DataFrame, by: Sequence[str], threshold: Column) -> DataFrame:
    """``by, mcc`` of ``score >= threshold``."""
    hit = F.col("value") >= threshold
    g = counts.groupBy(*by).agg(
        F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(hit, F.col("neg")).otherwise(0)).alias("fp"),
        F.sum("pos").alias("p"),
        F.sum("neg").alias("q"),
    )
    return g.select(
        *by, mcc(F.col("tp"), F.col("fp"), F.col("p") - F.col("tp"), F.col("q") - F.col("fp")).alias("mcc")
    )


def _grouped(scored: DataFrame, by: Sequence[str]) -> tuple[DataFrame, list[str]]:
    return (scored, list(by)) if by else (scored.withColumn(ALL, F.lit(0)), [ALL])


def performance(
    scored: DataFrame,
    by: Sequence[str] = (),
    *,
    label: str = "y",
    score: str = "p",
    threshold: float | None = None,
    digits: int | None = 5,
    window: SlidingWindow | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """``by, n, n_pos, pr_auc, roc_auc, mcc, logloss, threshold, estimable``.

    Metrics are NULL, never 0, below 8 positives or when all rows are positive.
    """
    if window:
        scored, keys, by = narrow_axis(scored, window), list(by), [*by, "window"]
    else:
        scored, keys = _grouped(scored, by)
    counts, bucketed = score_counts(
        known_groups(scored, keys), keys, label, score, window=window, rows_per_bucket=rows_per_bucket
    )
    keys = [*keys, "window"] if window else keys
    rank = ranked(counts, keys, bucketed)
    base = ranking_metrics(rank, keys)
    if threshold is None:
        decided = best_threshold(threshold_grid(rank, keys), keys).withColumnRenamed("best_mcc", "mcc")
    else:
        decided = confusion_at(counts, keys, F.lit(float(threshold))).withColumn("threshold", F.lit(float(threshold)))
    estimable = (F.col("n_pos") >= MIN_POSITIVES) & (F.col("n_pos") < F.col("n"))

    def shown(c: str) -> Column:
        x = F.when(estimable, F.col(c))
        return (F.round(x, digits) if digits is not None else x).alias(c)

    return base.join(decided, keys).select(
        *by, "n", "n_pos", *[shown(c) for c in ("pr_auc", "roc_auc", "mcc", "logloss", "threshold")],
        estimable.alias("estimable"),
    )


def extended_metrics(
    scored: DataFrame, by: Sequence[str] = (), *, label: str = "y", score: str = "p",
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Accuracy and F1 at 0.5 beside the metrics that survive imbalance; NULL for one class."""
    scored, keys = _grouped(scored, by)
    counts, bucketed = score_counts(scored, keys, label, score, rows_per_bucket=rows_per_bucket)
    rank = ranked(counts, keys, bucketed)
    base = ranking_metrics(rank, keys).join(best_threshold(threshold_grid(rank, keys), keys), keys)
    two = (F.col("n_pos") > 0) & (F.col("n_pos") < F.col("n"))
    tp, fp = F.col("tp_half"), F.col("fp_half")
    fn = F.col("n_pos") - tp
    f1 = F.when(2 * tp + fp + fn > 0, 2.0 * tp / (2 * tp + fp + fn)).otherwise(0.0)
    values = {
        "prevalence": F.col("n_pos") / F.col("n"),
        "accuracy": (tp + (F.col("n") - F.col("n_pos") - fp)) / F.col("n"),
        "accuracy_trivial": (F.col("n") - F.col("n_pos")) / F.col("n"),
        "f1_at_half": f1,
        "pr_auc": F.col("pr_auc"),
        "best_mcc": F.col("best_mcc"),
        "best_threshold": F.col("threshold"),
    }
    return base.select(*by, *[F.round(F.when(two, v), 5).alias(k) for k, v in values.items()])


def threshold_drift(
    scored: DataFrame, axis: str, *, label: str = "y", score: str = "p", rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """Per window: MCC at the first estimable window's threshold, at its own, and the gain."""
    counts, bucketed = score_counts(scored, [axis], label, score, rows_per_bucket=rows_per_bucket)
    rank = ranked(counts, [axis], bucketed)
    own = ranking_metrics(rank, [axis]).join(best_threshold(threshold_grid(rank, [axis]), [axis]), axis)
    own = own.where((F.col("n_pos") >= MIN_POSITIVES) & (F.col("n_pos") < F.col("n")))
    # one row per window
    first = F.first("threshold").over(Window.orderBy(axis).rowsBetween(Window.unboundedPreceding, 0))
    fixed = own.select(axis, F.col("threshold").alias("own_threshold"), "best_mcc", first.alias("fixed_threshold"))
    at_fixed = counts.join(fixed.select(axis, "fixed_threshold"), axis)
    confusion = confusion_at(at_fixed, [axis], F.col("fixed_threshold"))
    return fixed.join(confusion, axis).select(
        axis,
        F.round("mcc", 5).alias("mcc_fixed"),
        F.round("best_mcc", 5).alias("mcc_own"),
        F.round("own_threshold", 5).alias("own_threshold"),
        F.round(F.round("best_mcc", 5) - F.round("mcc", 5), 5).alias("gain"),
    )
