"""Engineering-range violations, the cheapest layer: no reference, no labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.clean import number, quoted
from tidegauge.operators.windows import assign_windows
from tidegauge.types import SlidingWindow

SEVERE_FRACTION = 0.10


def range_violations(
    df: DataFrame,
    ranges: Mapping[str, tuple[float, float]],
    by: Sequence[str] = (),
    window: SlidingWindow | None = None,
) -> DataFrame:
    """``by, feature, n, fraction``: share of non-missing values outside [lo, hi].

    Columns the table lacks and all-missing columns are absent from the result.
    """
    present = [(f, lo, hi) for f, (lo, hi) in ranges.items() if f in df.columns]
    if not present:
        raise ValueError("none of the ranged features is in the table")
    units = [window.axis] if window else []
    out_by = [*by, *(["window"] if window else [])]
    wide = df.select(*by, *units, *[number(quoted(f)).alias(f"x{i}") for i, (f, _, _) in enumerate(present)])
    counts = []
    for i, (_, lo, hi) in enumerate(present):
        x = F.col(f"x{i}")
        counts += [F.count(x).alias(f"n{i}"), F.count_if((x < lo) | (x > hi)).alias(f"out{i}")]
    agg = wide.groupBy(*by, *units).agg(*counts)
    if window:
        agg = assign_windows(agg, window).groupBy(*out_by).agg(
            *[F.sum(f"{p}{i}").alias(f"{p}{i}") for i in range(len(present)) for p in ("n", "out")]
        )
    rows = F.array(
        *[
            F.struct(F.lit(f).alias("feature"), F.col(f"n{i}").alias("n"), F.col(f"out{i}").alias("n_out"))
            for i, (f, _, _) in enumerate(present)
        ]
    )
    return (
        agg.select(*out_by, F.inline(rows))
        .where("n > 0")
        .select(*out_by, "feature", "n", (F.col("n_out") / F.col("n")).alias("fraction"))
    )


def worst_violation(violations: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The feature with the largest severe fraction per group, if any."""
    severe = violations.where(F.col("fraction") > SEVERE_FRACTION)
    # ties go to the feature that sorts first
    best = F.min(F.struct((-F.col("fraction")).alias("k"), F.col("feature").alias("f")))
    return severe.groupBy(*by).agg(best.alias("b")).select(
        *by, F.col("b.f").alias("worst_feature"), (-F.col("b.k")).alias("worst_fraction")
    )
