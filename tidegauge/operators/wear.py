"""Tool wear: a slow rise that no single window gives away."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.functions.special import kendall_tail

MIN_POINTS = 6
MAX_EXACT_POINTS = 33


def _trend_p(n: int, concordant: int, discordant: int, tie_pairs: int, tie_term: float) -> float | None:
    pairs = n * (n - 1) // 2
    if tie_pairs == pairs:
        return None
    if tie_pairs == 0 and (n <= MAX_EXACT_POINTS or min(discordant, pairs - discordant) <= 1):
        return kendall_tail(n, concordant)
    variance = (n * (n - 1) * (2 * n + 5) - tie_term) / 18.0
    return math.erfc(abs(concordant - discordant) / math.sqrt(variance) / math.sqrt(2.0))


@F.pandas_udf(T.DoubleType())
def trend_pvalue(
    batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series, pd.Series]],
) -> Iterator[pd.Series]:
    """Two-sided p of Kendall's tau from pair counts: exact without ties, else normal."""
    for n, c, d, t, v in batches:
        yield pd.Series(
            [
                None if pd.isna(a) or a < 2 else _trend_p(int(a), int(b), int(x), int(y), float(z))
                for a, b, x, y, z in zip(n, c, d, t, v)
            ],
            dtype="float64",
        )


def recent_effects(df: DataFrame, keys: Sequence[str], axis: str, effect: str, points: int) -> DataFrame:
    """The last ``points`` windows' finite effects per window, oldest first."""
    frame = Window.partitionBy(*keys).orderBy(axis).rowsBetween(-(points - 1), 0)
    x = F.col(effect)
    kept = F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)
    return df.withColumn("recent", F.collect_list(kept).over(frame))


def pair_counts(array: str) -> tuple[Column, Column, Column, Column]:
    """Concordant, discordant and tied pairs against the index, and the tie variance term.

    The array holds one number per window, ``points`` at most.
    """

    def pairs(op: str) -> Column:
        return F.expr(
            f"aggregate(sequence(1, size({array})), 0L, (acc, j) -> acc + "
            f"size(filter(slice({array}, 1, j - 1), y -> y {op} {array}[j - 1])))"
        )

    tie_term = F.expr(
        f"aggregate(array_distinct({array}), 0.0D, (acc, v) -> acc + "
        f"aggregate(array(cast(size(filter({array}, y -> y = v)) as double)), 0.0D, (a, t) -> a + t * (t - 1) * (2 * t + 5)))"
    )
    return pairs("<"), pairs(">"), pairs("="), tie_term


def wear_trend(
    df: DataFrame,
    keys: Sequence[str],
    axis: str,
    effect: str,
    *,
    points: int = 8,
    alpha: float = 0.05,
    min_tau: float = 0.6,
) -> DataFrame:
    """``keys, axis, points, tau, p_value, max_rise, wear`` for every window.

    Wear is a significant, strong and gradual rise: tau alone also accepts a single
    step, so no one rise may exceed half of the whole range.
    """
    recent = recent_effects(df, keys, axis, effect, points)
    concordant, discordant, ties, tie_term = pair_counts("recent")
    counted = recent.where(F.size("recent") > 0).select(
        *keys, axis, "recent", F.size("recent").alias("points"),
        concordant.alias("c"), discordant.alias("d"), ties.alias("t"), tie_term.alias("v"),
    )
    pairs = F.col("points") * (F.col("points") - 1) / 2.0
    spread = F.array_max("recent") - F.array_min("recent")
    rise = F.expr(
        "aggregate(sequence(2, greatest(size(recent), 2)), cast(null as double), "
        "(acc, j) -> greatest(acc, try_element_at(recent, j) - recent[j - 2]))"
    )
    scored = counted.select(
        *keys, axis, "points",
        F.when((pairs > 0) & (pairs > F.col("t")), (F.col("c") - F.col("d")) / F.sqrt(pairs * (pairs - F.col("t")))).alias("tau"),
        trend_pvalue("points", "c", "d", "t", "v").alias("p_value"),
        F.when(spread > 0, rise / spread).alias("max_rise"),
    )
    wear = (
        (F.col("points") >= MIN_POINTS) & (F.col("p_value") < alpha) & (F.col("tau") >= min_tau) & (F.col("max_rise") <= 0.5)
    )
    return scored.withColumn("wear", F.coalesce(wear, F.lit(False)))
