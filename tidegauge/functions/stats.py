"""Column expressions for probabilities, floors and alarm rules."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.functions.special import chi2_ppf, chi2_sf

KS_TERMS = 100


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ks_pvalue(statistic: Column | str, n: Column | str, m: Column | str) -> Column:
    """Two-sided p-value of the two-sample Kolmogorov-Smirnov statistic.

    The limiting series at Stephens' finite-sample argument, which is close to the
    exact tail from a handful of rows on.
    """
    d, n, m = col(statistic), col(n).cast("double"), col(m).cast("double")
    root = F.sqrt(n * m / (n + m))
    lam = d * (root + 0.12 + 0.11 / root)
    tail = F.aggregate(
        F.sequence(F.lit(1), F.lit(KS_TERMS)),
        F.lit(0.0),
        lambda acc, k: acc
        + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(k.cast("double") * k * lam * lam * -2.0),
    )
    # below 0.2 the series is 1 to 12 digits but converges slowly
    return F.when(d.isNull(), None).when(lam < 0.2, 1.0).otherwise(
        F.greatest(F.least(tail, F.lit(1.0)), F.lit(0.0))
    )


@F.pandas_udf(T.DoubleType())
def chi2_pvalue(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Upper tail for (statistic, degrees of freedom); NULL stays NULL."""
    for stat, dof in batches:
        yield pd.Series(
            [None if pd.isna(s) or pd.isna(k) else chi2_sf(float(s), float(k)) for s, k in zip(stat, dof)],
            dtype="float64",
        )


def floor_quantile(bins: int = 10, k_features: int = 1, quantile: float = 0.95) -> float:
    """Chi-squared quantile of the largest of ``k_features`` null PSI values."""
    return chi2_ppf(quantile ** (1.0 / max(int(k_features), 1)), bins - 1)


def analytic_floor(
    n: Column | str, m: Column | str, *, bins: int = 10, k_features: int = 1, quantile: float = 0.95
) -> Column:
    """Noise floor of the PSI of two same-distribution samples; NULL below 20 rows or 3 bins."""
    n, m = col(n).cast("double"), col(m).cast("double")
    if bins < 3:
        return F.lit(None).cast("double")
    q = floor_quantile(bins, k_features, quantile)
    return F.when(F.least(n, m) >= 20, F.lit(q) * (1.0 / n + 1.0 / m))


def equivalent_n(threshold: Column | str | float, *, bins: int = 10, quantile: float = 0.95) -> Column:
    """Window size (n = m) at which ``threshold`` is pure noise."""
    t = F.lit(threshold) if isinstance(threshold, (int, float)) else col(threshold)
    return F.lit(chi2_ppf(quantile, bins - 1) * 2.0) / t


def alarm(p_value: Column | str, effect: Column | str, alpha: Column | float, threshold: Column | float) -> Column:
    """Significance AND magnitude, both strict; not measurable means no alarm."""
    p, e = col(p_value), col(effect)

    def known(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    return F.coalesce(known(p) & known(e) & (p < alpha) & (e > threshold), F.lit(False))


def coverage_threshold(coverage: Column | str, base: Column | float) -> Column:
    """Threshold that widens as coverage falls, at most tenfold."""
    return base / F.sqrt(F.greatest(col(coverage), F.lit(0.01)))


# fixed values: prime modulus, multiplier and increments of the portable split hash
HASH_MODULUS = 2147483647
HASH_KEY_STEP = 48271
HASH_REP_STEP = 16807
HASH_ROUND = 12345


def split_hash(key: Column | str, rep: Column | str, seed: int = 0) -> Column:
    """Reproducible pseudo-random integer in [0, modulus) per (integral key, repetition).

    Only integer arithmetic, so it does not depend on partitioning or engine.
    """
    k, r = col(key).cast("bigint"), col(rep).cast("bigint")
    h = (F.pmod(k, F.lit(HASH_MODULUS)) * HASH_KEY_STEP + (r + seed + 1) * HASH_REP_STEP) % HASH_MODULUS
    h = (h * h + (r + seed) * HASH_ROUND + 1) % HASH_MODULUS
    h = (h * h + HASH_ROUND) % HASH_MODULUS
    return h


def split_side(key: Column | str, rep: Column | str, fraction: float = 0.5, seed: int = 0) -> Column:
    """0 for the reference part, 1 for the probe part."""
    cut = int(HASH_MODULUS * fraction)
    return F.when(split_hash(key, rep, seed) < cut, 0).otherwise(1)
