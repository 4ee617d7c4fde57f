"""Distribution functions needed by the floors and p-values (``math`` only)."""

from __future__ import annotations

import math
from functools import lru_cache

_TINY = 1e-300


def gamma_q(a: float, x: float) -> float:
    """Upper regularised incomplete gamma function."""
    if x <= 0.0:
        return 1.0
    scale = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1.0:
        term = total = 1.0 / a
        n = a
        while abs(term) > abs(total) * 1e-16:
            n += 1.0
            term *= x / n
            total += term
        return max(0.0, 1.0 - total * scale)
    # continued fraction, modified Lentz evaluation
    b = x + 1.0 - a
    c = 1.0 / _TINY
    d = 1.0 / b
    h = d
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        d = 1.0 / (d if abs(d) > _TINY else _TINY)
        c = b + an / c
        c = c if abs(c) > _TINY else _TINY
        step = d * c
        h *= step
        if abs(step - 1.0) < 1e-16:
            break
    return scale * h


def chi2_sf(x: float, dof: float) -> float:
    """Upper tail of the chi-squared distribution."""
    return gamma_q(dof / 2.0, x / 2.0)


@lru_cache(maxsize=4096)
def chi2_ppf(q: float, dof: float) -> float:
    """Quantile of the chi-squared distribution by bisection."""
    if q <= 0.0:
        return 0.0
    lo, hi = 0.0, max(dof, 1.0)
    while 1.0 - chi2_sf(hi, dof) < q:
        hi *= 2.0
    for _ in range(200):
        mid = 0.5 * (lo + hi)
        if 1.0 - chi2_sf(mid, dof) < q:
            lo = mid
        else:
            hi = mid
        if hi - lo <= 1e-15 * hi:
            break
    return 0.5 * (lo + hi)


def kendall_tail(n: int, concordant: int) -> float:
    """Exact two-sided p-value of Kendall's tau without ties.

    Counts permutations of ``n`` items by their number of inversions.
    """
    pairs = n * (n - 1) // 2
    counts = [1]
    for size in range(2, n + 1):
        prefix = [0]
        for c in counts:
            prefix.append(prefix[-1] + c)
        width = len(counts) + size - 1
        counts = [
            prefix[min(k + 1, len(prefix) - 1)] - prefix[max(0, k - size + 1)] for k in range(width)
        ]
    tail = min(concordant, pairs - concordant)
    if 2 * tail == pairs:
        return 1.0
    return min(1.0, 2.0 * sum(counts[: tail + 1]) / math.factorial(n))
