"""Configuration records and table schemas."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

# fixed values: exit codes of a decision
NOTHING, RETRAIN, BLOCK, INSUFFICIENT = 0, 10, 20, 30
ACTION_NAMES = {NOTHING: "NOTHING", RETRAIN: "RETRAIN", BLOCK: "BLOCK", INSUFFICIENT: "INSUFFICIENT"}

# fixed values: causes
CAUSE_NONE = "none"
CAUSE_BUSINESS = "business"
CAUSE_MODEL = "model"
CAUSE_HARDWARE = "hardware"
CAUSE_PIPELINE = "pipeline"
CAUSE_UNDEFINED = "undefined"
BLOCKING_CAUSES = (CAUSE_HARDWARE, CAUSE_PIPELINE)

# fixed values: measurement defaults
DEFAULT_THRESHOLD = 0.10
DEFAULT_BINS = 10
DEFAULT_MIN_OBS = 200
MIN_VALUES = 20
PSI_EPS = 1e-6
CATEGORY_SCALE = 2.5


@dataclass(frozen=True)
class MonitorSpec:
    """What is measured and when it counts as drift. Immutable; vary it with :meth:`but`."""

    num: tuple[str, ...] = ()
    cat: tuple[str, ...] = ()
    threshold: float = DEFAULT_THRESHOLD
    alpha: float = 0.05
    min_obs: int = DEFAULT_MIN_OBS
    bins: int = DEFAULT_BINS
    metric: str = "psi"
    ranges: Mapping[str, tuple[float, float]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        object.__setattr__(self, "num", tuple(self.num))
        object.__setattr__(self, "cat", tuple(self.cat))
        if not self.num and not self.cat:
            raise ValueError("a monitor without features passes every test: give num and/or cat")
        if self.metric not in ("psi", "wasserstein"):
            raise ValueError("metric is 'psi' or 'wasserstein'")

    @property
    def alpha_corrected(self) -> float:
        return self.alpha / max(1, len(self.num) + len(self.cat))

    def but(self, **changes) -> MonitorSpec:
        return replace(self, **changes)


@dataclass(frozen=True)
class SlidingWindow:
    """Windows of ``width`` axis units ending at ``first, first+step, ... <= last``."""

    axis: str
    first: int
    last: int
    width: int = 3
    step: int = 1


@dataclass(frozen=True)
class GuardConfig:
    """Parameters of the guard cascade."""

    floor: float
    threshold: float = DEFAULT_THRESHOLD
    min_obs: int = DEFAULT_MIN_OBS
    k: int = 3
    n: int = 5
    cooldown: int = 14
    floor_factor: float = 3.0
    min_gain: float = 0.01
    cause_confirmations: int = 2
    contexts: Mapping[str, tuple[int, int]] = field(default_factory=dict)


@dataclass(frozen=True)
class Contract:
    """Calibrated, versioned monitor configuration."""

    version: str
    origin: str
    num: tuple[str, ...]
    cat: tuple[str, ...]
    floor: float | None
    analytic_floor: float | None
    block_floor: float | None
    homogeneity: float | None
    threshold: float
    alpha: float
    min_obs: int
    bins: int = DEFAULT_BINS
    k: int = 3
    n: int = 5
    cooldown: int = 14
    floor_factor: float = 3.0
    min_gain: float = 0.01
    cause_confirmations: int = 2
    contexts: Mapping[str, tuple[int, int]] = field(default_factory=dict)
    ranges: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    suite_pass: int = 0
    suite_total: int = 0
    lineage: Mapping[str, str] = field(default_factory=dict)
    created_at: str = ""

    def __post_init__(self) -> None:
        missing = [n for n in ("threshold", "alpha", "min_obs") if getattr(self, n) is None]
        if missing:
            raise ValueError(f"incomplete contract, missing {missing}")
        base = self.effective_floor
        if base is None:
            raise ValueError("incomplete contract, no noise floor measured or computed")
        if self.threshold <= base:
            raise ValueError(
                f"threshold {self.threshold} does not exceed the noise floor {base}"
            )
        if self.suite_total and self.suite_pass < self.suite_total:
            raise ValueError(f"validation suite has failures ({self.suite_pass}/{self.suite_total})")

    @property
    def effective_floor(self) -> float | None:
        return self.floor if self.floor is not None else self.analytic_floor

    def monitor_spec(self) -> MonitorSpec:
        return MonitorSpec(
            num=self.num, cat=self.cat, threshold=self.threshold, alpha=self.alpha,
            min_obs=self.min_obs, bins=self.bins, ranges=dict(self.ranges),
        )

    def guard_config(self) -> GuardConfig:
        return GuardConfig(
            floor=self.effective_floor, threshold=self.threshold, min_obs=self.min_obs, k=self.k, n=self.n,
            cooldown=self.cooldown, floor_factor=self.floor_factor, min_gain=self.min_gain,
            cause_confirmations=self.cause_confirmations, contexts=dict(self.contexts),
        )


CONTRACT_SCHEMA = """
  version string, origin string, created_at string, num array<string>, cat array<string>,
  floor double, analytic_floor double, block_floor double, homogeneity double,
  threshold double, alpha double, min_obs int, bins int,
  k int, n int, cooldown int, floor_factor double, min_gain double, cause_confirmations int,
  contexts map<string, struct<first:int,last:int>>, ranges map<string, struct<lo:double,hi:double>>,
  suite_pass int, suite_total int, lineage map<string,string>
"""
