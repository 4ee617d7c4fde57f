"""From rows to decisions in one stream.

Three operators in a chain. Each micro-batch is first counted where it lies: rows
become (segment, day, feature, slot, count), slots being bins, categories, range
violations and score cells, and overall counts beside those of the segments. Then one
state per bucket of segments keeps the counts of the days that open windows need,
merges days into sliding windows and, when the watermark passes a window's last day,
gives one evidence row for every monitor it knows, also for those that sent nothing.
A second state, one per monitor, walks the guards.

What a task holds is counts: days of one window times slots, for the segments of its
bucket and for all rows together. The overall counts are copied to every bucket, they
have one row per slot and day however many rows there are.

A row is late if the watermark had passed its day when it came. Late rows are in no
window; their number is part of the output, by segment and day.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidegauge.functions.clean import bisect_sql, literal, quoted
from tidegauge.functions.special import chi2_ppf
from tidegauge.operators.metrics import MIN_POSITIVES
from tidegauge.operators.policy import diagnose
from tidegauge.operators.profile import ReferenceProfile
from tidegauge.operators.ranges import SEVERE_FRACTION
from tidegauge.plans.monitor import MIN_SEGMENT_ROWS
from tidegauge.session import small_rows
from tidegauge.streaming.guards import GuardProcessor
from tidegauge.streaming.window_monitor import MICROS_PER_DAY, utc_instant
from tidegauge.types import CATEGORY_SCALE, MIN_VALUES, PSI_EPS, GuardConfig, MonitorSpec, SlidingWindow

SCORE_CELLS = 10_000
DAY_MS = MICROS_PER_DAY // 1000
ROWS, SEEN, OUT, BIN, CATEGORY, SCORED = "rows", "seen", "out", "bin", "cat", "score"
COUNTS = "bucket int, segment string, day bigint, kind string, feature string, slot string, n bigint"
EVIDENCE = (
    "segment string, window bigint, n_rows bigint, n_drift bigint, effect_max double, worst_feature string, worst_fraction double, "
    "auc_global double, auc_segment double, gain double, n_late bigint"
)
COMBINED_ROWS = 500_000  # distinct counts that a task holds before it passes them on

Counts = dict[tuple[str, str, str], int]


# ------------------------------------------------------------- counting batches


def unit_counts(
    stream: DataFrame,
    spec: MonitorSpec,
    edges: Mapping[str, Sequence[float]],
    time: str,
    *,
    origin_day: int,
    segment: str,
    label: str | None = None,
    score: str | None = None,
    watermark: str = "1 day",
    buckets: int = 16,
) -> DataFrame:
    """Counts of each micro-batch, see ``COUNTS``; a NULL segment stands for all rows.

    Rows without time are not counted, rows without segment count for all rows only.
    """
    def entry(kind: str, feature: str, slot: str, when: str = "true") -> str:
        return f"CASE WHEN {when} THEN named_struct('kind', '{kind}', 'feature', {literal(feature)}, 'slot', {slot}) END"

    slots = [entry(ROWS, "", "''")]
    for f in spec.num:
        x = f"try_cast({quoted(f)} as double)"
        inner = list(edges[f])[1:-1] if f in edges else []
        slots.append(entry(BIN, f, f"cast({bisect_sql(x, inner)} as string)", f"abs({x}) < double('Infinity')"))
    for f in spec.cat:
        slots.append(entry(CATEGORY, f, f"cast({quoted(f)} as string)", f"{quoted(f)} IS NOT NULL"))
    for f, (lo, hi) in spec.ranges.items():
        if f in stream.columns:
            x = f"try_cast({quoted(f)} as double)"
            slots.append(entry(SEEN, f, "''", f"{x} IS NOT NULL"))
            slots.append(entry(OUT, f, "''", f"{x} < {float(lo)!r}D OR {x} > {float(hi)!r}D"))
    if label and score:
        cell = f"cast(cast(round(try_cast({quoted(score)} as double) * {SCORE_CELLS}) as bigint) as string)"
        slots.append(entry(SCORED, "pos", cell, f"{quoted(label)} = 1"))
        slots.append(entry(SCORED, "neg", cell, f"{quoted(label)} = 0"))
    timed = stream.withColumn("__t", utc_instant(stream, time)).withWatermark("__t", watermark).where("__t IS NOT NULL")
    day = F.floor(F.unix_micros("__t") / MICROS_PER_DAY) - origin_day
    rows = timed.select(
        F.pmod(F.xxhash64(F.col(quoted(segment)).cast("string")), F.lit(buckets)).cast("int").alias("bucket"),
        F.col(quoted(segment)).cast("string").alias("segment"), day.cast("bigint").alias("day"),
        F.expr(f"inline(array_compact(array({', '.join(slots)})))"),
    ).where("slot IS NOT NULL").withColumn("n", F.lit(1).cast("bigint"))
    names = [c.split()[0] for c in COUNTS.split(", ")]
    keys, overall = names[:-1], ["day", "kind", "feature", "slot"]

    def combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def grouped(table: pa.Table, by: list[str]) -> pa.Table:
            return table.group_by(by).aggregate([("n", "sum")]).rename_columns([*by, "n"])

        def out(table: pa.Table) -> Iterator[pa.RecordBatch]:
            own = table.filter(pa.compute.is_valid(table.column("segment")))
            yield from own.select(names).to_batches()
            whole = grouped(table, overall)
            for bucket in range(buckets):  # every bucket of segments also sees the counts of all rows
                n = whole.num_rows
                copy = whole.append_column("bucket", pa.array([bucket] * n, pa.int32())).append_column("segment", pa.nulls(n, pa.string()))
                yield from copy.select(names).to_batches()

        for batch in batches:
            counted = grouped(pa.Table.from_batches([batch]), keys)
            held = counted if held is None else pa.concat_tables([held, counted])
            if held.num_rows > COMBINED_ROWS:
                held = grouped(held, keys)
                if held.num_rows > COMBINED_ROWS // 2:
                    yield from out(held)
                    held = None
        if held is not None:
            yield from out(grouped(held, keys))

    return rows.mapInArrow(combined, COUNTS)


# ----------------------------------------------------------- measuring a window


@dataclass(frozen=True)
class Reference:
    """What windows are measured against: counts per bin and category, never values."""

    spec: MonitorSpec
    bins: dict[str, tuple[int, ...]]
    categories: dict[str, dict[str, int]]

    @staticmethod
    def of(profile: ReferenceProfile) -> Reference:
        rows = small_rows(profile.category_counts) if profile.spec.cat else []  # one row per category
        categories: dict[str, dict[str, int]] = {f: {} for f in profile.spec.cat}
        for r in rows:
            categories[r["feature"]][r["category"]] = r["n_ref"]
        return Reference(profile.spec, {f: p.bin_counts for f, p in profile.numeric.items() if p.usable}, categories)

    def test(self, a: np.ndarray, b: np.ndarray, corrected: bool) -> bool:
        """Does a chi-squared test tell the counts apart at the monitor's level?"""
        there = (a + b) > 0
        a, b = a[there].astype(float), b[there].astype(float)
        if len(a) < 2 or not a.sum() or not b.sum():
            return False
        expected = (a + b) * b.sum() / (a.sum() + b.sum())
        gap = np.abs(b - expected)
        if corrected:
            gap -= np.minimum(0.5, gap)
        statistic = (gap**2 / expected + gap**2 / (a + b - expected)).sum()
        return bool(statistic > chi2_ppf(1.0 - self.spec.alpha_corrected, len(a) - 1))

    def features(self, counts: Counts) -> Iterator[tuple[float, bool]]:
        """(effect, drifted) of every measurable feature."""
        slots: dict[tuple[str, str], dict[str, int]] = defaultdict(dict)
        for (kind, feature, slot), n in counts.items():
            slots[kind, feature][slot] = n
        for f, ref in self.bins.items():
            a = np.array(ref)
            b = np.array([slots[BIN, f].get(str(i), 0) for i in range(len(ref))])
            if b.sum() >= MIN_VALUES and a.sum() >= MIN_VALUES:
                p, q = np.maximum(a / a.sum(), PSI_EPS), np.maximum(b / b.sum(), PSI_EPS)
                effect = float(((q - p) * np.log(q / p)).sum())
                yield effect, effect > self.spec.threshold and self.test(a, b, False)
        for f, ref in self.categories.items():
            names = sorted({*ref, *slots[CATEGORY, f]})
            a, b = (np.array([side.get(c, 0) for c in names]) for side in (ref, slots[CATEGORY, f]))
            if len(names) and b.sum() >= MIN_VALUES and a.sum() >= MIN_VALUES:
                p, q = a / a.sum(), b / b.sum()
                mid = np.maximum((p + q) * 0.5, 1e-12)
                js = sum(float((x[x > 0] * np.log2(x[x > 0] / mid[x > 0])).sum()) for x in (p, q)) * 0.5
                effect = min(max(js, 0.0), 1.0) * CATEGORY_SCALE
                yield effect, effect > self.spec.threshold and self.test(a, b, len(names) == 2)


def auc(counts: Counts) -> tuple[float | None, int]:
    """ROC-AUC over score cells (NULL where it cannot be estimated) and the scored rows."""
    cells: dict[int, list[int]] = defaultdict(lambda: [0, 0])
    for (kind, side, slot), n in counts.items():
        if kind == SCORED:
            cells[int(slot)][side == "pos"] += n
    ordered = np.array([cells[c] for c in sorted(cells)], float).reshape(-1, 2)
    neg, pos = ordered.sum(0)
    if pos < MIN_POSITIVES or not neg:
        return None, int(pos + neg)
    below = np.cumsum(ordered[:, 0]) - ordered[:, 0]
    return round(float((ordered[:, 1] * (below + ordered[:, 0] / 2)).sum() / (pos * neg)), 5), int(pos + neg)


def evidence_of(reference: Reference, whole: Counts, own: Counts, per_segment: bool) -> tuple:
    """One evidence row's columns from ``n_rows`` to ``auc_segment``."""
    judged = own if per_segment else whole
    n_rows = judged.get((ROWS, "", ""), 0)
    found = list(reference.features(judged)) if n_rows >= reference.spec.min_obs else []
    fractions = [
        (-judged.get((OUT, f, ""), 0) / judged[SEEN, f, ""], f) for f in reference.spec.ranges if judged.get((SEEN, f, ""), 0)
    ]
    worst, feature = min(fractions, default=(0.0, None))
    severe = -worst > SEVERE_FRACTION
    (whole_auc, _), (own_auc, scored) = auc(whole), auc(own)
    return (
        n_rows, sum(d for _, d in found), max((e for e, _ in found), default=None), feature if severe else None, -worst if severe else None,
        whole_auc, own_auc if scored > MIN_SEGMENT_ROWS else None,
    )


# ------------------------------------------------------------- merging windows


class WindowMerger(StatefulProcessor):
    """State of a bucket: counts of the days that open windows need, known monitors, the next window's end.

    An event-time timer stands at the end of the next window's last day. When it fires,
    all windows whose end the watermark has passed are closed in order, whether or not
    any row came for them.
    """

    def __init__(self, reference: Reference, window: SlidingWindow, origin_day: int, per_segment: bool):
        self.reference, self.window, self.origin_day, self.per_segment = reference, window, origin_day, per_segment

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        packed = "segment array<string>, kind array<string>, feature array<string>, slot array<string>, n array<bigint>"
        self.days = handle.getMapState("days", "day bigint", packed)
        self.monitors = handle.getValueState("monitors", "segments array<string>")
        self.next = handle.getValueState("next", "window bigint")

    def end_of(self, day: int) -> int:
        return (self.origin_day + day + 1) * DAY_MS

    def known(self) -> list[str]:
        return list(self.monitors.get()[0]) if self.monitors.exists() else []

    def begin(self) -> int:
        if not self.next.exists():
            self.next.update((self.window.first,))
            self.handle.registerTimer(self.end_of(self.window.first))
        return self.next.get()[0]

    def handleInitialState(self, key, initialState, timerValues) -> None:  # noqa: N802, N803
        self.monitors.update((sorted({*self.known(), *initialState["segment"]}),))
        self.begin()

    def counts_of(self, day: int) -> dict[tuple, int]:
        if not self.days.containsKey((day,)):
            return {}
        *names, n = self.days.getValue((day,))
        return dict(zip(zip(*names), n))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        self.begin()
        watermark = timerValues.getCurrentWatermarkInMs()
        late: dict[tuple, int] = defaultdict(int)
        fresh: dict[int, dict[tuple, int]] = defaultdict(lambda: defaultdict(int))
        seen = set()
        for pdf in rows:
            for segment, day, kind, feature, slot, n in pdf[["segment", "day", "kind", "feature", "slot", "n"]].itertuples(index=False, name=None):
                segment = segment if isinstance(segment, str) else None
                if segment is not None:
                    seen.add(segment)
                if self.end_of(day) <= watermark:
                    if kind == ROWS and (segment is not None or key[0] == 0):  # all rows are copied to every bucket
                        late[segment, day] += n
                elif day > self.window.first - self.window.width:
                    fresh[day][segment, kind, feature, slot] += n
        for day, found in fresh.items():
            held = self.counts_of(day)
            for k, n in found.items():
                held[k] = held.get(k, 0) + n
            columns = [list(c) for c in zip(*held)]
            self.days.updateValue((day,), (*columns, [int(n) for n in held.values()]))
        known = self.known()
        if seen - set(known):
            self.monitors.update((sorted({*known, *seen}),))
        if late:
            yield self.frame([(s, int(d), *[None] * 8, int(n)) for (s, d), n in late.items()])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        window, watermark, end = self.window, timerValues.getCurrentWatermarkInMs(), self.next.get()[0]
        out, known = [], self.known()
        while end <= window.last and self.end_of(end) <= watermark:
            merged: dict[str | None, Counts] = defaultdict(lambda: defaultdict(int))
            for day in range(end - window.width + 1, end + 1):
                for (segment, *slot), n in self.counts_of(day).items():
                    merged[segment][tuple(slot)] += n
            for segment in known:
                found = evidence_of(self.reference, merged[None], merged[segment], self.per_segment)
                out.append((segment, end, *found, None, None))
            end += window.step
            for day in range(end - window.step - window.width + 1, end - window.width + 1):  # no open window needs these
                if self.days.containsKey((day,)):
                    self.days.removeKey((day,))
        self.next.update((end,))
        if end <= window.last:
            self.handle.registerTimer(self.end_of(end))
        if out:
            yield self.frame(out)

    @staticmethod
    def frame(rows: list[tuple]) -> pd.DataFrame:
        names = [c.split()[0] for c in EVIDENCE.split(", ")]
        df = pd.DataFrame(rows, columns=names)
        whole = ["window", "n_rows", "n_drift", "n_late"]
        return df.astype({**{c: "Int64" for c in whole}, **{c: "float64" for c in ("effect_max", "worst_fraction", "auc_global", "auc_segment", "gain")}})

    def close(self) -> None:
        pass


class DecisionProcessor(GuardProcessor):
    """The guard cascade of a monitor; numbers of late rows pass by."""

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        batch = pd.concat(list(rows))
        late = batch["n_late"].notna()
        columns = [*self.keys, self.axis, "n_rows", "exit_code", "cause", "reason", "n_late"]
        if late.any():
            said = batch[late].groupby(self.axis)["n_late"].sum()
            rows_of = [(*key, int(d), None, None, None, None, int(n)) for d, n in said.items()]
            yield self.typed(pd.DataFrame(rows_of, columns=columns))
        if not late.all():
            measured = batch[~late]
            n_rows = dict(zip(measured[self.axis].astype(int), measured["n_rows"].astype(int)))
            for out in super().handleInputRows(key, iter([measured]), timerValues):
                out["n_rows"], out["n_late"] = out[self.axis].map(n_rows), None
                yield self.typed(out[columns])

    def typed(self, df: pd.DataFrame) -> pd.DataFrame:
        return df.astype({c: "Int64" for c in (self.axis, "n_rows", "exit_code", "n_late")})


DECISIONS = "segment string, window bigint, n_rows bigint, exit_code int, cause string, reason string, n_late bigint"


def decision_stream(
    stream: DataFrame,
    profile: ReferenceProfile,
    window: SlidingWindow,
    config: GuardConfig,
    *,
    time: str,
    origin_day: int,
    segment: str,
    label: str | None = None,
    score: str | None = None,
    monitors: DataFrame | None = None,
    per_segment: bool = False,
    watermark: str = "1 day",
    buckets: int = 16,
) -> DataFrame:
    """``segment, window, n_rows, exit_code, cause, reason`` for every monitor and window, and late rows.

    ``monitors`` (a column ``segment``) names monitors that are judged from the first window
    on; others are from the first row on. Drift, range violations and the number of rows are
    those of the whole window, or with ``per_segment`` those of the monitor's own rows.
    A feature has drifted when its effect exceeds the threshold and a chi-squared test on
    its bins or categories rejects equality at the corrected level: both follow from counts.
    Rows with ``n_late`` instead of a decision say how many rows of a day came too late, by
    segment, and under a NULL segment for all rows.
    """
    counts = unit_counts(
        stream, profile.spec, profile.edges, time, origin_day=origin_day, segment=segment, label=label, score=score,
        watermark=watermark, buckets=buckets,
    )
    first = None
    if monitors is not None:
        name = F.col("segment").cast("string")
        named = monitors.where("segment IS NOT NULL").select(F.pmod(F.xxhash64(name), F.lit(buckets)).cast("int").alias("bucket"), name.alias("segment"))
        first = named.groupBy("bucket")
    evidence = counts.groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=WindowMerger(Reference.of(profile), window, origin_day, per_segment), outputStructType=EVIDENCE,
        outputMode="Append", timeMode="EventTime", initialState=first,
    )
    diagnosed = diagnose(evidence, "window", config)
    needed = ["segment", "window", "n_rows", "n_drift", "effect_max", "gain", "cause", "n_late"]
    return diagnosed.select(*needed).groupBy("segment").transformWithStateInPandas(
        statefulProcessor=DecisionProcessor(config, "window", ["segment"]), outputStructType=DECISIONS, outputMode="Append", timeMode="None",
    )
