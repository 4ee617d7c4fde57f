"""Adaptive windowing (Bifet and Gavalda, 2007) over exponential histograms.

Raw rows are reduced in Spark to (count, sum, sum of squares) per key, signal and time
unit. What a key remembers of its window is a short list of buckets: a few of one
unit, a few of two, of four and so on, each with the same three numbers. A step
appends a unit, merges where a size has one bucket too many, and tries one cut at each
border between buckets: about log2(units) of them, not one for each unit. When two
parts differ, the oldest bucket leaves.

The same histogram runs over a table, one key and signal at a time, and as keyed state
of a stream whose units are closed by a watermark.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidegauge.functions.clean import quoted
from tidegauge.streaming.window_monitor import utc_instant

DELTA, MIN_ROWS = 0.002, 5
BUCKETS = 5  # of one size before two of them merge


def cut_found(n: np.ndarray, s: np.ndarray, q: np.ndarray, delta: float, min_rows: int, scale: float = 1.0) -> bool:
    """Does some split of the window separate two different means?

    ``scale`` is the range of the signal, which the inequality takes as 1.
    """
    n0, s0 = np.cumsum(n)[:-1], np.cumsum(s)[:-1]
    total, s_all = n.sum(), s.sum()
    n1, s1 = total - n0, s_all - s0
    ok = (n0 >= min_rows) & (n1 >= min_rows)
    if not ok.any():
        return False
    variance = max(q.sum() / total - (s_all / total) ** 2, 0.0)
    log_term = math.log(2.0 * math.log(max(total, 3.0)) / delta)
    inverse = 1.0 / n0[ok] + 1.0 / n1[ok]
    bound = np.sqrt(2.0 * inverse * variance * log_term) + 2.0 / 3.0 * log_term * inverse * scale
    return bool((np.abs(s0[ok] / n0[ok] - s1[ok] / n1[ok]) > bound).any())


class Histogram:
    """Buckets of a window, oldest first: units they cover (a power of two) and their numbers."""

    def __init__(self, sizes: Sequence[int] = (), n: Sequence[float] = (), s: Sequence[float] = (), q: Sequence[float] = ()):
        self.sizes, self.n, self.s, self.q = list(sizes), list(n), list(s), list(q)

    def append(self, n: float, s: float, q: float) -> None:
        for held, new in ((self.sizes, 1), (self.n, n), (self.s, s), (self.q, q)):
            held.append(new)
        size, end = 1, len(self.sizes)
        while True:  # buckets of a size lie together, larger ones before smaller ones
            begin = end
            while begin and self.sizes[begin - 1] == size:
                begin -= 1
            if end - begin <= BUCKETS:
                return
            for held in (self.sizes, self.n, self.s, self.q):
                held[begin : begin + 2] = [held[begin] + held[begin + 1]]
            size, end = 2 * size, begin + 1

    def shrink(self, delta: float, min_rows: int, scale: float) -> bool:
        """Drop the oldest buckets while a cut is found; whether any was."""
        changed = False
        while len(self.sizes) > 1 and cut_found(*(np.array(x, float) for x in (self.n, self.s, self.q)), delta, min_rows, scale):
            for held in (self.sizes, self.n, self.s, self.q):
                del held[0]
            changed = True
        return changed

    def run(self, units: Sequence[int], n, s, q, delta: float, min_rows: int, scale: float) -> list[int]:
        """Units of an ordered run at which the window shrinks."""
        found = []
        for unit, *numbers in zip(units, n, s, q):
            self.append(*map(float, numbers))
            if self.shrink(delta, min_rows, scale):
                found.append(int(unit))
        return found


def scan(pdf: pd.DataFrame, order: str, delta: float, min_rows: int, scale: float = 1.0) -> list[int]:
    """Units at which a change is found."""
    pdf = pdf.sort_values(order)
    return Histogram().run(pdf[order], pdf["n"], pdf["s"], pdf["q"], delta, min_rows, scale)


def signal_rows(signals: Mapping[str, tuple[Column, float]]) -> Column:
    """(signal, x) of a row for each named signal, NULL where it has none."""
    return F.inline(F.array(*[F.struct(F.lit(name).alias("signal"), x.cast("double").alias("x")) for name, (x, _) in signals.items()]))


def _numbers() -> list[Column]:
    return [F.count("x").cast("double").alias("n"), F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("q")]


def change_points(
    df: DataFrame, keys: Sequence[str], unit: str, signal: str, *, delta: float = DELTA, min_rows: int = MIN_ROWS
) -> DataFrame:
    """``keys, unit`` where the mean of one signal, a number between 0 and 1, changed."""
    return signal_changes(df, keys, unit, {signal: (F.col(quoted(signal)), 1.0)}, delta=delta, min_rows=min_rows).drop("signal")


def signal_changes(
    df: DataFrame, keys: Sequence[str], unit: str, signals: Mapping[str, tuple[Column, float]], *, delta: float = DELTA, min_rows: int = MIN_ROWS
) -> DataFrame:
    """``keys, signal, unit``: units where the mean of a signal changed, per key.

    ``signals`` are named expressions with their ranges. ``unit`` is an integral time unit
    (hour, shift, day); one key holds one small row per unit, whatever the number of rows.
    All signals are counted in one pass. NULL, and units without rows, count nowhere.
    """
    rows = df.select(*keys, F.col(quoted(unit)).cast("bigint").alias(unit), signal_rows(signals)).where("x IS NOT NULL")
    buckets = rows.groupBy(*keys, "signal", unit).agg(*_numbers())
    kinds = {f.name: f.dataType.simpleString() for f in buckets.schema}
    columns = [*keys, "signal", unit]
    schema = ", ".join(f"{c} {kinds[c]}" for c in columns)
    scales = {name: scale for name, (_, scale) in signals.items()}

    def run(key: tuple[Any, ...], pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(*key, u) for u in scan(pdf, unit, delta, min_rows, scales[key[-1]])], columns=columns)

    return buckets.groupBy(*keys, "signal").applyInPandas(run, schema)


class ChangeProcessor(StatefulProcessor):
    """State of a key and signal: the histogram of its window."""

    def __init__(self, columns: Sequence[str], scales: Mapping[str, float], delta: float, min_rows: int):
        self.columns, self.scales, self.delta, self.min_rows = list(columns), dict(scales), delta, min_rows

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.window = handle.getValueState("window", "sizes array<bigint>, n array<double>, s array<double>, q array<double>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        # the units of a key that this micro-batch has closed
        closed = pd.concat(list(rows)).sort_values(self.columns[-1])
        held = Histogram(*self.window.get()) if self.window.exists() else Histogram()
        units = closed[self.columns[-1]]
        found = held.run(units, closed["n"], closed["s"], closed["q"], self.delta, self.min_rows, self.scales[key[-1]])
        self.window.update((held.sizes, held.n, held.s, held.q))
        yield pd.DataFrame([(*key, u) for u in found], columns=self.columns)

    def close(self) -> None:
        pass


def change_stream(
    stream: DataFrame,
    keys: Sequence[str],
    time: str,
    signals: Mapping[str, tuple[Column, float]],
    *,
    origin_hour: int = 0,
    watermark: str = "1 hour",
    delta: float = DELTA,
    min_rows: int = MIN_ROWS,
) -> DataFrame:
    """``keys, signal, hour`` as ``signal_changes`` has them, of a stream with hours since ``origin_hour``.

    An hour is counted once the watermark has closed it; later rows of it are not.
    """
    timed = stream.withColumn("__t", utc_instant(stream, time)).withWatermark("__t", watermark)
    rows = timed.select("__t", *keys, signal_rows(signals)).where("x IS NOT NULL")
    counted = rows.groupBy(F.window("__t", "1 hour"), *keys, "signal").agg(*_numbers())
    hour = (F.floor(F.unix_micros("window.start") / 3_600_000_000) - origin_hour).cast("bigint").alias("hour")
    units = counted.select(*keys, "signal", hour, "n", "s", "q")
    kinds = {f.name: f.dataType.simpleString() for f in units.schema}
    columns = [*keys, "signal", "hour"]
    return units.groupBy(*keys, "signal").transformWithStateInPandas(
        statefulProcessor=ChangeProcessor(columns, {name: scale for name, (_, scale) in signals.items()}, delta, min_rows),
        outputStructType=", ".join(f"{c} {kinds[c]}" for c in columns), outputMode="Append", timeMode="None",
    )
