"""Time axis, sliding windows and interval lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.types import SlidingWindow


def day_axis(timestamp: Column | str, origin: str) -> Column:
    """Whole days since ``origin``, which is day 1."""
    ts = F.col(timestamp) if isinstance(timestamp, str) else timestamp
    return F.datediff(F.to_date(ts), F.to_date(F.lit(origin))) + 1


def in_window(axis: str, end: int, width: int = 3) -> Column:
    """Membership in ``(end - width, end]``."""
    return (F.col(axis) > end - width) & (F.col(axis) <= end)


def assign_windows(df: DataFrame, window: SlidingWindow, name: str = "window") -> DataFrame:
    """Replace the axis by every window end that covers it.

    Apply it to rows already aggregated per axis unit: counts are additive, so the
    windows are sums of units and the raw rows are never repeated.
    """
    a = F.col(window.axis).cast("bigint")
    steps_down = F.ceil((a - F.lit(window.first)) / F.lit(float(window.step)))
    lowest = F.greatest(steps_down, F.lit(0)).cast("bigint")
    highest = F.least(
        F.floor((a + (window.width - 1) - F.lit(window.first)) / F.lit(float(window.step))),
        F.lit((window.last - window.first) // window.step),
    ).cast("bigint")
    ends = F.when(
        lowest <= highest,
        F.transform(F.sequence(lowest, highest), lambda k: (k * window.step + window.first).cast("bigint")),
    )
    return df.withColumn(name, F.explode(ends)).drop(window.axis)


def narrow_axis(df: DataFrame, window: SlidingWindow) -> DataFrame:
    """Keep only rows some window can cover, so the filter reaches the scan."""
    return df.where(
        (F.col(window.axis) > window.first - window.width) & (F.col(window.axis) <= window.last)
    )


def interval_label(
    df: DataFrame, intervals: DataFrame, axis: str, start: str, end: str, label: str, order: str
) -> DataFrame:
    """First interval (by ``order``) with ``start <= axis <= end``; NULL outside all.

    The catalogue is compared with the distinct axis values, not with the rows, and its
    intervals are never expanded, so the axis may be as fine as it likes.
    """
    found = (
        df.select(F.col(axis).alias("__u")).where("__u is not null").distinct()
        .join(intervals.select(F.col(start).alias("__s"), F.col(end).alias("__e"), label, order), F.expr("__u between __s and __e"))
        .groupBy("__u")
        .agg(F.min_by(label, order).alias(label))
    )
    return df.join(found, F.col(axis) == F.col("__u"), "left").drop("__u")


def context_expression(axis: str, contexts: Mapping[str, tuple[int, int]]) -> Column:
    """Name of the first known context covering the axis, else NULL."""
    out = F.lit(None).cast("string")
    for name, (first, last) in reversed(list(contexts.items())):
        out = F.when(F.col(axis).between(first, last), F.lit(name)).otherwise(out)
    return out


def kept_periods(df: DataFrame, axis: str, *, min_share: float = 0.4, reference_periods: int = 4) -> DataFrame:
    """Periods whose volume exceeds a share of the median, first ones marked as reference.

    Input of the windows is one row per period.
    """
    volume = df.groupBy(axis).agg(F.count(F.lit(1)).alias("n"))
    median = volume.agg(F.percentile("n", 0.5).alias("__median"))
    kept = (
        volume.join(F.broadcast(median), F.lit(True))
        .where(F.col("n") > F.col("__median") * min_share)
        .select(axis, "n")
    )
    rank = F.row_number().over(Window.orderBy(axis))
    return kept.select(axis, "n", (rank <= reference_periods).alias("is_reference"))


def presence_drift(df: DataFrame, axis: str, flags: Sequence[str]) -> DataFrame:
    """Share of rows with each flag per period, and per flag its spread over time."""
    shares = df.groupBy(axis).agg(*[F.avg(F.col(f).cast("double")).alias(f) for f in flags])
    long = shares.unpivot([axis], list(flags), "station", "share")
    return long.groupBy("station").agg(
        F.min("share").alias("lowest"),
        F.max("share").alias("highest"),
        (F.max("share") - F.min("share")).alias("spread"),
    )


def presence_by_period(df: DataFrame, axis: str, flags: Sequence[str]) -> DataFrame:
    shares = df.groupBy(axis).agg(*[F.avg(F.col(f).cast("double")).alias(f) for f in flags])
    return shares.unpivot([axis], list(flags), "station", "share")
