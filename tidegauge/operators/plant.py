"""Known faults planted into a user's own table, and scoring against them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions import stats
from tidegauge.types import BLOCK, RETRAIN

# fixed value: pounds per square inch to kilopascal
PSI_TO_KPA = 6.894757


def uniform(key: Column | str, stream: int = 0) -> Column:
    """Reproducible U[0,1) per row key, independent of partitioning."""
    return stats.split_hash(key, F.lit(stream)) / float(stats.HASH_MODULUS)


def unit_change(df: DataFrame, column: str, axis: str, start: int, factor: float = PSI_TO_KPA) -> DataFrame:
    """From ``start`` on the column is published in another unit."""
    x = F.col(column)
    return df.withColumn(column, F.when(F.col(axis) >= start, x * factor).otherwise(x))


def sensor_offset(
    df: DataFrame,
    column: str,
    axis: str,
    start: int,
    end: int,
    offset: float,
    *,
    segment: Column,
    key: str | None = None,
    compensated: str | None = None,
) -> DataFrame:
    """A segment's sensor reads ``offset`` low on [start, end].

    With ``compensated`` the operator reacts first: the true value, kept in that
    column, rises by ``offset * u`` with u uniform in [0.75, 1].
    """
    active = segment & F.col(axis).between(start, end)
    real = F.col(column)
    if compensated:
        if key is None:
            raise ValueError("compensation needs a row key for its noise")
        u = 0.75 + 0.25 * uniform(key)
        real = F.when(active, real + offset * u).otherwise(real)
        df = df.withColumn(compensated, real)
        real = F.col(compensated)
    return df.withColumn(column, F.when(active, real - offset).otherwise(real))


def category_shift(
    df: DataFrame, column: str, axis: str, start: int, end: int, category: str, share: float, *, key: str
) -> DataFrame:
    """On [start, end] a ``share`` of rows takes one category, as in a campaign."""
    active = F.col(axis).between(start, end) & (uniform(key, 1) < share)
    return df.withColumn(column, F.when(active, category).otherwise(F.col(column)))


def absolute_deviation(column: str, target: float) -> Column:
    return F.abs(F.col(column) - target)


def label_events(df: DataFrame, axis: str, events: Sequence[Mapping], name: str = "event") -> DataFrame:
    """Planted event active on the row's axis value, first match; NULL outside all."""
    out = F.lit(None).cast("string")
    for e in reversed(list(events)):
        out = F.when(F.col(axis).between(e["start"], e["end"]), F.lit(e["name"])).otherwise(out)
    return df.withColumn(name, out)


def detection_score(decisions: DataFrame, axis: str, events: DataFrame) -> DataFrame:
    """Per planted event: windows, alarms, actions, and whether the monitor was right.

    ``events``: ``name, start, end, must_alarm, exit_code`` (the right action).
    """
    catalogue = events.select("name", "must_alarm", F.col("exit_code").alias("right_code"), F.col("start").alias("__s"), F.col("end").alias("__e"))
    joined = decisions.join(catalogue, F.col(axis).between(F.col("__s"), F.col("__e")))
    alarmed = F.coalesce(F.col("evidence.n_drift") > 0, F.lit(False))
    return joined.groupBy("name").agg(
        F.count(F.lit(1)).alias("windows"),
        F.count_if(alarmed).alias("alarmed"),
        F.count_if(F.col("exit_code") == BLOCK).alias("blocked"),
        F.count_if(F.col("exit_code") == RETRAIN).alias("retrained"),
        F.count_if(alarmed == F.col("must_alarm")).alias("alarm_right"),
        F.count_if(F.col("exit_code") == F.col("right_code")).alias("action_right"),
    )
