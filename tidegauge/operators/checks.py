"""Expectations over a table, with floors and ceilings, in one aggregate per source."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.operators.joins import duplicate_keys, key_set_difference


@dataclass(frozen=True)
class Expectation:
    """An aggregate that must lie in [low, high]; ``strict`` excludes the ends."""

    name: str
    observed: Column
    low: float | None = None
    high: float | None = None
    strict: bool = True


def expectations(df: DataFrame, checks: list[Expectation]) -> DataFrame:
    """``check, ok, observed``. An aggregate that is NULL fails its check."""
    row = df.agg(*[c.observed.cast("double").alias(f"o{i}") for i, c in enumerate(checks)])

    def holds(x: Column, c: Expectation) -> Column:
        ok = x.isNotNull()
        if c.low is not None:
            ok = ok & ((x > c.low) if c.strict else (x >= c.low))
        if c.high is not None:
            ok = ok & ((x < c.high) if c.strict else (x <= c.high))
        return F.coalesce(ok, F.lit(False))

    items = [
        F.struct(F.lit(c.name).alias("check"), holds(F.col(f"o{i}"), c).alias("ok"), F.col(f"o{i}").alias("observed"))
        for i, c in enumerate(checks)
    ]
    return row.select(F.inline(F.array(*items)))


def require(checked: DataFrame) -> None:
    """Raise when a check failed (one row per check)."""
    failed = [r["check"] for r in checked.where(~F.col("ok")).collect()]
    if failed:
        raise ValueError(f"failed checks: {failed}")


def order_violations(df: DataFrame, position: str, value: str, *, block: int = 1_000_000) -> DataFrame:
    """One row: how often ``value`` falls along ``position`` (missing values skipped).

    Compared inside blocks of positions, then between neighbouring blocks.
    """
    rows = df.where(F.col(value).isNotNull()).withColumn("__b", F.floor(F.col(position) / block))
    inside = rows.withColumn("__prev", F.lag(value).over(Window.partitionBy("__b").orderBy(position)))
    blocks = inside.groupBy("__b").agg(
        F.count_if(F.col(value) < F.col("__prev")).alias("n"),
        F.min_by(value, position).alias("first"),
        F.max_by(value, position).alias("last"),
    )
    across = blocks.withColumn("__before", F.lag("last").over(Window.orderBy("__b")))
    return across.agg(
        F.coalesce(F.sum(F.col("n") + F.when(F.col("first") < F.col("__before"), 1).otherwise(0)), F.lit(0)).alias("n")
    )


def artefact_checks(
    meta: DataFrame,
    features: DataFrame,
    *,
    key: str = "Id",
    label: str = "Response",
    week: str = "week",
    position: str | None = None,
    time: str = "t_min",
    rate: tuple[float, float] = (0.004, 0.008),
    min_weeks: int = 15,
    min_stations: int = 51,
) -> DataFrame:
    """What must hold before a prepared table is published."""

    def count_of(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).cast("double").alias("observed")).select(
            F.lit(name).alias("check"), (F.col("observed") == 0).alias("ok"), "observed"
        )

    stations = sum(c.startswith("vis_") for c in meta.columns)
    one_pass = expectations(
        meta,
        [
            Expectation("labels present", F.count_if(F.col(label).isNull()), None, 0, strict=False),
            Expectation("failure rate in range", F.avg(F.col(label).cast("double")), *rate),
            Expectation("enough weeks", F.count_distinct(week), min_weeks, None, strict=False),
            Expectation("presence columns", F.lit(stations) + F.count(F.lit(1)) * 0, min_stations, None, strict=False),
        ],
    )
    per_week = meta.groupBy(week).agg(F.avg(F.col(label).cast("double")).alias("r"))
    spread = expectations(
        per_week,
        [Expectation("failures spread over time", F.stddev_samp("r") / F.nullif(F.avg("r"), F.lit(0.0)), None, 2.0)],
    )
    out = (
        count_of(duplicate_keys(meta, [key]), "unique key in meta")
        .unionByName(count_of(duplicate_keys(features, [key]), "unique key in features"))
        .unionByName(count_of(key_set_difference(meta.select(key), features.select(key), [key]), "same keys"))
        .unionByName(one_pass)
        .unionByName(spread)
    )
    if position:
        falls = order_violations(meta, position, time).select(
            F.lit("time order").alias("check"), (F.col("n") == 0).alias("ok"), F.col("n").cast("double").alias("observed")
        )
        out = out.unionByName(falls)
    return out
